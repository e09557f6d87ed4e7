"""Prefix trie of conversations over minimal-perfect-hash node tables.

Conversations are rebuilt first: conversation ``c`` begins with the first ``h`` turns of
conversation ``c - c % 20`` (``h`` = CRC-32 of the decimal id, mod 4), then has its own
turns after its first ``h``.  A node is a distinct sequence of first turns.  Prefixes are
told apart by their depth and two polynomial digests of their turns' SHA-256 (2 x 61 bits).

A node table per shard: distinct prefix digests get slots of a minimal perfect hash (levels
of bit arrays; a digest that shares its place with another goes to the next level), every
slot is verified by the digest stored in it, also on lookup.  Counts are scattered into flat
arrays by slot; a parent-slot array carries children, leaves and saved tokens upwards, one
depth after the other from the deepest.

Spark's part:

* Turns are range-partitioned by conversation and turn; a long conversation spans several
  ranges.  Positions and digests are prefix sums, so a range only needs the count and sums
  of its first conversation from the ranges before (one row a range on the driver).
* Prefixes are counted by hash aggregation (combined before the shuffle).
* A node's weight is the number of prefixes in its members below and at it.  Nodes heavier
  than ``weight`` (and the root) are the crown; what hangs below a crown node is a subtree of
  at most ``weight`` prefixes, and subtrees are dealt to shards by hash.  Their totals, summed
  per parent, enter the crown, which is a shard itself; a crown of more than ``nodes`` nodes
  is cut into stretches of one conversation, whose totals (one row a stretch) are carried up
  between two passes.
* The list of conversations that end at a node is hashed as a stream of sorted chunks, never
  as one value.

Odd cases: rows without conv_id take no part.  NULL role or text counts as empty; a NULL turn
comes first; equal turns are ordered by the SHA-256 (hex) of length of role, ``:``, role, text,
and repeated rows are turns of their own.  A conversation without turns of its own and of its
base cannot occur, but one whose turns are all skipped belongs to the root.  No conversations:
no rows.  ``c % 20`` takes the sign of ``c``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.llm.common import stored
from capstan.llm.words import mix
from capstan.operators.joins import join_splittable

PRIME = np.uint64((1 << 61) - 1)
#: Two random bases of the polynomial digests, and their inverses modulo ``PRIME``.
BASES = (1_481_765_933_212_290_977, 987_654_321_123_456_789)
INVERSES = tuple(pow(b, -1, int(PRIME)) for b in BASES)

NODE = ["d1", "d2", "depth"]
PARENT = ["p1", "p2", "above"]
_WORDS = r"size(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0))"


@dataclass(frozen=True)
class Settings:
    family: int = 20             # a conversation's base is its id less id % family
    heads: int = 4               # at most heads - 1 turns come from the base
    weight: int = 1 << 17        # prefixes below a crown node's child, at most
    shard: int = 1 << 19         # prefixes of a shard, about
    nodes: int = 1 << 19         # crown nodes in one table


# ---------------------------------------------------------------- arithmetic modulo PRIME

def fold(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1, both reduced: 31-bit halves, so that nothing overflows."""
    s31, s30, m31, m30 = np.uint64(31), np.uint64(30), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    ah, al, bh, bl = a >> s31, a & m31, b >> s31, b & m31
    mid = al * bh + ah * bl
    return fold(np.uint64(2) * ah * bh + (mid >> s30) + ((mid & m30) << s31) + al * bl)


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return fold(a + b)


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return fold(a + (PRIME - b))


def power(base: int, n: np.ndarray) -> np.ndarray:
    out, square, n = np.ones(len(n), np.uint64), np.uint64(base), n.astype(np.uint64).copy()
    while n.any():
        odd = (n & np.uint64(1)).astype(bool)
        out[odd] = times(out[odd], square)
        square = times(square, square)
        n >>= np.uint64(1)
    return out


def running(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Running sums modulo ``PRIME`` within the runs that begin at ``first``."""
    s31, m31 = np.uint64(31), np.uint64((1 << 31) - 1)
    low, high = np.cumsum(x & m31), np.cumsum(x >> s31)
    total = plus(fold(low), times(fold(high), np.uint64(1 << 31)))
    before = np.concatenate([np.zeros(1, np.uint64), total])[first]
    return minus(total, np.repeat(before, np.diff(np.append(first, len(x)))))


def _unsigned(column: pa.Array) -> np.ndarray:
    return np.asarray(column).view(np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


# ---------------------------------------------------------------- turns

def turns(rows: DataFrame) -> DataFrame:
    """Stored ranges of (slice, conv_id, pos, t1, t2, s1, s2, words): positions and sums within each range."""
    clean = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the row's place parts a large group of equal rows over ranges; equal rows are alike
    keyed = clean.select("conv_id", "turn", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("turn_hash"),
                         F.expr(_WORDS).cast("bigint").alias("words"), F.monotonically_increasing_id().alias("place"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_hash"), F.col("place")]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None           # last: (conv_id, turns, sums so far)
        for b in batches:
            c = np.asarray(b.column("conv_id"))
            n = len(c)
            if not n:
                continue
            first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            pos = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
            carried = last is not None and last[0] == c[0]
            head = slice(0, first[1] if len(first) > 1 else n)
            if carried:
                pos[head] += last[1]
            t = np.frombuffer(b"".join(b.column("turn_hash").to_pylist()), ">u8").reshape(n, 4).astype(np.uint64)
            t = [fold(t[:, 0]), fold(t[:, 1])]
            s = [running(times(x, power(base, pos)), first) for x, base in zip(t, BASES, strict=True)]
            if carried:
                for k in (0, 1):
                    s[k][head] = plus(s[k][head], last[2][k])
            last = (c[-1], int(pos[-1]) + 1, (s[0][-1], s[1][-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), b.column("conv_id"), pa.array(pos.astype(np.int64)), *map(_signed, (*t, *s)), b.column("words")],
                ["slice", "conv_id", "pos", "t1", "t2", "s1", "s2", "words"])

    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(number, "slice int, conv_id bigint, pos bigint, t1 bigint, t2 bigint, s1 bigint, s2 bigint, words bigint"), "trie-turns")


def positioned(ranges: DataFrame) -> DataFrame:
    """``ranges`` with positions and sums over whole conversations."""
    last = F.max_by(F.struct("pos", "s1", "s2"), F.struct("conv_id", "pos"))
    ends = (ranges.groupBy("slice").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), last.alias("end"))
            .orderBy("slice").collect())                             # one row a range
    one = lambda x: np.array([x], np.int64).view(np.uint64)          # noqa: E731
    offsets, carry = {}, None
    for r in ends:
        count, sums = r.end.pos + 1, [one(r.end.s1), one(r.end.s2)]
        if carry is not None and carry[0] == r.first:
            offsets[r.slice] = carry
            if r.last == r.first:
                at = np.array([carry[1]])
                sums = [plus(c, times(power(base, at), s)) for base, c, s in zip(BASES, carry[2], sums, strict=True)]
                count += carry[1]
        carry = (r.last, count, sums)
    shared = ranges.sparkSession.sparkContext.broadcast(offsets)

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, c = np.asarray(b.column("slice")), np.asarray(b.column("conv_id"))
            pos = np.asarray(b.column("pos")).copy()
            s = [_unsigned(b.column(x)).copy() for x in ("s1", "s2")]
            for p in np.unique(part):
                if p in shared.value:
                    conv, count, sums = shared.value[p]
                    m = (part == p) & (c == conv)
                    pos[m] += count
                    for k, base in enumerate(BASES):
                        s[k][m] = plus(times(s[k][m], power(base, np.array([count]))), sums[k])
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(pos), b.column("t1"), b.column("t2"), *map(_signed, s), b.column("words")],
                                             ["conv_id", "pos", "t1", "t2", "s1", "s2", "words"])

    return ranges.mapInArrow(shift, "conv_id bigint, pos bigint, t1 bigint, t2 bigint, s1 bigint, s2 bigint, words bigint")


# ---------------------------------------------------------------- prefixes

OCCURRENCE = "d1 bigint, d2 bigint, depth bigint, p1 bigint, p2 bigint, conv_id bigint, words bigint, length bigint"


def conversations(own: DataFrame, s: Settings) -> DataFrame:
    """One row per conversation: what it takes from its base, its length, and the sums of the turns that it skips."""
    heads = s.heads - 1
    firsts = [F.max(F.when(F.col("pos") == i, F.col(x))).alias(f"{x}_{i}") for i in range(heads) for x in ("t1", "t2", "words")]
    skipped = [F.max(F.when(F.col("pos") == i, F.col(x))).alias(f"{x}_{i}") for i in range(heads) for x in ("s1", "s2")]
    # stored: it is joined with itself
    convs = stored(own.groupBy("conv_id").agg(F.count("*").alias("turns"), *firsts, *skipped), "trie-convs")
    base = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"),
                        *[F.col(f"{x}_{i}").alias(f"b_{x}_{i}") for i in range(heads) for x in ("t1", "t2", "words")])
    own_part = convs.select("conv_id", "turns", *[f"{x}_{i}" for i in range(heads) for x in ("s1", "s2")],
                            (F.col("conv_id") - F.col("conv_id") % s.family).alias("base"),
                            (F.crc32(F.col("conv_id").cast("string")) % s.heads).alias("h"))
    k = F.least("h", F.coalesce("base_turns", F.lit(0)))
    return (own_part.join(base, "base", "left").withColumn("k", k)
            .withColumn("length", F.col("k") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))))


def _head_sums(b: pa.RecordBatch, heads: int) -> list[list[np.ndarray]]:
    """Digests of the base's first 0, 1, .. turns, each of two bases."""
    zero = np.zeros(b.num_rows, np.uint64)
    out = [[zero, zero]]
    for i in range(heads):
        t = [_unsigned(b.column(f"b_{x}_{i}").fill_null(0)) for x in ("t1", "t2")]
        out.append([plus(out[-1][q], times(t[q], power(BASES[q], np.full(b.num_rows, i)))) for q in (0, 1)])
    return out


def occurrences(own: DataFrame, s: Settings) -> DataFrame:
    """Stored: every prefix of every rebuilt conversation (depth 0 included)."""
    heads = s.heads - 1
    convs = stored(conversations(own, s), "trie-plan")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Root and head prefixes."""
        for b in batches:
            k, sums = np.asarray(b.column("k")), _head_sums(b, heads)
            for d in range(heads + 1):
                m = pa.array(k >= d)
                up = sums[d - 1] if d else sums[0]
                words = b.column(f"b_words_{d - 1}") if d else pa.array(np.zeros(b.num_rows, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*map(_signed, sums[d]), pa.array(np.full(b.num_rows, d, np.int64)), *map(_signed, up), b.column("conv_id"), words,
                     b.column("length")], ["d1", "d2", "depth", "p1", "p2", "conv_id", "words", "length"]).filter(m)

    def bridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest of an own prefix = a + x * (its sum over the own turns)."""
        for b in batches:
            h, k, sums = np.asarray(b.column("h")), np.asarray(b.column("k")), _head_sums(b, heads)
            out = []
            for q, inverse in enumerate(INVERSES):
                head = np.choose(k, [sums[d][q] for d in range(heads + 1)])
                skip = np.choose(h, [np.zeros(len(h), np.uint64), *[_unsigned(b.column(f"s{q + 1}_{i}").fill_null(0)) for i in range(heads)]])
                x = power(inverse, h - k)
                out += [minus(head, times(x, skip)), x]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("h"), b.column("k"), b.column("length"), *map(_signed, out)],
                                             ["conv_id", "h", "k", "length", "a1", "x1", "a2", "x2"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pos = np.asarray(b.column("pos"))
            digest, parent = [], []
            for q, base in enumerate(BASES, 1):
                a, x, t, total = (_unsigned(b.column(f"{c}{q}")) for c in "axts")
                digest.append(plus(a, times(x, total)))
                parent.append(plus(a, times(x, minus(total, times(t, power(base, pos))))))
            depth = pos - np.asarray(b.column("h")) + np.asarray(b.column("k")) + 1
            yield pa.RecordBatch.from_arrays([*map(_signed, digest), pa.array(depth), *map(_signed, parent), b.column("conv_id"), b.column("words"),
                                              b.column("length")], ["d1", "d2", "depth", "p1", "p2", "conv_id", "words", "length"])

    line = convs.mapInArrow(bridge, "conv_id bigint, h bigint, k bigint, length bigint, a1 bigint, x1 bigint, a2 bigint, x2 bigint")
    rest = join_splittable(own.withColumnRenamed("conv_id", "c"), line.withColumn("c", F.col("conv_id")), ["c"], "inner").where("pos >= h")
    return stored(convs.mapInArrow(begin, OCCURRENCE).unionByName(rest.mapInArrow(follow, OCCURRENCE)), "trie-prefixes")


# ---------------------------------------------------------------- node tables

class NodeTable:
    """Minimal perfect hash of distinct keys (columns of 64-bit integers): ``slots`` are 0 .. n - 1, verified on lookup."""

    def __init__(self, keys: list[np.ndarray]):
        n = len(keys[0])
        self.levels: list[np.ndarray] = []
        self.slots = np.full(n, -1, np.int64)
        left, used = np.arange(n), 0
        while len(left):
            size = 2 * len(left) + 1
            at = self._place([k[left] for k in keys], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.where(alone, used + np.cumsum(alone) - 1, -1)
            self.levels.append(rank)
            self.slots[left] = rank[at]
            used += int(alone.sum())
            left = left[rank[at] < 0]
            if len(self.levels) > 200:
                raise RuntimeError("equal keys in a node table")
        self.stored = [np.empty_like(k) for k in keys]
        for table, k in zip(self.stored, keys, strict=True):
            table[self.slots] = k
        # collision check: n keys on n different slots, each finding itself
        if used != n or not np.array_equal(self.find(keys), self.slots):
            raise RuntimeError("two keys share a slot")

    @staticmethod
    def _place(keys: list[np.ndarray], level: int, size: int) -> np.ndarray:
        h = np.full(len(keys[0]), (level + 1) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
        for k in keys:
            h = mix(h ^ k.view(np.uint64))
        return (h % np.uint64(size)).astype(np.int64)

    def find(self, keys: list[np.ndarray]) -> np.ndarray:
        """Slot of each key, -1 where the table does not hold it."""
        out = np.full(len(keys[0]), -1, np.int64)
        left = np.arange(len(out))
        for level, rank in enumerate(self.levels):
            if not len(left):
                break
            got = rank[self._place([k[left] for k in keys], level, len(rank))]
            out[left] = got
            left = left[got < 0]
        hit = np.flatnonzero(out >= 0)
        same = np.ones(len(hit), bool)
        for table, k in zip(self.stored, keys, strict=True):
            same &= table[out[hit]] == k[hit]
        out[hit[~same]] = -1
        return out


RESULT = ("d1 bigint, d2 bigint, depth bigint, p1 bigint, p2 bigint, rep bigint, n bigint, words bigint, weight bigint, parent_rep bigint, "
          "children bigint, leaves bigint, saved bigint, top boolean")


def accumulate(t: pa.Table) -> pa.Table:
    """Children, leaves and saved tokens of one shard's nodes; ``more_*`` is what enters from other shards."""
    get = lambda c: np.asarray(t.column(c).combine_chunks())         # noqa: E731
    keys = [get(c) for c in NODE]
    table = NodeTable(keys)
    slot = table.slots

    def scattered(x: np.ndarray) -> np.ndarray:
        flat = np.empty_like(x)
        flat[slot] = x
        return flat

    parent = scattered(table.find([get("p1"), get("p2"), keys[2] - 1]))
    depth, rep, n, words = scattered(keys[2]), scattered(get("rep")), scattered(get("n")), scattered(get("words"))
    parent[depth == 0] = -1
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=len(slot)) + scattered(get("more_children"))
    leaves = (children == 0) + scattered(get("more_leaves"))
    saved = (n - 1) * words + scattered(get("more_saved"))
    order = np.argsort(-depth, kind="stable")
    cut = np.append(np.flatnonzero(np.append(True, np.diff(depth[order]) != 0)), len(order))
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):               # deepest first
        level = order[lo:hi]
        level = level[inner[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    up = parent[slot]
    return pa.table({
        **{c: t.column(c) for c in ("d1", "d2", "depth", "p1", "p2", "rep", "n", "words", "weight")},
        "parent_rep": pa.array(rep[np.maximum(up, 0)], mask=up < 0), "children": pa.array(children[slot]),
        "leaves": pa.array(leaves[slot].astype(np.int64)), "saved": pa.array(saved[slot]), "top": pa.array(up < 0)})


def _above(df: DataFrame) -> DataFrame:
    return df.withColumn("above", F.col("depth") - 1)


def _entering(tops: DataFrame) -> DataFrame:
    """What the tops of other shards bring, per parent node (named as a node)."""
    return (_above(tops.where("depth > 0")).groupBy(*PARENT)
            .agg(F.count("*").alias("more_children"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
            .select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), F.col("above").alias("depth"), "more_children", "more_leaves", "more_saved"))


def _with_entering(nodes: DataFrame, entering: DataFrame) -> DataFrame:
    more = ["more_children", "more_leaves", "more_saved"]
    return nodes.join(entering, NODE, "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in more})


def trie(rows: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row per node."""
    spark = rows.sparkSession
    occ = occurrences(positioned(turns(rows)), s)
    nodes = stored(occ.groupBy(*NODE).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("rep"), F.count("*").alias("n"), F.max("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "trie-nodes")
    total = nodes.where("depth = 0").agg(F.max("weight").alias("w")).first().w or 0
    heavy = (F.col("weight") > s.weight) | (F.col("depth") == 0)
    crown, forest = nodes.where(heavy), nodes.where(~heavy)
    # subtrees below the crown, and the one that each conversation runs through
    above = crown.select(*[F.col(a).alias(b) for a, b in zip(NODE, PARENT, strict=True)])
    tops = join_splittable(_above(forest.select(*NODE, "p1", "p2")), above, PARENT, "left_semi").select(*NODE)
    bins = max(1, -(-total // s.shard))
    through = (occ.join(tops, NODE).select(F.col("conv_id").alias("rep"), F.pmod(F.xxhash64("d1", "d2"), F.lit(bins)).alias("shard")))
    nothing = {c: F.lit(0).cast("bigint") for c in ("more_children", "more_leaves", "more_saved")}
    low = stored(forest.join(through, "rep").withColumns(nothing).groupBy("shard").applyInArrow(accumulate, RESULT), "trie-low")
    high = _crown(spark, _with_entering(crown, _entering(low.where("top"))), s)
    # the parents of the subtrees' tops are in the crown
    names = crown.select(*[F.col(a).alias(b) for a, b in zip(NODE, PARENT, strict=True)], F.col("rep").alias("__rep"))
    loose = low.where("top").unionByName(high.where("top"))
    loose = join_splittable(_above(loose), names, PARENT, "left").withColumn("parent_rep", F.col("__rep")).drop("__rep", "above")
    every = low.where("NOT top").unionByName(high.where("NOT top")).unionByName(loose)
    none = hashlib.sha256(b"").hexdigest()
    return (every.join(ends(occ), NODE, "left").select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent_rep").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


def _crown(spark: SparkSession, crown: DataFrame, s: Settings) -> DataFrame:
    """Results of the crown's nodes: one table, or stretches of one conversation whose totals go up between two passes."""
    crown = stored(crown, "trie-crown")
    if crown.count() <= s.nodes:
        return stored(crown.withColumn("piece", F.lit(0)).groupBy("piece").applyInArrow(accumulate, RESULT), "trie-high")
    names = crown.select(*[F.col(a).alias(b) for a, b in zip(NODE, PARENT, strict=True)], F.col("rep").alias("ua"))
    placed = join_splittable(_above(crown), names, PARENT, "left")
    placed = stored(placed.withColumns({"pa": F.col("rep"), "pb": F.expr(f"depth div {s.nodes}"), "ub": F.expr(f"above div {s.nodes}")}), "trie-pieces")
    crossing = placed.where("depth > 0 AND (ua <> pa OR ub <> pb)")
    kids = _entering(crossing.withColumns({"leaves": F.lit(0).cast("bigint"), "saved": F.lit(0).cast("bigint")}))
    first = _added(placed, kids).groupBy("pa", "pb").applyInArrow(accumulate, RESULT)
    top = first.where("top").select(F.col("rep").alias("pa"), F.expr(f"depth div {s.nodes}").alias("pb"), "leaves", "saved")
    # one row a stretch: the crown's nodes / s.nodes, and one for each heavy branch
    rows = crossing.select("pa", "pb", "ua", "ub", "depth", "p1", "p2").join(top, ["pa", "pb"]).collect()
    leaves, saved = ({(r.pa, r.pb): r[c] for r in rows} for c in ("leaves", "saved"))
    for r in sorted(rows, key=lambda r: -r.depth):
        if (r.ua, r.ub) in leaves:
            leaves[r.ua, r.ub] += leaves[r.pa, r.pb]
            saved[r.ua, r.ub] += saved[r.pa, r.pb]
    up = spark.createDataFrame([(r.p1, r.p2, r.depth, leaves[r.pa, r.pb], saved[r.pa, r.pb]) for r in rows],
                               "p1 bigint, p2 bigint, depth bigint, leaves bigint, saved bigint")
    return stored(_added(placed, _entering(up)).groupBy("pa", "pb").applyInArrow(accumulate, RESULT), "trie-high")


def _added(nodes: DataFrame, entering: DataFrame) -> DataFrame:
    """``nodes`` with more entering: what they had plus ``entering``."""
    more = {"more_children": "c2", "more_leaves": "l2", "more_saved": "s2"}
    both = nodes.join(entering.withColumnsRenamed(more), NODE, "left")
    return both.withColumns({a: F.col(a) + F.coalesce(F.col(b), F.lit(0)) for a, b in more.items()}).drop(*more.values())


# ---------------------------------------------------------------- members that end at a node

def ends(occ: DataFrame, chunk: int = 4096) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the comma-joined ids of the conversations that end there, streamed in chunks."""
    keys = [*NODE, "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [np.asarray(b.column(c)) for c in NODE]
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            new[0] = True
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(new)
            run = np.arange(b.num_rows) - np.repeat(first, np.diff(np.append(first, b.num_rows)))
            start = np.flatnonzero(run % (chunk // 16) == 0)          # an id has 20 characters at most
            ids = b.column("conv_id").cast(pa.string()).to_pylist()
            text = [",".join(ids[lo:hi]) for lo, hi in zip(start, np.append(start[1:], len(ids)), strict=True)]
            yield pa.RecordBatch.from_arrays([*[pa.array(c[start]) for c in cols], pa.array(np.asarray(b.column("conv_id"))[start]), pa.array(text, pa.string())],
                                             [*keys, "part"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in node], pa.array([state.hexdigest()])], [*NODE, "ends_sha256"])

        for b in batches:
            out = []
            for *key, part in zip(*[b.column(c).to_pylist() for c in (*NODE, "part")], strict=True):
                if key == node:
                    state.update(b"," + part.encode())
                    continue
                if node is not None:
                    out.append(done())
                node, state = key, hashlib.sha256(part.encode())
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if node is not None:
            yield done()

    last = occ.where("depth = length").select(*keys)
    parts = last.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(join, "d1 bigint, d2 bigint, depth bigint, conv_id bigint, part string")
    return (parts.repartition(*NODE).sortWithinPartitions(*keys).select(*NODE, "part")
            .mapInArrow(digest, "d1 bigint, d2 bigint, depth bigint, ends_sha256 string"))
