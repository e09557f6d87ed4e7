"""MinHash near-duplicates with b-bit signatures.

1. Every document becomes its set of distinct word shingles (A-Z lower-cased);
   documents with the same set form a class, represented by the smallest doc_id.
2. Representatives get ``bands * rows`` minima.  The lowest ``2`` bits of each
   minimum are packed into 64-bit words; bands of full minima are the buckets.
3. Candidates: every bucket member with the bucket's smallest id.  The packed
   signatures give a collision-corrected similarity by bit counts; pairs whose
   estimate could still belong to a linked pair are confirmed on the full sets.
4. Confirmed links give components.  Buckets that still hold two or more
   components are compared in blocks inside tasks, across components only: first
   the packed signatures, then the full sets.  A task emits links, not pairs.

Every pair that shares a bucket is therefore either compared or already
connected; no bucket is capped.  A pair at similarity ``threshold`` shares no
bucket with probability ``(1 - threshold ** rows) ** bands`` (3e-6 at 0.8 with
6 rows and 42 bands), and the estimate's margin is five standard deviations.

Defined cases: NULL or empty texts have an empty set, link with nothing and are
kept; fewer words than a shingle make one shingle; repeated rows of one doc_id
are one document (all its rows stay or go together); rows without doc_id are
kept, in a component of their own (NULL).  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import stored
from capstan.llm.graph import components
from capstan.llm.words import LOWER, hash_runs, mix, ngram_hashes, slices, words
from capstan.operators.joins import join_splittable

BITS = 2                          # low bits kept of each minimum
_HALF = 0x5555555555555555        # one marker bit per 2-bit field


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80             # linked when 100 * |A & B| >= percent * |A | B|
    bands: int = 42
    rows: int = 6
    block: int = 1024             # rows of a bucket compared at once

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def longs(self) -> int:
        return math.ceil(self.hashes * BITS / 64)

    @property
    def max_differing(self) -> int:
        """Most differing fields that a linked pair shows, five standard deviations out."""
        j = self.percent / 100
        differ = (1 - j) * (1 - 2.0 ** -BITS)          # expected share of differing fields
        return math.ceil(self.hashes * (differ + 5 * math.sqrt(differ * (1 - differ) / self.hashes)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, and the first of each document."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    h = hash_runs(data, starts, ends)
    gram, _, gfirst = ngram_hashes(h, first, n)
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    doc = np.repeat(np.arange(len(count)), np.diff(gfirst))
    for c in np.unique(count[short]).tolist():             # one shingle of all their words, in order
        own = short[count[short] == c]
        at = first[own][:, None] + np.arange(c)
        whole, _, _ = ngram_hashes(h[at.ravel()], np.arange(len(own) + 1) * c, c)
        gram, doc = np.concatenate([gram, whole]), np.concatenate([doc, own])
    order = np.lexsort((gram, doc))
    gram, doc = gram[order], doc[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    gram, doc = gram[new], doc[new]
    return gram, np.searchsorted(doc, np.arange(len(count) + 1))


def _multipliers(k: int) -> tuple[np.ndarray, np.ndarray]:
    seed = mix(np.arange(1, 2 * k + 1, dtype=np.uint64))
    return (seed[:k] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seed[k:] >> np.uint64(32)).astype(np.uint32)


def minima(gram: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """``k`` minima per non-empty set, shape (sets, k)."""
    x = (gram ^ (gram >> np.uint64(32))).astype(np.uint32)
    a, b = _multipliers(k)
    out = np.empty((len(first) - 1, k), np.uint32)
    for j in range(k):
        out[:, j] = np.minimum.reduceat(x * a[j] + b[j], first[:-1])
    return out


def pack(low: np.ndarray, longs: int) -> np.ndarray:
    """2-bit fields packed into 64-bit words, shape (rows, longs)."""
    out = np.zeros((len(low), longs), np.uint64)
    for j in range(low.shape[1]):
        out[:, j // 32] |= low[:, j].astype(np.uint64) << np.uint64(2 * (j % 32))
    return out


def _sign(docs: DataFrame, s: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).cast(pa.int64())
            for lo, hi, data, off in slices(b.column(1)):
                gram, first = shingle_sets(data, off, s.shingle)
                size = np.diff(first)
                full = np.flatnonzero(size)
                n = hi - lo
                x, y = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                sig = np.zeros((n, s.longs), np.uint64)
                keys = np.zeros((n, s.bands), np.uint64)
                if len(full):
                    at = first[full]
                    x[full] = np.add.reduceat(mix(gram), at)
                    y[full] = np.add.reduceat(mix(gram * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)), at)
                    m = minima(gram, np.concatenate([at, [len(gram)]]), s.hashes)
                    sig[full] = pack((m ^ (m >> np.uint32(15))) & np.uint32(2 ** BITS - 1), s.longs)
                    band = np.zeros((len(full), s.bands), np.uint64)
                    for r in range(s.rows):
                        band = mix(band + m[:, r::s.rows])
                    keys[full] = mix(band + np.arange(1, s.bands + 1, dtype=np.uint64))
                as_long = lambda v: pa.array(v.view(np.int64))                                     # noqa: E731
                as_lists = lambda v: pa.FixedSizeListArray.from_arrays(                            # noqa: E731
                    pa.array(v.view(np.int64).ravel()), v.shape[1]).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, n), pa.array(size.astype(np.int64)), as_long(x), as_long(y), as_lists(sig), as_lists(keys)],
                    ["doc_id", "n_shingles", "x", "y", "sig", "keys"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, x long, y long, sig array<long>, keys array<long>")


def _differing(p: str, q: str, longs: int):
    """Number of differing 2-bit fields of two packed signatures, as a column."""
    total = F.lit(0)
    for k in range(longs):
        v = F.col(p)[k].bitwiseXOR(F.col(q)[k])
        total = total + F.bit_count((v.bitwiseOR(F.shiftrightunsigned(v, 1))).bitwiseAND(F.lit(_HALF)))
    return total


def _sets(docs: DataFrame, ids: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, set) of the documents ``ids(_id)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in slices(b.column(1)):
                gram, first = shingle_sets(data, off, s.shingle)
                lists = pa.LargeListArray.from_arrays(pa.array(first), pa.array(gram.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists], ["doc_id", "set"])

    # one plan at every size: a broadcast of the ids would turn into this shuffle as they grow
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(ids.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")
    return texts.mapInArrow(run, "doc_id long, set array<long>").dropDuplicates(["doc_id"])


def _confirm(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, q = b.column(2), b.column(3)
            keep = []
            for k in range(b.num_rows):
                x, y = p[k].values.to_numpy(), q[k].values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= s.percent * (len(x) + len(y) - common))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _link_block(s: Settings, band: int, ids: np.ndarray, comp: np.ndarray, own: np.ndarray, i: int, j: int,
                sig: np.ndarray, keys: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Confirmed links across components within a block (i = j) or between two, one per pair of groups.

    A pair is looked at in the first band that it shares only.  Full sets are
    compared as bit rows over the shingles that two or more rows have.
    """
    sizes = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    _, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(sets)), sizes)
    use = shared[where]
    row, bit = row[use], number[where[use]]
    words = int(shared.sum()) // 64 + 1
    bits = np.zeros((len(sets), words), np.uint64)
    np.bitwise_or.at(bits, (row, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    group = np.unique(comp, return_inverse=True)[1]          # components that found links join
    out = []
    for r in np.flatnonzero(own == i):
        other = (own == j) & (group != group[r])
        if i == j:
            other &= ids > ids[r]
        at = np.flatnonzero(other)
        if len(at) and band:
            at = at[~(keys[at, :band] == keys[r, :band]).any(axis=1)]
        if len(at):
            v = sig[at] ^ sig[r]
            at = at[np.bitwise_count((v | (v >> np.uint64(1))) & np.uint64(_HALF)).sum(axis=1) <= s.max_differing]
        if len(at):
            common = np.bitwise_count(bits[at] & bits[r]).sum(axis=1).astype(np.int64)
            at = at[100 * common >= s.percent * (sizes[at] + sizes[r] - common)]
        for k in at.tolist():
            if group[k] != group[r]:
                out.append((min(int(ids[r]), int(ids[k])), max(int(ids[r]), int(ids[k]))))
                group[group == group[k]] = group[r]
    return out


def _across(members: DataFrame, s: Settings) -> DataFrame:
    """Links across components within buckets ``members(key, band, doc_id, component, n, sig, keys, set)``.

    A bucket of n rows is cut into ceil(n / block) blocks; a task holds two
    blocks at a time and emits at most one link for each of their rows.
    """
    blocks = F.ceil(F.col("n") / F.lit(s.block)).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    spread = (members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .select("key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                      "doc_id", "component", "sig", "keys", "set"))
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    spread = spread.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Rows of one (key, i, j) after the other; they may cross batches."""
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(c).to_numpy() for c in (0, 2, 3)], axis=1)
            edge = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
            for p, q in zip(edge[:-1], edge[1:]):
                name = tuple(k[p])
                if held and name != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(b.slice(p, q - p))
                last = name
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches):
            if len(t) < 2:
                continue
            t = t.combine_chunks()
            cols = [t.column(c).to_numpy() for c in range(1, 7)]
            wide = lambda c: t.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(t), -1)
            sets = t.column(9).combine_chunks()
            flat, off = sets.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())])
            links = _link_block(s, int(cols[0][0]), cols[4], cols[5], cols[3], int(cols[1][0]), int(cols[2][0]), wide(7), wide(8),
                                [flat[p:q] for p, q in zip(off[:-1], off[1:])])
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
                                                 ["a", "b"])

    return spread.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs``."""
    s = settings
    signed = stored(_sign(docs, s), "minhash")
    full = signed.filter("doc_id is not null and n_shingles > 0")
    sets = full.groupBy("n_shingles", "x", "y").agg(F.min("doc_id").alias("rep"))
    # identical sets: one class, represented by its smallest doc_id
    member = (join_splittable(full.select("doc_id", "n_shingles", "x", "y"), sets, ["n_shingles", "x", "y"], "inner")
              .select("doc_id", "rep").distinct())
    reps = stored(full.join(sets.select(F.col("rep").alias("doc_id"), "n_shingles", "x", "y"), ["doc_id", "n_shingles", "x", "y"],
                            "left_semi").dropDuplicates(["doc_id", "x", "y"]).select("doc_id", "sig", "keys"), "minhash-classes")
    rows = reps.select("doc_id", F.posexplode("keys").alias("band", "key"))
    groups = stored(rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1"), "minhash-buckets")
    pairs = (rows.join(groups, "key").filter("doc_id <> least")
             .select(F.col("least").alias("a"), F.col("doc_id").alias("b")).distinct())
    sig = reps.select("doc_id", "sig")
    close = (pairs.join(sig.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa")), "a")
             .join(sig.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb")), "b")
             .filter(_differing("sa", "sb", s.longs) <= s.max_differing).select("a", "b").distinct())
    close = stored(close, "minhash-pairs")
    several = rows.join(groups.filter("n > 2").select("key", "n"), "key")
    ids = close.select(F.explode(F.array("a", "b")).alias("_id")).union(several.select("doc_id")).distinct()
    sets = stored(_sets(docs, ids, s), "minhash-sets")
    # a doc_id that stands for several texts (repeated ids) joins their classes
    own = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.count("*").alias("n")).filter("n > 1").select("doc_id", "a")
    same = own.join(member, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))
    links = stored(_confirm(close, sets, s), "minhash-links")
    comp = components(links)
    # buckets that still join several components: compare across components, in blocks
    named = (several.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left")
             .withColumn("component", F.coalesce("component", "doc_id")))
    open_keys = (named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .filter("lo <> hi").select("key"))
    rest = (named.join(open_keys, "key", "left_semi").join(reps, "doc_id").join(sets, "doc_id")
            .select("key", "band", "doc_id", "component", "n", "sig", "keys", "set"))
    links = links.union(stored(_across(rest, s), "minhash-across"))
    final = components(links.union(same))
    named = (member.join(final.withColumnRenamed("id", "rep"), "rep", "left")
             .groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component")))
    out = (signed.select("doc_id", "n_shingles").join(named, "doc_id", "left")
           .withColumn("component_id", F.coalesce("component", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def near_duplicate_filter(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each group stays (the smallest doc_id), every column unchanged."""
    drop = near_duplicates(docs, settings).filter("not kept").select(F.col("doc_id").alias("_drop")).distinct()
    return docs.join(drop, docs["doc_id"] == F.col("_drop"), "left_anti")
