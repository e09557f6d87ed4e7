"""Nearest vectors by adaptive dimension scan over probed lists.

Largest inner product becomes smallest distance: every vector, divided by the largest
norm of the table, gets one more component that makes its length 1.  A k-means over a
bounded sample gives the lists; a random rotation spreads every difference evenly over
all dimensions, and the rotated vectors are kept in column blocks.  Inside a probed list
the squared distances grow block by block.  After ``d`` of ``D`` columns the share of a
squared distance seen so far follows Beta(d / 2, (D - d) / 2), so a candidate whose
partial distance is above the (1 - ``alpha``) quantile of that law times the query's
current 20th best distance is abandoned (one hypothesis test a block).  Candidates that
pass all blocks are scored in double precision on the original vectors.

Spark's part: equal vectors become one class with its ``top + 1`` smallest ids (more can
never be returned), so copies cost one vector however many there are; lists are packed
into units of at most ``block`` classes (a larger list is split), queries into blocks of
about ``block``; each (unit, query block) is one bounded group.  The driver sees the
sample (``fit_rows``), the lists' sizes and the fitted numbers.

The number of probed lists is set on the sample: as many as give ``recall`` of the
sample's own nearest neighbours (its neighbours are farther off than those of the whole
table, so this errs towards more lists).

Odd cases: vectors that are null, empty or zero, or hold a null or non-finite component,
take no part, and neither do rows without an id.  Shorter vectors are padded with zeros.
Of rows with the same id the one with the smallest vector counts.  Ties go to the smaller
id.  An empty table gives no rows; a table of one vector has a query without neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capstan.llm.common import stored
from capstan.operators.joins import join_splittable


@dataclass(frozen=True)
class Settings:
    top: int = 20
    every: int = 20              # rows whose id is divisible by this are queries
    fit_rows: int = 16_384       # bound of the sample that lists, probes and first thresholds come from
    recall: float = 0.98         # of the sample's neighbours inside the probed lists
    alpha: float = 0.0005        # chance that one test abandons a true neighbour
    spare: int = 12              # sample rows above the first threshold beyond those asked for
    columns: int = 16            # width of a column block
    block: int = 8_192           # classes in a unit at most (a 64th of a small table), and queries in a query block
    max_lists: int = 1_024
    seed: int = 11


@dataclass
class Index:
    """What the tasks need: small, bounded by ``fit_rows`` and ``max_lists``."""

    dim: int
    norm: float                  # largest norm
    rotation: np.ndarray
    centroids: np.ndarray        # rotated
    probes: int
    sample: np.ndarray           # original vectors
    home: np.ndarray             # list of each of them
    quantiles: np.ndarray        # per column block
    edges: np.ndarray            # column blocks
    settings: Settings


# ---------------------------------------------------------------- vectors

def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part, one per id."""
    e = F.col("embedding").cast("array<double>")
    good = (F.col("vec_id").isNotNull() & e.isNotNull()
            & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(e, lambda x: x != 0))
    # -0.0 + 0.0 is 0.0: equal vectors get equal bits
    return (rows.where(good).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(e, lambda x: x + 0.0).alias("embedding"))
            .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))


def _padded(v: DataFrame, dim: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("embedding"))
    return v.withColumn("embedding", F.when(F.size("embedding") < dim, F.concat("embedding", zeros)).otherwise(F.col("embedding")))


def classes(v: DataFrame, top: int) -> DataFrame:
    """(ids, embedding): equal vectors once, with their ``top + 1`` smallest ids in order."""
    w = Window.partitionBy("embedding").orderBy("vec_id")
    first = v.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= top + 1)
    return first.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


# ---------------------------------------------------------------- fit

def beta_quantile(a: float, b: float, p: float, grid: int = 20_001) -> float:
    """Upper ``p`` quantile of Beta(a, b) by summing its density (rounded up by one step)."""
    x = (np.arange(grid) + 0.5) / grid
    log = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
    c = np.cumsum(np.exp(log - log.max()))
    return float(min(1.0, x[np.searchsorted(c, p * c[-1])] + 1.0 / grid))


def augmented(x: np.ndarray, norm: float) -> np.ndarray:
    """Vectors scaled by the largest norm with the component that makes their length 1."""
    x = x / norm
    rest = np.sqrt(np.maximum(1.0 - np.einsum("ij,ij->i", x, x), 0.0))
    return np.hstack([x, rest[:, None]])


def unit_queries(q: np.ndarray) -> np.ndarray:
    scale = np.abs(q).max(1, keepdims=True)
    q = q / scale
    return np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))])


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        a = np.argmax(x @ c.T - 0.5 * np.einsum("ij,ij->i", c, c), axis=1)
        n = np.bincount(a, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, a, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def fit(sample: np.ndarray, norm: float, count: int, s: Settings) -> Index:
    """Lists, rotation, probes and quantiles from a sample of distinct vectors."""
    rng = np.random.default_rng(s.seed)
    dim = sample.shape[1]
    rotation = np.linalg.qr(rng.standard_normal((dim + 1, dim + 1)))[0]
    x = augmented(sample, norm) @ rotation
    k = int(max(1, min(s.max_lists, round(count ** 0.5), len(x) // 8)))
    c = _kmeans(x, k, rng)
    half = 0.5 * np.einsum("ij,ij->i", c, c)
    home = np.argmax(x @ c.T - half, axis=1)
    at = rng.choice(len(x), min(len(x), 512), replace=False)
    q = unit_queries(sample[at]) @ rotation
    near = q @ x.T
    near[np.arange(len(at)), at] = -np.inf
    top = min(s.top, len(x) - 1)
    probes = k
    if top > 0:
        best = np.argpartition(-near, top - 1, axis=1)[:, :top]
        order = np.argsort(half - q @ c.T, axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.broadcast_to(np.arange(k), order.shape), 1)
        need = np.sort(np.take_along_axis(rank, home[best], 1).ravel())
        probes = int(need[min(len(need) - 1, int(np.ceil(s.recall * len(need))) - 1)]) + 1
    edges = np.unique(np.append(np.arange(0, dim + 1, s.columns), dim + 1))
    if len(edges) > 2 and edges[-1] - edges[-2] < s.columns // 2:
        edges = np.delete(edges, -2)                     # a narrow last block joins the one before
    quantiles = np.array([1.0 if d == dim + 1 else beta_quantile(d / 2, (dim + 1 - d) / 2, 1 - s.alpha) for d in edges[1:]])
    return Index(dim, norm, rotation, c, probes, sample, home, quantiles, edges, s)


# ---------------------------------------------------------------- search

def _best(query: np.ndarray, score: np.ndarray, ident: np.ndarray, queries: int, keep: int) -> tuple[np.ndarray, ...]:
    """The ``keep`` first entries of each query (score down, id up), and each query's last kept score."""
    o = np.lexsort((ident, -score, query))
    query, score, ident = query[o], score[o], ident[o]
    first = np.searchsorted(query, np.arange(queries + 1))
    rank = np.arange(len(query)) - first[query]
    kth = np.full(queries, -np.inf)
    full = np.diff(first) >= keep
    kth[full] = score[first[:-1][full] + keep - 1]
    m = rank < keep
    return query[m], score[m], ident[m], kth


def scan(index: Index, x: np.ndarray, home: np.ndarray, q: np.ndarray, probed: list[np.ndarray], floor: np.ndarray,
         pairs: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, score, row of x) of the best ``top + 1`` rows of ``x`` per query, and the components read.

    ``home`` is each row's list, ``probed`` each query's lists, ``floor`` a score that ``top`` other
    rows are known to reach.
    """
    keep = index.settings.top + 1
    xr = (augmented(x, index.norm) @ index.rotation).astype(np.float32)
    qr = (unit_queries(q) @ index.rotation).astype(np.float32)
    xb = [np.ascontiguousarray(xr[:, a:b]) for a, b in zip(index.edges[:-1], index.edges[1:], strict=True)]
    qb = [np.ascontiguousarray(qr[:, a:b]) for a, b in zip(index.edges[:-1], index.edges[1:], strict=True)]
    xs = [np.einsum("ij,ij->i", b, b) for b in xb]
    qs = [np.einsum("ij,ij->i", b, b) for b in qb]
    length = np.linalg.norm(q, axis=1) * index.norm
    floor = floor.copy()
    got = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    read = 0
    who = np.repeat(np.arange(len(q)), [len(p) for p in probed])
    which = np.concatenate(probed) if probed else np.zeros(0, np.int64)
    for li in np.unique(home):
        rows = np.flatnonzero(home == li)
        asks = np.sort(who[which == li])
        step = max(1, pairs // max(1, len(rows)))
        for lo in range(0, len(asks), step):
            a = asks[lo:lo + step]
            # squared distance of unit vectors at the floor; the slack covers single precision
            limit = np.where(np.isfinite(floor[a]), 2.0 - 2.0 * floor[a] / length[a], 4.0) + 1e-4
            part = np.zeros((len(a), len(rows)), np.float32)
            block = 0
            while block < len(xb):                                  # dense while most candidates live
                part += qs[block][a][:, None] + xs[block][rows][None, :] - 2.0 * (qb[block][a] @ xb[block][rows].T)
                read += part.size * xb[block].shape[1]
                alive = part <= (limit * index.quantiles[block])[:, None]
                block += 1
                if alive.mean() < 0.25:
                    break
            i, j = np.nonzero(alive)
            seen = part[i, j]
            while block < len(xb) and len(i):                       # then the living pairs only
                d = qb[block][a[i]] - xb[block][rows[j]]
                seen = seen + np.einsum("ij,ij->i", d, d)
                read += d.size
                live = seen <= limit[i] * index.quantiles[block]
                i, j, seen = i[live], j[live], seen[live]
                block += 1
            score = np.einsum("ij,ij->i", q[a[i]], x[rows[j]])
            ok = score >= floor[a[i]]
            got = tuple(np.concatenate(z) for z in zip(got, (a[i][ok], score[ok], rows[j][ok]), strict=True))
        *got, kth = _best(*got, len(q), keep)
        floor = np.maximum(floor, kth)
    return (*got, read)


def _lists(index: Index, x: np.ndarray) -> np.ndarray:
    c = index.centroids
    return np.argmax(x @ c.T - 0.5 * np.einsum("ij,ij->i", c, c), axis=1)


def nearest(rows: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """(query_id, rank, vec_id, score): the ``top`` nearest found of every query row."""
    spark = rows.sparkSession
    v = stored(vectors(rows), "ann-vectors")
    scale = v.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"),
                  F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))).alias("largest")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not scale.n:
        return empty
    dim = int(scale.dim)
    v = _padded(v, dim)
    c = stored(classes(v, s.top), "ann-classes")
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (x / scale.largest) * (x / scale.largest))
    size = c.agg(F.count("*").alias("n"), F.max(norm).alias("norm")).first()
    part = F.pmod(F.xxhash64("embedding"), F.lit(1 << 30))
    share = c if size.n <= s.fit_rows else c.where(part < int(s.fit_rows / size.n * (1 << 30)))
    picked = sorted(map(tuple, (r.embedding for r in share.select("embedding").limit(2 * s.fit_rows).collect())))
    if not picked:
        picked = [c.first().embedding]
    index = fit(np.array(picked, np.float64).reshape(-1, dim), float(size.norm) ** 0.5 * float(scale.largest) * (1 + 1e-12), size.n, s)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("embedding"), ix.dim)
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids"), b.column("embedding"), pa.array(_lists(ix, augmented(x, ix.norm) @ ix.rotation), pa.int32())],
                    ["ids", "embedding", "list"])

    listed = stored(c.mapInArrow(assign, "ids array<bigint>, embedding array<double>, list int"), "ann-lists")
    counts = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}      # max_lists rows at most
    first, parts, units = _units(index, counts, min(s.block, max(1024, size.n // 64)))
    ask = (v.where(F.col("vec_id") % s.every == 0).groupBy("embedding").agg(F.min("vec_id").alias("qid")))
    ask = stored(ask, "ann-queries")
    blocks = max(1, -(-ask.count() // s.block))
    place = spark.sparkContext.broadcast((first, parts))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                yield _sent(ix, *place.value, b.slice(lo, 512), blocks)

    questions = ask.mapInArrow(send, "unit int, qblock int, qid bigint, embedding array<double>, lists array<int>, floor double")
    firsts, counts_of = (F.array(*[F.lit(int(z)) for z in a]) for a in (first, parts))
    unit = F.element_at(firsts, F.col("list") + 1) + F.pmod(F.xxhash64("embedding"), F.element_at(counts_of, F.col("list") + 1)).cast("int")
    stock = listed.withColumn("unit", unit).withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        ix = shared.value
        if not (left.num_rows and right.num_rows):
            return pa.table({"qid": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        x, q = matrix(left.column("embedding"), ix.dim), matrix(right.column("embedding"), ix.dim)
        ids = left.column("ids").combine_chunks()
        start, ids = np.asarray(ids.offsets), np.asarray(ids.values)
        lists = right.column("lists").combine_chunks()
        probed = np.split(np.asarray(lists.flatten()), np.asarray(lists.offsets)[1:-1] - np.asarray(lists.offsets)[0])
        query, score, row, _ = scan(ix, x, np.asarray(left.column("list")), q, probed, np.asarray(right.column("floor")))
        n = start[row + 1] - start[row]                             # a class stands for its smallest ids
        off = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(start[row] - off, n)
        query, score, ident, _ = _best(np.repeat(query, n), np.repeat(score, n), ids[at], len(q), ix.settings.top + 1)
        return pa.table({"qid": np.asarray(right.column("qid"))[query], "vec_id": ident, "score": score})

    found = (stock.groupBy("unit", "qblock").cogroup(questions.groupBy("unit", "qblock"))
             .applyInArrow(find, "qid long, vec_id long, score double"))
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= s.top + 1)
    best = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct(F.col("__rn").alias("rn"), "vec_id", "score"))).alias("near"))
    # every query row of a class has the class's list without itself
    # (the key in a struct: the classes' partitioning is not reused, so a hot class can be split)
    key = F.struct("embedding").alias("key")
    of = (v.where(F.col("vec_id") % s.every == 0).select(F.col("vec_id").alias("query_id"), key)
          .join(ask.select("qid", key), "key").select("query_id", "qid"))
    out = join_splittable(of, best, ["qid"], "inner")
    near = F.slice(F.filter("near", lambda e: e["vec_id"] != F.col("query_id")), 1, s.top)
    return (out.select("query_id", F.posexplode(near).alias("at", "e"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score")))


def _units(index: Index, counts: dict[int, int], block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First unit and number of units of each list: neighbouring lists share a unit, large lists have several."""
    c = index.centroids
    k = len(c)
    first, parts = np.zeros(k, np.int64), np.ones(k, np.int64)
    axis = np.linalg.svd(c - c.mean(0), full_matrices=False)[2][0] if k > 1 else np.zeros(c.shape[1])
    unit, load = 0, 0
    for li in np.argsort(c @ axis, kind="stable"):
        n = counts.get(int(li), 0)
        if load and load + n > block:
            unit, load = unit + 1, 0
        first[li] = unit
        if n > block:
            parts[li] = -(-n // block)
            unit, load = unit + int(parts[li]), 0
        else:
            load += n
    return first, parts, unit + 1


def _sent(ix: Index, first: np.ndarray, parts: np.ndarray, b: pa.RecordBatch, blocks: int) -> pa.RecordBatch:
    """One row per query and unit that holds a probed list of it."""
    s = ix.settings
    q = matrix(b.column("embedding"), ix.dim)
    qid = np.asarray(b.column("qid"))
    qr = unit_queries(q) @ ix.rotation
    c = ix.centroids
    far = 0.5 * np.einsum("ij,ij->i", c, c) - qr @ c.T
    lists = np.argsort(far, axis=1, kind="stable")[:, :ix.probes]
    # a first threshold: ``spare`` more rows of the sample than are asked for lie above it in the probed lists
    floor = np.full(len(q), -np.inf)
    at = s.top + s.spare
    if len(ix.sample) > at:
        probed = np.zeros((len(q), len(c)), bool)
        np.put_along_axis(probed, lists, True, 1)
        near = np.where(probed[:, ix.home], q @ ix.sample.T, -np.inf)
        floor = -np.partition(-near, at, axis=1)[:, at]
        floor = floor - 1e-9 * np.linalg.norm(q, axis=1) * ix.norm
    li = np.sort(lists, axis=1).ravel()
    who = np.repeat(np.arange(len(q)), lists.shape[1])
    n = parts[li]
    off = np.cumsum(n) - n
    unit = np.arange(int(n.sum())) + np.repeat(first[li] - off, n)
    who, li = np.repeat(who, n), np.repeat(li, n)
    o = np.lexsort((li, unit, who))
    who, li, unit = who[o], li[o], unit[o]
    new = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (unit[1:] != unit[:-1]))) if len(who) else np.zeros(0, np.int64)
    at = who[new]
    lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(li)), pa.int32()), pa.array(li, pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(unit[new], pa.int32()), pa.array(qid[at] // s.every % blocks, pa.int32()), pa.array(qid[at]),
         b.column("embedding").take(pa.array(at)), lists, pa.array(floor[at])],
        ["unit", "qblock", "qid", "embedding", "lists", "floor"])
