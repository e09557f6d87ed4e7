"""Sharding by sampled splitters, with DataFrame functions only.

Law ``bytes``: shard sizes come out near equal.

1. The key of a document is a 64-bit hash of its text, so equal texts are
   neighbours.  A size-weighted sample is drawn: a document of ``size`` bytes is
   taken with probability ``min(1, size * sample / total)`` (decided by a hash of
   its doc_id, so the draw is repeatable).  The sample's weighted quantiles are the
   splitters of ``ranges`` key ranges.
2. A text whose copies alone fill a range is a range of its own, cut by doc_id into
   parts of about a range.  Other ranges that came out overfull
   are subdivided by a second hash of the key.  The pieces are cells.
3. Cells, some thousands of (name, bytes, rows), are dealt to shards: texts with
   ranges of their own to the least filled shard (part by part only if one
   overfills a shard), the others in key order up to an even share.
4. ``slot`` numbers the records of a shard without gaps: the records of a cell by
   key and doc_id, after the cells before it.

Equal texts share a shard unless their copies overfill one.  What reaches the
driver is bounded by ``sample``, ``ranges`` and ``shards``, not by the input.

Defined cases: a NULL text counts as empty (size 1, CRC 0); an empty table gives
an empty result; rows that are equal in text and doc_id get different slots;
NULL doc_ids take part like any other.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstan.llm.common import stored


@dataclass(frozen=True)
class Settings:
    shards: int = 8
    ranges: int = 1024          # key ranges aimed at; raised to ``shards * 64`` when that is more
    sample: int = 32768         # expected sample rows


def _range_of(key: Column, splitters: list[int]) -> Column:
    """Number of splitters at or below ``key``: a binary search over the literal array."""
    if not splitters:
        return F.lit(0)
    cuts = F.expr("array(" + ",".join(f"{x}L" for x in splitters) + ")")
    steps = len(splitters).bit_length()
    powers = F.expr("array(" + ",".join(str(1 << s) for s in reversed(range(steps))) + ")")
    return F.aggregate(
        powers, F.lit(0),
        lambda low, p: F.when((low + p <= len(splitters)) & (F.element_at(cuts, F.least(low + p, F.lit(len(splitters)))) <= key), low + p)
        .otherwise(low))


def shard(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    s = settings
    n_ranges = max(s.ranges, 64 * s.shards)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"))
    rows = stored(rows, "sharding")          # narrow: the texts are read once
    total = rows.agg(F.sum("size")).first()[0] or 0
    target = max(1, total // n_ranges)

    # texts whose copies alone fill a range: fewer than n_ranges
    keys = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    heavy = {r["key"]: r["bytes"] for r in keys.filter(F.col("bytes") > target).collect()}
    light = ~F.col("key").isin(list(heavy)) if heavy else F.lit(True)

    # size-weighted sample: about s.sample rows, whatever the input
    draw = F.pmod(F.xxhash64("key", "doc_id", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sampled = rows.filter(light & (draw < F.col("size") * F.lit(s.sample / max(total, 1)))).select("key", "size").collect()
    # a row larger than total / sample was taken for sure: it stands for its own size
    unit = total / s.sample
    sampled = sorted((r["key"], max(r["size"], unit)) for r in sampled)
    splitters: list[int] = []
    weight, goal = 0.0, float(target)
    for key, w in sampled:
        weight += w
        if weight >= goal and (not splitters or key > splitters[-1]):
            splitters.append(key)
            goal = weight + target

    shard_bytes = max(1, total // s.shards)
    parts = {k: -(-b // target) for k, b in heavy.items()}
    in_range = _range_of(F.col("key"), splitters)
    if heavy:
        order = sorted(heavy)
        base = len(splitters) + 1
        number = _range_of(F.col("key"), order) - 1                      # position among the heavy keys
        cut = F.element_at(F.expr("array(" + ",".join(str(parts[k]) for k in order) + ")"), F.greatest(number + 1, F.lit(1)))
        rows = rows.withColumn("range", F.when(light, in_range).otherwise(number + base))
        rows = rows.withColumn("part", F.when(light, F.lit(0)).otherwise(
            F.pmod(F.xxhash64("doc_id", F.lit("cut")), cut)).cast("int"))
    else:
        base = len(splitters) + 1
        rows = rows.withColumn("range", in_range).withColumn("part", F.lit(0))

    # ranges that the sample left overfull are subdivided by a second hash of the key
    sizes = {r["range"]: r["bytes"] for r in rows.filter(F.col("range") < base).groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
    over = {r: -(-b // target) for r, b in sizes.items() if b > 2 * target}
    if over:
        cuts = F.expr("map(" + ",".join(f"{r},{n}" for r, n in sorted(over.items())) + ")")
        again = F.coalesce(F.try_element_at(cuts, F.col("range")), F.lit(1))
        rows = rows.withColumn("part", F.when(F.col("range") < base, F.pmod(F.xxhash64("key", F.lit("again")), again).cast("int"))
                               .otherwise(F.col("part")))

    cells = [(r["range"], r["part"], r["bytes"], r["n"]) for r in
             rows.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()]
    whole = {base + i for i, k in enumerate(sorted(heavy)) if heavy[k] <= shard_bytes}
    placed = deal(cells, s.shards, base, whole)
    spark = docs.sparkSession
    at = spark.createDataFrame([(r, p, sh, before) for (r, p), (sh, before) in placed.items()],
                               "range int, part int, shard int, before long")
    # one row per cell, bounded by the ranges and their parts
    joined = rows.withColumn("range", F.col("range").cast("int")).join(F.broadcast(at), ["range", "part"])
    inside = Window.partitionBy("range", "part").orderBy("key", "doc_id")
    return joined.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard"),
        (F.col("before") + F.row_number().over(inside) - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def deal(cells: list[tuple[int, int, int, int]], shards: int, base: int,
         whole: set[int]) -> dict[tuple[int, int], tuple[int, int]]:
    """(range, part) -> (shard, records in that shard before the cell).

    Ranges from ``base`` on are single texts; those in ``whole`` stay in one shard.
    """
    total = sum(c[2] for c in cells)
    filled = [0] * shards
    chosen: dict[tuple[int, int], int] = {}
    units: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    for c in cells:
        if c[0] >= base:
            units.setdefault((c[0], -1 if c[0] in whole else c[1]), []).append(c)
    for _, unit in sorted(units.items(), key=lambda u: (-sum(c[2] for c in u[1]), u[0])):
        k = min(range(shards), key=lambda x: (filled[x], x))
        for r, p, size, _ in unit:
            chosen[r, p] = k
            filled[k] += size
    # the others in key order: each shard up to an even share of what is left
    rest = sorted(c for c in cells if c[0] < base)
    room = [max(0.0, total / shards - f) for f in filled]
    scale = (sum(c[2] for c in rest) / sum(room)) if sum(room) else 0
    edges, run = [], 0.0
    for x in room:
        run += x * scale
        edges.append(run)
    done = 0
    for r, p, size, _ in rest:
        k = min(bisect.bisect_left(edges, done + size / 2), shards - 1)
        chosen[r, p] = k
        done += size
    out, seen = {}, [0] * shards
    for r, p, _, n in sorted(cells):
        k = chosen[r, p]
        out[r, p] = (k, seen[k])
        seen[k] += n
    return out
