"""Latest row per key ("ROW_NUMBER() ... = 1") and ranked rows.

``latest_per_key`` keeps the top row of each key.  Spark plans the
``row_number() = 1`` filter as a partial ``WindowGroupLimit`` *before* the
shuffle, so each map task forwards at most one row per key: a key holding a
third of the table costs one row per map task in the exchange, not a third
of the table in one reducer.

``ranked`` numbers all rows of each key (no limit).  A plain window would
send a hot key to one task, so ranks are computed over range partitions of
(key, order): a hot key is split across many tasks, each numbers its slice,
and a per-slice count prefix (one row per key and slice) supplies the offset.
The sliced rows are checkpointed so that the numbering and the counts see
the same slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstan.session import cut_lineage


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Top row per ``keys`` by ``order`` (give a unique column last to break ties)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank_col: str = "rank",
           slices: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` for every row, skew-safe.

    ``order`` must end with a unique column (the order is then total).
    """
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_cols = [F.col(k) for k in keys]
    # 1. range-partition on (keys, order): rows of one key are spread over
    #    consecutive slices in rank order; a hot key spans many slices.  The
    #    slice boundaries come from sampling, so the sliced rows are
    #    checkpointed (shared checkpoint folder): both branches below read
    #    the same slices even if a stage is recomputed.
    sliced = cut_lineage(df.repartitionByRange(n, *key_cols, *order)
                         .withColumn("__slice", F.spark_partition_id()))
    # 2. number rows inside (key, slice); a group is at most one slice.
    local_w = Window.partitionBy(*keys, "__slice").orderBy(*order)
    local = sliced.withColumn("__local", F.row_number().over(local_w))
    # 3. rows of the same key in earlier slices: one row per (key, slice).
    counts = sliced.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    prior_w = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__n").over(prior_w), F.lit(0))).drop("__n")
    cond = [local[k].eqNullSafe(offsets[k]) for k in keys] + [local["__slice"] == offsets["__slice"]]
    out = local.join(offsets, cond, "inner")
    return out.select(*[local[c] for c in df.columns],
                      (local["__local"] + offsets["__offset"]).cast("int").alias(rank_col))
