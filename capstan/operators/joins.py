"""Joins whose right side may hold very hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SLICES = 4096


def left_join_fanout(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` when one key of ``right`` may hold a large share of its rows.

    Adaptive execution splits skewed partitions of an inner join on either
    side, but for a left outer join only the left side can be split, so a
    hot key on the right would land in one task.  The join is therefore an
    inner join (splittable) plus the left rows without a partner (anti join
    against the de-duplicated right keys, aggregated before the shuffle).
    Same rows and columns as the left outer join, NULL-key left rows
    included.
    """
    on = list(on)
    matched = left.join(right, on, "inner")
    unmatched = left.join(right.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def join_splittable(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                    spread_nulls_by: Sequence[str] = ()) -> DataFrame:
    """``left.join(right, on, how)`` whose left side adaptive execution can split at a hot key.

    A right side that comes out of a window or an aggregation over ``on`` is
    already partitioned by it; Spark then reuses that partitioning and cannot
    split the join.  Joining on a struct of the keys gives both sides an
    exchange of their own.  Rows whose key is NULL match nothing; with
    ``spread_nulls_by`` they are spread over ``NULL_SLICES`` key values by a
    hash of those columns instead of all meeting in one task.
    ``how``: inner, left, left_semi or left_anti.
    """
    on = list(on)
    missing = F.lit(False)
    for k in on:
        missing = missing | F.col(k).isNull()
    spread = F.pmod(F.xxhash64(*spread_nulls_by), F.lit(NULL_SLICES)) if spread_nulls_by else F.lit(0).cast("bigint")
    slot = F.when(missing, spread).otherwise(F.lit(-1).cast("bigint"))
    # a NULL key has a slot that no right row has
    lkey = F.struct(*[F.coalesce(F.col(k), F.lit(0).cast(left.schema[k].dataType)).alias(f"k{i}") for i, k in enumerate(on)],
                    slot.alias("slot"))
    rkey = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(on)], F.lit(-1).cast("bigint").alias("slot"))
    r = right.where(~_any_null(on)).withColumn("__jk", rkey).drop(*on)
    return left.withColumn("__jk", lkey).join(r, "__jk", how).drop("__jk")


def _any_null(columns: Sequence[str]):
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return cond
