"""Merges in linear space, and row counts taken while a merge runs."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from capstan.operators import GroupedMerge, MergeCounts, grouped_merge, null_safe_merge
from capstan.session import scratch_path


def _sides(spark, n):
    """A third of both sides has NULL keys, a key of its own holds another large share."""
    k = lambda m: F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 5 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % m))
    left = spark.range(n).select(k(40).alias("a"), F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("b"),
                                 F.col("id").alias("v"), (F.col("id") * 2).alias("x"))
    right = spark.range(n).select(k(60).alias("a"), F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("b"),
                                  F.col("id").alias("v"), (F.col("id") * 3).alias("y"))
    return left, right


def _rows(pdf):
    """Rows as sorted text, numbers alike whatever type pandas gave a column with missing values."""
    return sorted(tuple("" if pd.isna(v) else v if isinstance(v, str) else f"{float(v):g}" for v in r) for r in pdf.astype(object).itertuples(index=False))


@pytest.mark.parametrize("on", [["a"], ["a", "b"]])
def test_expansion_equals_pandas(spark, on):
    left, right = _sides(spark, 120)
    groups = grouped_merge(left, right, on)
    want = pd.merge(left.toPandas(), right.toPandas(), on=on, how="left")
    got = groups.expand()
    assert got.columns == list(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, null_safe_merge(left, right, on).collect()))
    assert _rows(got.toPandas()) == _rows(want)
    assert groups.merged_rows() == len(want)
    some = groups.expand(F.col("a").isNull())
    assert some.count() == want["a"].isna().sum() > 0
    assert groups.expand("merged_rows = 1").count() == groups.classes.where("merged_rows = 1").count()


def test_rows_written_grow_linearly(spark):
    written, merged = [], []
    for n in (300, 600, 1200):
        groups = grouped_merge(*_sides(spark, n), ["a"])
        path = scratch_path(spark, "grouped")
        groups.write(path)
        back = GroupedMerge.read(spark, path, ["a"])
        written.append(sum(getattr(back, name).count() for name in ("left", "right", "classes")))
        merged.append(back.merged_rows())
        assert back.left.count() == n and back.right.count() <= n
    assert written[2] <= 4.1 * written[0] and merged[2] > 14 * merged[0]        # 4 x the rows, 16 x the pairs


def test_hot_key_of_the_members_can_be_split(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        left, right = _sides(spark, 20_000)
        kept = grouped_merge(left, right.repartition(8), ["a"]).right
        assert kept.count() > 0
        kept.write.format("noop").mode("overwrite").save()
        kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in keys:
            spark.conf.unset(k) if k not in old else spark.conf.set(k, old[k])


def test_counts_are_taken_in_the_same_run(spark):
    left, right = _sides(spark, 200)
    counts = MergeCounts()
    out = null_safe_merge(left, right, ["a"], counts=counts)
    rows = out.collect()
    want = pd.merge(left.toPandas(), right.toPandas().assign(hit=1), on=["a"], how="left")
    assert counts.get() == {"left_rows": 200, "left_null_keys": left.where("a is null").count(), "merged_rows": len(want),
                            "matched_rows": int(want["hit"].notna().sum()), "unmatched_rows": int(want["hit"].isna().sum())}
    assert len(rows) == len(want) and out.columns == ["a", "b_x", "v_x", "x", "b_y", "v_y", "y"]
    with pytest.raises(ValueError):
        null_safe_merge(left, right, ["a"], hot_right_keys=True, counts=MergeCounts())


def test_pairs_of_a_hot_key_are_dealt_over_tasks(spark, monkeypatch):
    """A key with few bytes and many pairs: 300 x 200 NULLs with copies among them."""
    from capstan.operators import merge
    monkeypatch.setattr(merge, "TILE", 16)
    left = spark.range(400).select(F.when(F.col("id") >= 300, (F.col("id") % 7).cast("string")).alias("a"), (F.col("id") % 3).alias("v"))
    right = spark.range(260).select(F.when(F.col("id") >= 200, (F.col("id") % 9).cast("string")).alias("a"), (F.col("id") % 50).alias("w"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = null_safe_merge(left, right, ["a"], hot_right_keys=True)
        sizes = [r["count"] for r in got.where("a is null").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 300 * 200 and max(sizes) < 300 * 200 // 8
        assert sorted(map(str, got.collect())) == sorted(map(str, null_safe_merge(left, right, ["a"]).collect()))
        never = null_safe_merge(left, right, ["a"], hot_right_keys=True, null_keys="never")
        assert sorted(map(str, never.collect())) == sorted(map(str, null_safe_merge(left, right, ["a"], null_keys="never").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
