"""The lookup joins are split at a hot key and at a large NULL group, with unchanged rows."""

import pytest
from pyspark.sql import functions as F

from capstan.operators.joins import join_splittable
from capstan.operators.latest import latest_per_key


@pytest.fixture
def skewed(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_hot_key_is_split(skewed, how):
    rows = skewed.range(60000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).alias("k"),
                                      F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    right = latest_per_key(skewed.range(2000).select((F.col("id") % 900).alias("k"), F.col("id").alias("w")), ["k"], [F.col("w").desc()])
    got = join_splittable(rows, right, ["k"], how)
    assert "skew=true" in _plan(got)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(right, "k", how).select(*got.columns).collect()))


def test_null_group_is_spread(skewed):
    rows = skewed.range(60000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 997).alias("k"), F.col("id").alias("v"))
    right = skewed.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = join_splittable(rows, right, ["k"], "left", spread_nulls_by=["v"])
    parts = got.where("k is null").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 8
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(right, "k", "left").select(*got.columns).collect()))


def test_capacity_lines_scan_once(spark):
    from capstan.config import FIXTURE_CONFIG as CFG
    from capstan.plans import capacity as cap
    from capstan.sources import Sources
    src = Sources.stored_fixtures(spark, "/root/testdata/sf0.001")
    plan = cap.capacity_data(src, CFG, version=2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CapacityStudyLineID") > 0
    files = [x for x in plan.splitlines() if "Relation" in x and "CapacityStudyLineID" in x]
    assert len(files) == 1
