"""Operators on hand-built frames: ties, NULLs, skew, merge and unit rules."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from capstan.config import Config
from capstan.operators import (latest_per_key, null_safe_merge, ranked, rollup_flags, tag_flags, with_unit_divisor,
                               with_user)

D = dt.datetime


def test_latest_per_key_nulls_last_and_tie_break(spark):
    rows = [(1, D(2020, 1, 1), 10), (1, None, 11), (1, D(2020, 1, 1), 12),   # tie on date -> higher id
            (2, None, 20), (2, None, 21),                                   # only NULL dates -> higher id
            (None, D(2019, 1, 1), 30)]                                      # NULL key is its own group
    df = spark.createDataFrame(rows, "k long, d timestamp_ntz, id long")
    out = latest_per_key(df, ["k"], [F.col("d").desc_nulls_last(), F.col("id").desc()])
    got = sorted((r.k if r.k is not None else -1, r.id) for r in out.collect())
    assert got == [(-1, 30), (1, 12), (2, 21)]


def test_latest_per_key_plans_partial_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    plan = latest_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_ranked_matches_window_with_hot_key(spark):
    rnd = random.Random(7)
    # key 0 holds a third of the rows (hot group); ties on d broken by id
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 50), rnd.randint(0, 20), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, d int, id int")
    order = [F.col("d").desc(), F.col("id").desc()]
    got = {(r.k, r.id): r["rank"] for r in ranked(df, ["k"], order, slices=16).collect()}
    ref = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    want = {(r.k, r.id): r["rank"] for r in ref.collect()}
    assert got == want and len(got) == 3000


def test_tag_flags_latest_then_enabled_vs_enabled_then_any(spark):
    cfg = Config(named_tag_pattern="%Stationary Energy%")
    pt = spark.createDataFrame([
        # part 1: tag 31 latest row disabled (older enabled row must not count)
        (1, 1, 31, 1, D(2020, 1, 1)), (2, 1, 31, 0, D(2020, 2, 1)),
        # part 1: tag 30 latest enabled
        (3, 1, 30, 0, D(2020, 1, 1)), (4, 1, 30, 1, D(2020, 3, 1)),
        # part 2: named tag: an old enabled row counts even though a later row is disabled
        (5, 2, 204, 1, D(2019, 1, 1)), (6, 2, 204, 0, D(2021, 1, 1)),
        # part 3: named tag disabled as a tag -> no
        (7, 3, 205, 1, D(2020, 1, 1)),
        # part 4: same timestamp for 124, tie broken by PartTagID (9 enabled wins)
        (8, 4, 124, 0, D(2020, 1, 1)), (9, 4, 124, 1, D(2020, 1, 1)),
    ], "PartTagID long, PartID long, TagID int, Enabled int, CreateDate timestamp_ntz")
    tag = spark.createDataFrame([(204, "Stationary Energy Pack", 2, 1), (205, "Old Stationary Energy", 2, 0)],
                                "TagID int, TagName string, TagTypeID int, Enabled int")
    got = {r.PartID: (r.is_model_s, r.is_model_x, r.is_model_3, r.is_energy)
           for r in tag_flags(pt, tag, cfg).collect()}
    assert got[1] == (False, True, None, False)
    assert got[2] == (None, None, None, True)
    assert 3 not in got                      # no model rows, named tag disabled
    assert got[4] == (None, None, True, False)


def test_rollup_flags(spark):
    tasks = spark.createDataFrame([
        (1, 40, "capacity study", 3, None, None), (1, 40, "capacity study", 2, None, None),
        (1, 15, "run at rate", None, 1, None), (1, 41, "dimensional report", 3, None, None),
        (2, 15, "Run At Rate", 1, None, None)],
        "PartSupplierID long, TaskID int, TaskName string, StatusID int, TaskScore int, TaskScore1 int")
    got = {(r.PartSupplierID, r.TaskName): (r.Approved, r.Rejected, r.Submitted, r.Required)
           for r in rollup_flags(tasks, Config()).collect()}
    assert got == {(1, "capacity study"): (1, 0, 1, 0), (1, "run at rate"): (0, 1, 0, 0)}
    ci = {(r.PartSupplierID, r.TaskName) for r in rollup_flags(tasks, Config(case_insensitive=True)).collect()}
    assert (2, "Run At Rate") in ci
    only40 = {(r.PartSupplierID, r.TaskName) for r in rollup_flags(tasks, Config(), task_id=40).collect()}
    assert only40 == {(1, "capacity study")}


def test_null_safe_merge_like_pandas(spark):
    left = spark.createDataFrame([("a", "x", 1), (None, "y", 2), (None, None, 3), ("b", "z", 4)],
                                 "PartNumber string, SupplierCode string, PartID int")
    right = spark.createDataFrame([("a", "x", 10, "r1"), (None, "y", 20, "r2"), (None, None, 30, "r3"),
                                   (None, None, 31, "r4")],
                                  "PartNumber string, SupplierCode string, PartID int, extra string")
    out = null_safe_merge(left, right, ["PartNumber", "SupplierCode"])
    assert out.columns == ["PartNumber", "SupplierCode", "PartID_x", "PartID_y", "extra"]
    got = sorted((r.PartID_x, r.PartID_y) for r in out.collect())
    # NULL keys match NULL keys (fan-out kept); unmatched left row kept with NULLs
    assert got == sorted([(1, 10), (2, 20), (3, 30), (3, 31), (4, None)])
    import pandas as pd
    want = pd.merge(left.toPandas(), right.toPandas(), how="left", on=["PartNumber", "SupplierCode"])
    assert list(want.columns) == out.columns and len(want) == out.count()


def test_with_user_manager_from_full_table(spark):
    users = spark.createDataFrame([(1, "u1", 2, "B1"), (2, "boss", None, ""), (3, "u3", 2, "B1")],
                                  "UserID long, DisplayName string, ManagerUserID long, SAPUserID string")
    parts = spark.createDataFrame([(100, "B1"), (101, None)], "PartID long, BuyerCode string")
    buyers = users.where(F.col("SAPUserID") != "")
    out = with_user(parts, buyers, on="BuyerCode", user_key="SAPUserID", name_as="GSM", manager_as="GSMManager",
                    managers=users)
    got = sorted((r.PartID, r.GSM, r.GSMManager) for r in out.collect() if r.GSM)
    assert got == [(100, "u1", "boss"), (100, "u3", "boss")]       # fan-out; boss is no buyer but is found
    assert out.count() == 3


def test_unit_divisor_precedence(spark):
    general = spark.createDataFrame([(1, 0, 2.0), (0, 2, 4.0)], "FromUnitID int, ToUnitID int, ConversionFactor double")
    part = spark.createDataFrame([(7, 5, 6, 8.0), (8, 9, 5, 0.5)],
                                 "PartID long, FromUnitID int, ToUnitID int, ConversionFactor double")
    rows = [(1, 1, 1),      # same unit -> 1
            (1, 0, None),   # purchase unit unknown -> 1
            (1, 1, 0),      # general forward: 1/2
            (1, 2, 0),      # general reverse (0->2 factor 4): 1/(1/4) = 4
            (7, 5, 6),      # part forward: 1/8
            (8, 5, 9),      # part reverse (9->5 factor 0.5): 1/(1/0.5) = 0.5
            (9, None, 3),   # stock unit unknown, purchase known -> no factor -> NULL
            (9, 4, 3)]      # no factor anywhere -> NULL
    df = spark.createDataFrame(rows, "PartID long, StockUnitID int, PurchaseUnitID int")
    got = [r.UnitDivisor for r in with_unit_divisor(df, general, part).orderBy("PartID", "StockUnitID").collect()]
    by_row = {(r.PartID, r.StockUnitID, r.PurchaseUnitID): r.UnitDivisor
              for r in with_unit_divisor(df, general, part).collect()}
    assert by_row[(1, 1, 1)] == 1.0 and by_row[(1, 0, None)] == 1.0
    assert by_row[(1, 1, 0)] == 0.5 and by_row[(1, 2, 0)] == 4.0
    assert by_row[(7, 5, 6)] == 0.125 and by_row[(8, 5, 9)] == 0.5
    assert by_row[(9, None, 3)] is None and by_row[(9, 4, 3)] is None
    assert len(got) == 8


def test_left_join_fanout_equals_left_join(spark):
    from capstan.operators import left_join_fanout
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x")] * 50 + [(1, "y"), (2, "z"), (None, "n")], "k int, r string")
    def order(t):
        return (-1 if t[0] is None else t[0], t[1], t[2] or "")

    got = sorted((tuple(r) for r in left_join_fanout(left, right, ["k"]).collect()), key=order)
    want = sorted((tuple(r) for r in left.join(right, ["k"], "left").collect()), key=order)
    assert got == want
    assert left_join_fanout(left, right, ["k"]).columns == ["k", "l", "r"]


def test_left_join_fanout_lets_aqe_split_a_hot_key(spark):
    """A right-side key with a third of the rows: only the fan-out form gets a skew-split join."""
    from capstan.operators import left_join_fanout
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(200).select(F.col("id").alias("k"), F.lit("x").alias("l"))
        right = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200).alias("k"), F.col("id").alias("r"))
        fan = left_join_fanout(left, right, ["k"])
        plain = left.join(right, ["k"], "left")
        assert len(fan.collect()) == len(plain.collect()) == 30000
        assert "skew=true" in fan._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_null_safe_merge_hot_right_keys_same_rows(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10)] * 20 + [(None, 20), (None, 21), ("c", 30)], "k string, v int")
    plain = null_safe_merge(left, right, ["k"])
    hot = null_safe_merge(left, right, ["k"], hot_right_keys=True)
    assert hot.columns == plain.columns == ["k", "v_x", "v_y"]
    assert sorted(map(str, hot.collect())) == sorted(map(str, plain.collect()))


def test_ranked_null_keys_and_empty_input(spark):
    rows = [(None, 3, 1), (None, 1, 2), (None, 2, 3), (5, 1, 4), (5, 1, 5)]
    df = spark.createDataFrame(rows, "k int, d int, id int")
    got = sorted((r.id, r["rank"]) for r in ranked(df, ["k"], [F.col("d").desc(), F.col("id").desc()]).collect())
    assert got == [(1, 1), (2, 3), (3, 2), (4, 2), (5, 1)]
    empty = df.where("id < 0")
    assert ranked(empty, ["k"], [F.col("id").desc()]).count() == 0


def test_key_filter_keeps_partners_and_shuffles_little(spark):
    """Rows that pass follow the chosen keys, none with a partner is lost, and the filter comes before any exchange."""
    from pyspark.sql import functions as F

    from capstan.operators.keyfilter import key_filter
    large = spark.range(60_000).select((F.col("id") % 20_000).alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([(None, 1)], "k bigint, v bigint"))
    for n in (0, 3, 300, 20_000):
        keys = spark.range(n).select((F.col("id") * (20_000 // max(n, 1))).cast("int").alias("k"))
        got = key_filter(large, keys, "k")
        want = large.join(keys.distinct(), "k", "left_semi")
        assert got.join(keys.distinct(), "k", "left_semi").count() == want.count() == 3 * n
        assert want.count() <= got.count() <= want.count() + 0.1 * large.count()
        assert got.columns == ["k", "v"]


def test_chosen_parts_reduce_the_large_side(spark):
    """Tasks and tags are filtered by the chosen parts before they are shuffled."""
    from capstan.config import FIXTURE_CONFIG as CFG
    from capstan.plans import capacity as cap
    from capstan.sources import Sources
    src = Sources.stored_fixtures(spark, "/root/testdata/sf0.001")
    parts = [r[0] for r in src["portal_part"].select("PartNumber").orderBy("PartNumber").limit(40).collect()]
    names = spark.createDataFrame([(p,) for p in parts], "PartNumber string")
    want = sorted(map(tuple, cap.task_status_for_parts(src, CFG, names).collect()))
    assert sorted(map(tuple, cap.task_status_for_parts(src, CFG, parts).collect())) == want and want
    seen = []
    keep = cap.key_filter
    cap.key_filter = lambda large, keys, key: seen.append((key, large.count(), keep(large, keys, key).count())) or keep(large, keys, key)
    try:
        cap.task_status_for_parts(src, CFG, parts).collect()
    finally:
        cap.key_filter = keep
    assert {k for k, _, _ in seen} == {"PartID", "PartSupplierID"}
    assert all(after < 0.5 * before for _, before, after in seen)
