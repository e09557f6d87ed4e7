"""Every CASE branch, NULL operand and boundary of the label functions."""

import datetime as dt

from pyspark.sql import functions as F

from capstan import config as C
from capstan.functions import (calendar_cutoff, capacity_status, effective_status, elapsed_cutoff, model_label,
                               previous_month_end, program_label, task_status)

AS_OF = dt.datetime(1998, 6, 15, 12, 0)


def _eval(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_effective_status_branches(spark):
    d = dt.datetime
    rows = [(d(1997, 1, 1), d(2000, 1, 1)),    # inside
            (AS_OF, AS_OF),                      # both ends inclusive
            (d(1997, 1, 1), d(1998, 1, 1)),    # ended
            (d(1999, 1, 1), d(2000, 1, 1)),    # not started
            (None, d(2000, 1, 1)),             # start missing, not ended: BETWEEN is NULL
            (None, d(1998, 1, 1)),             # start missing but ended -> Past
            (d(1999, 1, 1), None),             # end missing but not started -> Future
            (None, None)]
    out = _eval(spark, rows, "s timestamp_ntz, e timestamp_ntz", effective_status(AS_OF, F.col("s"), F.col("e")))
    assert out == ["Current", "Current", "Past", "Future", "Dates missing", "Past", "Future", "Dates missing"]


def test_task_status_v2_branches(spark):
    rows = [("Approved", None, 3, None, None),           # legacy beats everything
            ("Pending", None, 3, None, None),            # undefined part
            (None, None, None, None, None),              # no part supplier at all
            (None, 1, 3, None, None), (None, 1, None, 4, None), (None, 1, None, None, 4),
            (None, 1, 4, None, None), (None, 1, 2, 1, None),       # score 1 -> Rejected before Not Reviewed
            (None, 1, 2, None, None), (None, 1, 1, None, None), (None, 1, 7, None, None),
            (None, 1, None, None, None), (None, 1, 5, None, None), (None, 1, 6, None, None)]
    expr = task_status(F.col("pp"), F.col("d"), F.col("s"), F.col("t"), F.col("t1"))
    out = _eval(spark, rows, "pp string, d int, s int, t int, t1 int", expr)
    assert out == [C.TASK_LEGACY, C.TASK_UNDEFINED, C.TASK_UNDEFINED, "Approved", "Approved", "Approved",
                   "Rejected", "Rejected", "Not Reviewed", "Not Submitted", "PCR Pending", "Not Required",
                   "Not Required", None]


def test_task_status_v1_rollup_and_no_pcr(spark):
    rows = [(1, None, 1, 0, 0, 0), (1, None, 0, 1, 0, 0), (1, None, 0, 0, 1, 0), (1, None, 0, 0, 0, 1),
            (1, 7, None, None, None, None),   # no PCR branch: 7 falls through to NULL
            (1, None, None, None, None, None)]
    rollup = {k: F.col(k) for k in ("Approved", "Rejected", "Submitted", "Required")}
    expr = task_status(F.lit("x"), F.col("d"), F.col("s"), F.lit(None).cast("int"), F.lit(None).cast("int"),
                       rollup=rollup, pcr_pending=False)
    out = _eval(spark, rows, "d int, s int, Approved int, Rejected int, Submitted int, Required int", expr)
    assert out == ["Approved", "Rejected", "Not Reviewed", "Not Submitted", None, "Not Required"]


def test_model_and_program_labels(spark):
    rows = [(True, True, True, True, None), (False, True, True, None, None), (None, True, False, None, None),
            (None, None, True, None, None), (None, None, None, True, None), (None, None, None, None, None),
            (None, None, None, None, "Rework"), (None, None, None, None, "Regular"), (True, None, None, None, "New")]
    schema = "m3 boolean, mx boolean, ms boolean, te boolean, tag string"
    model = _eval(spark, rows, schema, model_label(F.col("m3"), F.col("mx"), F.col("ms"), F.col("te"), C.FIXTURE_CONFIG.energy_label))
    assert model == [C.MODEL_3, C.MODEL_SHARED_SX, C.MODEL_X, C.MODEL_S, C.FIXTURE_CONFIG.energy_label, C.MODEL_OTHER,
                     C.MODEL_OTHER, C.MODEL_OTHER, C.MODEL_3]
    prog = _eval(spark, rows, schema, program_label(F.col("tag"), F.col("m3"), F.col("ms"), F.col("mx"), F.col("te")))
    assert prog == ["Model 3", C.PROGRAM_EXISTING, C.PROGRAM_EXISTING, C.PROGRAM_EXISTING, C.PROGRAM_EXISTING,
                    None, "Rework", None, "New"]


def test_capacity_status_branches(spark):
    rows = [(10, 10), (11, 10), (9, 10), (9, None), (None, 10), (None, None)]
    out = _eval(spark, rows, "v int, q int", capacity_status(F.col("v"), F.col("q"), "Measured"))
    assert out == ["Measured capacity greater than quoted", "Measured capacity greater than quoted",
                   "Measured capacity less than quoated", "No Quoted data", "No Measured data", "No data"]


def test_date_helpers():
    assert previous_month_end(dt.datetime(2017, 8, 15)) == dt.datetime(2017, 7, 31)
    assert previous_month_end(dt.datetime(2018, 1, 3, 10)) == dt.datetime(2017, 12, 31)
    # elapsed vs calendar days: 1 Jan 23:00 -> 8 Jan 01:00 is 6 days 2 hours elapsed but 7 midnights
    as_of, d = dt.datetime(2020, 1, 8, 1), dt.datetime(2020, 1, 1, 23)
    assert d > elapsed_cutoff(as_of, 7)
    assert not d >= calendar_cutoff(as_of, 7)
    assert dt.datetime(2020, 1, 2, 0) >= calendar_cutoff(as_of, 7)


def test_ts_lit_is_wall_clock_in_any_session_zone(spark):
    from capstan.functions import ts_lit
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = spark.range(1).select(ts_lit(AS_OF).cast("string").alias("t")).first().t
            assert got == "1998-06-15 12:00:00", (tz, got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
