"""Sinks and sources: report round trips, snapshot appends, SQL files, streaming snapshots."""

from pyspark.sql.types import StringType, StructField, StructType

from capstan.operators import append_snapshot, read_report, read_snapshot, snapshot_append, write_report
from capstan.session import scratch_path

SCHEMA = StructType([StructField(n, StringType()) for n in ("Load_Date", "PartNumber", "ECOStatus", "TQPStatus")])


def _hist(spark):
    return spark.createDataFrame([("2020-01-01", "P1", "A", "x"), ("2020-01-01", "P2", None, "y")],
                                 "Load_Date string, PartNumber string, ECOStatus string, TQPStatus string")


def _inc(spark):
    return spark.createDataFrame([("2020-01-08", "P1", "B")], "Load_Date string, PartNumber string, ECOStatus string")


def test_snapshot_append_union_by_name(spark):
    out = snapshot_append(_hist(spark), _inc(spark))
    assert out.columns == ["Load_Date", "PartNumber", "ECOStatus", "TQPStatus"]
    assert sorted(tuple(r) for r in out.collect())[-1] == ("2020-01-08", "P1", "B", None)


def test_append_snapshot_rerun_does_not_duplicate(spark):
    for fmt in ("parquet", "csv"):
        path = scratch_path(spark, f"snap-test-{fmt}")
        append_snapshot(_hist(spark), path, SCHEMA, fmt=fmt)
        append_snapshot(_inc(spark), path, SCHEMA, fmt=fmt)
        append_snapshot(_inc(spark), path, SCHEMA, fmt=fmt)     # same load date again: replaced, not added
        got = read_snapshot(spark, path, SCHEMA, fmt=fmt)
        assert got.count() == 3
        assert got.where("Load_Date = '2020-01-08'").collect()[0].TQPStatus is None
        plan = got.where("Load_Date = '2020-01-01'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(Load_Date" in plan


def test_report_round_trip(spark):
    df = _hist(spark)
    for fmt in ("parquet", "csv"):
        path = scratch_path(spark, f"report-test-{fmt}")
        write_report(df, path, fmt)
        write_report(df, path, fmt)                                # overwrite, not append
        back = read_report(spark, path, fmt, schema=SCHEMA if fmt == "csv" else None)
        assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_streaming_snapshots_exactly_once_across_runs(spark):
    from capstan.streaming import accumulate_snapshots, land_increment, read_snapshots
    base = scratch_path(spark, "stream-test")
    landing, table, ckpt = f"{base}/landing", f"{base}/table", f"{base}/ckpt"
    land_increment(_hist(spark), landing, SCHEMA)
    accumulate_snapshots(spark, landing, table, ckpt, SCHEMA).awaitTermination()
    assert read_snapshots(spark, table, SCHEMA).count() == 2
    accumulate_snapshots(spark, landing, table, ckpt, SCHEMA).awaitTermination()    # nothing new landed
    assert read_snapshots(spark, table, SCHEMA).count() == 2
    land_increment(_inc(spark), landing, SCHEMA)
    accumulate_snapshots(spark, landing, table, ckpt, SCHEMA).awaitTermination()
    got = read_snapshots(spark, table, SCHEMA)
    assert got.count() == 3
    assert got.where("Load_Date = '2020-01-08'").first().TQPStatus is None


def _failing(spark, like):
    """Rows of which the last task fails, after others were written."""
    from pyspark.sql import functions as F
    bad = F.when(F.col("id") == 399, F.raise_error(F.lit("broken input"))).otherwise(F.lit("P9"))
    return spark.range(0, 400, 1, 4).select(F.lit("2020-02-02").alias("Load_Date"), bad.cast("string").alias("PartNumber"),
                                            F.lit("C").alias("ECOStatus"), F.lit("z").alias("TQPStatus")).select(like.columns)


def test_failed_replace_leaves_the_old_report(spark):
    import pytest
    from capstan.operators.versions import Files, VERSIONS
    df = _hist(spark)
    for fmt in ("parquet", "csv"):
        path = scratch_path(spark, f"report-fail-{fmt}")
        schema = SCHEMA if fmt == "csv" else None
        with pytest.raises(FileNotFoundError):
            read_report(spark, path, fmt, schema=SCHEMA)
        with pytest.raises(Exception, match="broken input"):
            write_report(_failing(spark, df), path, fmt)            # the first write fails: still no report
        with pytest.raises(FileNotFoundError):
            read_report(spark, path, fmt, schema=SCHEMA)
        write_report(df, path, fmt)
        want = sorted(map(tuple, df.collect()))
        for _ in range(2):
            with pytest.raises(Exception, match="broken input"):
                write_report(_failing(spark, df), path, fmt)
            assert sorted(map(tuple, read_report(spark, path, fmt, schema=schema).collect())) == want
        assert len(Files(spark, path).names(f"{path}/{VERSIONS}")) == 1             # what the failed runs wrote is gone
        reader = read_report(spark, path, fmt, schema=schema)
        write_report(read_report(spark, path, fmt, schema=schema).limit(1), path, fmt)         # a report may read what it replaces
        assert reader.count() == 2 and read_report(spark, path, fmt, schema=schema).count() == 1    # a running reader keeps its version
        for _ in range(3):
            write_report(df, path, fmt)
        assert len(Files(spark, path).names(f"{path}/{VERSIONS}")) == 2


def test_report_written_straight_into_its_folder_is_read_until_replaced(spark):
    path = scratch_path(spark, "report-plain")
    _hist(spark).write.parquet(path)
    assert read_report(spark, path).count() == 2
    write_report(read_report(spark, path).limit(1), path)
    assert read_report(spark, path).count() == 1
    spark.range(3).write.parquet(f"{path}/.versions/notes")            # not a version: left alone
    write_report(_hist(spark), path)
    assert read_report(spark, path).count() == 2 and spark.read.parquet(f"{path}/.versions/notes").count() == 3


def test_publishing_fails_before_the_pointer_changes(spark, monkeypatch):
    import pytest
    from capstan.operators import versions
    path = scratch_path(spark, "report-pointer")
    write_report(_hist(spark), path)

    def lost(self, p, text):
        raise OSError("store went away")

    monkeypatch.setattr(versions.Files, "replace", lost)
    with pytest.raises(OSError):
        write_report(_hist(spark).limit(1), path)
    monkeypatch.undo()
    assert read_report(spark, path).count() == 2


def test_snapshot_takes_new_columns(spark):
    import pytest
    from capstan.operators import stored_columns
    loads = [spark.createDataFrame([("d1", "P1", 1, 1.5)], "Load_Date string, part string, n int, old float"),
             spark.createDataFrame([("d2", "P2", 2**40, "new")], "Load_Date string, part string, n bigint, note string"),
             spark.createDataFrame([("d3", None, True)], "Load_Date string, part string, flag boolean").selectExpr("*", "null as later"),
             spark.createDataFrame([("d4", 0.25, 7)], "Load_Date string, old double, later int")]
    want = [("d1", "P1", 1, 1.5, None, None, None), ("d2", "P2", 2**40, None, "new", None, None), ("d3", None, None, None, None, True, None),
            ("d4", None, None, 0.25, None, None, 7)]
    for fmt in ("parquet", "csv"):
        path = scratch_path(spark, f"snap-evolve-{fmt}")
        for load in loads:
            append_snapshot(load, path, fmt=fmt)
        append_snapshot(loads[1], path, fmt=fmt)                    # a rerun replaces its date
        got = read_snapshot(spark, path, fmt=fmt)
        assert got.columns == ["Load_Date", "part", "n", "old", "note", "flag", "later"]
        assert sorted(map(tuple, got.collect())) == want
        assert "PartitionFilters: [isnotnull(Load_Date" in got.where("Load_Date = 'd1'")._jdf.queryExecution().executedPlan().toString()
    before = stored_columns(spark, path)
    with pytest.raises(ValueError, match="column n was bigint and is string"):
        append_snapshot(loads[0].selectExpr("'d5' as Load_Date", "'x' as n"), path, fmt=fmt)
    assert stored_columns(spark, path) == before and read_snapshot(spark, path, fmt=fmt).count() == 4
    with pytest.raises(ValueError, match="not in the snapshot's schema: extra"):
        append_snapshot(_inc(spark).selectExpr("*", "1 as extra"), scratch_path(spark, "snap-fixed"), SCHEMA)


def test_failed_load_keeps_earlier_loads(spark):
    import pytest
    path = scratch_path(spark, "snap-fail")
    append_snapshot(_hist(spark), path)
    with pytest.raises(Exception, match="broken input"):
        append_snapshot(_failing(spark, _hist(spark)), path)
    assert sorted(map(tuple, read_snapshot(spark, path).collect())) == sorted(map(tuple, _hist(spark).collect()))
