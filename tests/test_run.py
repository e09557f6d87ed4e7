"""Command-line entry: reports and snapshot loads written and read back."""

from capstan.operators import read_report
from capstan.run import main
from capstan.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_report_command_writes_the_report(spark, capsys):
    out = scratch_path(spark, "run-merged")
    main(["report", "merged", "--fixtures", SF, "--out", out], spark=spark)
    back = read_report(spark, out)
    assert len(back.columns) == 42 and back.count() > 0
    said = capsys.readouterr().out
    assert f"merged_rows {back.count()}" in said and "left_null_keys" in said and "matched_rows" in said


def test_command_deletes_its_scratch_tables(spark):
    from capstan import session
    from capstan.operators.versions import Files
    made = []
    keep = session.scratch_path
    out = keep(spark, "run-clean")
    before = len(session._SCRATCH)
    main(["report", "capacity_v2", "--fixtures", SF, "--out", out], spark=spark)
    assert len(session._SCRATCH) == before and read_report(spark, out).count() > 0
    with session.scratch_scope(spark):
        made.append(session.scratch_path(spark, "inside"))
        spark.range(3).write.parquet(made[0])
        assert Files(spark, made[0]).exists(made[0])
    assert not Files(spark, made[0]).exists(made[0])


def test_parts_report_and_snapshot_command(spark):
    out = scratch_path(spark, "run-parts")
    main(["report", "task_status_for_parts", "--fixtures", SF, "--out", out, "--format", "csv",
          "--parts", "P000010", "P000011", "P000012"], spark=spark)
    table = scratch_path(spark, "run-snap")
    for day in ("2020-01-01", "2020-01-02", "2020-01-02"):          # the rerun of a day replaces it
        main(["snapshot", "--fixtures", SF, "--sql", "part_supplier_tasks.sql",
              "--tables", "portal_part_supplier", "portal_task", "--table", table, "--load-date", day],
             spark=spark)
    snap = spark.read.parquet(table)
    per_day = {str(r.Load_Date): r["count"] for r in snap.groupBy("Load_Date").count().collect()}
    assert len(per_day) == 2 and per_day["2020-01-01"] == per_day["2020-01-02"] > 0


def test_as_of_and_config_selection():
    import argparse
    import datetime as dt

    from capstan.config import FIXTURE_CONFIG
    from capstan.run import _config
    fixtures = argparse.Namespace(fixtures=SF, as_of=None)
    assert _config(fixtures) == FIXTURE_CONFIG
    pinned = _config(argparse.Namespace(fixtures=None, as_of="2017-08-15T09:30:00"))
    assert pinned.as_of == dt.datetime(2017, 8, 15, 9, 30) and pinned.excluded_user_ids == (2586, 2583, 2584)
