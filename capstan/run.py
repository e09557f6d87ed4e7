"""Command-line entry: run a report (or a snapshot load) and write it out.

    spark-submit capstan/run.py report merged --catalog supply --out /reports/merged
    python -m capstan.run report capacity_v2 --parquet /lake/supply --out /tmp/cap --format csv
    python -m capstan.run snapshot --parquet /lake/supply --sql tag_snapshot.sql \\
        --tables erp_part erp_part_tag --table /lake/snapshots/tags

Sources: ``--parquet DIR`` (one folder per domain table), ``--csv DIR``,
``--catalog DATABASE`` or ``--fixtures SF_DIR`` (tables derived from the test
data).  ``--as-of`` pins the report time (default: now).  Output is written by
parallel writers (parquet or CSV folders) and published in one step; nothing is
collected to the driver.  ``report merged`` prints the merge's row counts.  A
snapshot takes the columns that its query has; ``--arg name=value`` sets the
query's ``:name`` markers.  Scratch tables are deleted when the command ends.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.config import FIXTURE_CONFIG, Config
from capstan.operators import MergeCounts, append_snapshot, write_report
from capstan.plans import capacity as cap
from capstan.plans import pricing as pr
from capstan.plans import reports as rep
from capstan.sources import Sources
from capstan.session import scratch_scope
from capstan.sources.files import query_text, run_sql

REPORTS: dict[str, Callable[[Sources, Config], DataFrame] | None] = {
    "merged": None,                     # counted while it runs
    "capacity_v2": lambda s, c: cap.capacity_data(s, c, version=2),
    "capacity_v1": lambda s, c: cap.capacity_data(s, c, version=1),
    "task_status_list": cap.task_status_list,
    "task_status_counts": cap.task_status_counts,
    "qpv": pr.qpv_data,
    "current_price": pr.current_price,
    "task_status_for_parts": None,      # needs --parts
}


def _sources(spark: SparkSession, a: argparse.Namespace) -> Sources:
    if a.parquet:
        return Sources.parquet(spark, a.parquet)
    if a.csv:
        return Sources.csv(spark, a.csv)
    if a.catalog:
        return Sources.catalog(spark, a.catalog)
    return Sources.stored_fixtures(spark, a.fixtures)


def _config(a: argparse.Namespace) -> Config:
    base = FIXTURE_CONFIG if a.fixtures and not a.as_of else Config()
    named = {k: v for k in ("named_tag_pattern", "energy_label") if (v := getattr(a, k, None)) is not None}
    base = base.replace(**named)
    return base.replace(as_of=dt.datetime.fromisoformat(a.as_of)) if a.as_of else base


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    ap = argparse.ArgumentParser(prog="capstan.run")
    src = argparse.ArgumentParser(add_help=False)
    g = src.add_mutually_exclusive_group(required=True)
    g.add_argument("--parquet")
    g.add_argument("--csv")
    g.add_argument("--catalog")
    g.add_argument("--fixtures")
    src.add_argument("--as-of", dest="as_of", help="report time, ISO format (default: now)")
    src.add_argument("--named-tag-pattern", help="LIKE pattern of the named product tag (capacity reports need it)")
    src.add_argument("--energy-label", help="model label of parts with the named tag (capacity reports need it)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("report", parents=[src])
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("--out", required=True)
    r.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    r.add_argument("--parts", nargs="*", help="task_status_for_parts: part numbers")
    s = sub.add_parser("snapshot", parents=[src])
    s.add_argument("--sql", required=True, help="SQL file name (or path with --sql-dir)")
    s.add_argument("--sql-dir")
    s.add_argument("--tables", nargs="+", required=True, help="domain tables the SQL reads")
    s.add_argument("--table", required=True, help="snapshot table folder")
    s.add_argument("--load-date", dest="load_date", default=dt.date.today().isoformat())
    s.add_argument("--arg", action="append", default=[], metavar="NAME=VALUE", help="value of a :name marker (text)")
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    a = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"capstan-{a.cmd}").getOrCreate()
    with scratch_scope(spark):
        _run(spark, a)


def _run(spark: SparkSession, a: argparse.Namespace) -> None:
    sources, cfg = _sources(spark, a), _config(a)
    if a.cmd == "report" and a.name == "merged":
        counts = MergeCounts()
        write_report(rep.merged_capacity_cost(sources, cfg, counts), a.out, a.format)
        print("merged: " + ", ".join(f"{k} {v}" for k, v in counts.get().items()))
    elif a.cmd == "report":
        df = (cap.task_status_for_parts(sources, cfg, a.parts) if a.name == "task_status_for_parts"
              else REPORTS[a.name](sources, cfg))
        write_report(df, a.out, a.format)
    else:
        rows = run_sql(sources, query_text(a.sql, a.sql_dir), a.tables, dict(x.split("=", 1) for x in a.arg))
        rows = rows.withColumn("Load_Date", F.lit(a.load_date))
        append_snapshot(rows.select("Load_Date", *[c for c in rows.columns if c != "Load_Date"]), a.table, fmt=a.format)


if __name__ == "__main__":
    main()
