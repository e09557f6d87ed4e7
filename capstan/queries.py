"""Registry of the report queries over the driver test tables.

``QUERIES[key](spark, sf_dir) -> DataFrame`` runs one operator or report with
``FIXTURE_CONFIG`` over the domain tables derived from the driver parquet
files in ``sf_dir``.  The derived tables that a query needs are written once
per application under ``spark.checkpoint.dir`` (``Sources.stored_fixtures``) and
read from there, like stored source tables.  Every derived table keeps all rows
of what it derives from, and every query reads whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from capstan.config import FIXTURE_CONFIG as CFG
from capstan.operators import (MergeCounts, append_snapshot, buyer_users, latest_enabled_tags, named_tag_members, read_report,
                               read_snapshot, rollup_flags, write_report)
from capstan.plans import capacity as cap
from capstan.plans import pricing as pr
from capstan.plans import reports as rep
from capstan.session import scratch_path
from capstan.sources import Sources
from capstan.sources.files import sql_file_report
from capstan.sources.layout import store_by_day
from capstan.sources.tables import plain
from capstan.streaming import accumulate_snapshots, land_increment, read_snapshots

Query = Callable[[SparkSession, str], DataFrame]

SNAPSHOT_SCHEMA = StructType([StructField(n, StringType()) for n in
                              ("Load_Date", "PartNumber", "ECOStatus", "PartSystem", "TQPStatus")])


def _src(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources.stored_fixtures(spark, sf_dir)


def _on_src(fn) -> Query:
    return lambda spark, sf_dir: fn(_src(spark, sf_dir), CFG)


def _latest_enabled_tag(spark, sf_dir):
    s = _src(spark, sf_dir)
    return latest_enabled_tags(s["portal_part_tag"], (CFG.tag_model_s, CFG.tag_model_x, CFG.tag_model_3))


def _any_enabled_named_tag(spark, sf_dir):
    s = _src(spark, sf_dir)
    return named_tag_members(s["portal_part_tag"], s["portal_tag"], CFG)


def _task_status_for_parts(spark, sf_dir):
    s = _src(spark, sf_dir)
    # the chosen parts: every part number of the BOM explosions
    return cap.task_status_for_parts(s, CFG, s["erp_bom_explosion"].select("DetailPartNumber"))


def _part_tag_flags(spark, sf_dir):
    s = _src(spark, sf_dir)
    f = cap.part_tag_flags(s, CFG)
    return f.select("PartID", *[F.col(c).cast("int").alias(c) for c in
                                ("is_model_s", "is_model_x", "is_model_3", "is_energy")])


def _three_key_merge(spark, sf_dir):
    s = _src(spark, sf_dir)
    return rep.three_key_merge(s["portal_dashboard"], s["erp_dashboard"])


def _dashboard_left_merge(spark, sf_dir):
    s = _src(spark, sf_dir)
    return rep.dashboard_left_merge(s["portal_dashboard"], s["erp_dashboard"])


def _lower(df: DataFrame) -> DataFrame:
    return df.select(F.col("PartNumber").alias("partnumber"), F.col("SupplierCode").alias("suppliercode"),
                     F.col("value"))


def _qualification_left_merge(spark, sf_dir):
    s = _src(spark, sf_dir)
    return rep.qualification_left_merge(_lower(s["erp_dashboard"]), _lower(s["portal_dashboard"]))


def _snapshot_append(spark, sf_dir):
    s = _src(spark, sf_dir)
    path = scratch_path(spark, "snapshot")
    append_snapshot(s["snapshot_history"], path, SNAPSHOT_SCHEMA)
    append_snapshot(s["snapshot_increment"], path, SNAPSHOT_SCHEMA)
    return read_snapshot(spark, path, SNAPSHOT_SCHEMA)


def _snapshot_stream(spark, sf_dir):
    s = _src(spark, sf_dir)
    base = scratch_path(spark, "snapshot-stream")
    landing, table, ckpt = f"{base}/landing", f"{base}/table", f"{base}/checkpoint"
    land_increment(s["snapshot_history"], landing, SNAPSHOT_SCHEMA)
    accumulate_snapshots(spark, landing, table, ckpt, SNAPSHOT_SCHEMA).awaitTermination()
    land_increment(s["snapshot_increment"], landing, SNAPSHOT_SCHEMA)
    accumulate_snapshots(spark, landing, table, ckpt, SNAPSHOT_SCHEMA).awaitTermination()
    return read_snapshots(spark, table, SNAPSHOT_SCHEMA)


def _report_write(spark, sf_dir):
    s = _src(spark, sf_dir)
    path = scratch_path(spark, "report")
    write_report(pr.qpv_data(s, CFG), path, "parquet")
    return read_report(spark, path, "parquet")


def _report_write_csv(spark, sf_dir):
    s = _src(spark, sf_dir)
    path = scratch_path(spark, "report-csv")
    report = pr.qpv_data(s, CFG)
    write_report(report, path, "csv")
    return read_report(spark, path, "csv", report.schema)


def _snapshot_append_csv(spark, sf_dir):
    s = _src(spark, sf_dir)
    path = scratch_path(spark, "snapshot-csv")
    append_snapshot(s["snapshot_history"], path, SNAPSHOT_SCHEMA, fmt="csv")
    append_snapshot(s["snapshot_increment"], path, SNAPSHOT_SCHEMA, fmt="csv")
    return read_snapshot(spark, path, SNAPSHOT_SCHEMA, fmt="csv")


def _part_supplier_lookup_ci(spark, sf_dir):
    s = _src(spark, sf_dir)
    mixed = Sources(spark, lambda n: s["portal_part_supplier_mixed" if n == "portal_part_supplier" else n])
    return plain(cap.part_supplier_lookup(mixed.collated(), CFG))


def _sql_file_report(spark, sf_dir):
    s = _src(spark, sf_dir)
    return sql_file_report(s, "part_supplier_tasks.sql", ["portal_part_supplier", "portal_task"])


def _report_replace(spark, sf_dir):
    """A report replaced by another one that reads it."""
    s = _src(spark, sf_dir)
    path = scratch_path(spark, "report-replaced")
    write_report(cap.task_status_list(s, CFG), path)
    write_report(read_report(spark, path).groupBy("TaskStatus", "Program").agg(F.count("*").alias("part_count")), path)
    return read_report(spark, path)


def _snapshot_evolving(spark, sf_dir):
    """Three loads with different columns: one has a column less, one has two new ones."""
    s = _src(spark, sf_dir)
    path = scratch_path(spark, "snapshot-evolving")
    for load in ("snapshot_history", "snapshot_increment", "snapshot_wider"):
        append_snapshot(s[load], path)
    return read_snapshot(spark, path)


def _dashboard_merge_classes(spark, sf_dir):
    s = _src(spark, sf_dir)
    path = scratch_path(spark, "dashboard-groups")
    rep.dashboard_groups(s["portal_dashboard"], s["erp_dashboard"]).write(path)
    return read_report(spark, f"{path}/classes")


def _three_key_merge_groups(spark, sf_dir):
    """The merge written in linear space, read back and expanded."""
    s = _src(spark, sf_dir)
    path = scratch_path(spark, "three-key-groups")
    groups = rep.three_key_groups(s["portal_dashboard"], s["erp_dashboard"])
    groups.write(path)
    return groups.read(spark, path, groups.on).expand()


def _bom_usage_by_day(spark, sf_dir):
    by_day = store_by_day(_src(spark, sf_dir), scratch_path(spark, "explosions-by-day"))
    return pr.bom_usage_latest(by_day, CFG)


def _supplier_tasks_since(spark, sf_dir):
    args = {"since": dt.datetime(1995, 6, 17), "task_id": CFG.capacity_task_id, "open_status": 2, "review_status": 5}
    return sql_file_report(_src(spark, sf_dir), "supplier_tasks_since.sql", ["portal_task", "portal_part_supplier"], args=args)


def _csv_rejected_rows(spark, sf_dir):
    """The task table as CSV text with broken rows: what the reader sets aside, and how many rows it keeps."""
    s = _src(spark, sf_dir)
    root = scratch_path(spark, "csv-broken")
    t = s["portal_task"]
    status = F.when(F.col("PartSupplierTaskID") % 41 == 5, F.lit("n/a")).otherwise(F.col("StatusID").cast("string"))
    broken = t.select(*[status.alias(c) if c == "StatusID" else F.col(c) for c in t.columns])
    broken.write.option("header", True).csv(f"{root}/portal_task")
    tasks = Sources.csv(spark, root)
    rejected = tasks.rejected("portal_task").select(F.split("row", ",")[0].cast("bigint").alias("PartSupplierTaskID"), F.lit("rejected").alias("kind"))
    return rejected.unionByName(tasks["portal_task"].select("PartSupplierTaskID", F.lit("read").alias("kind")))


def _merge_counts(spark, sf_dir):
    """Row counts taken while the merged report is written."""
    counts = MergeCounts()
    write_report(rep.merged_capacity_cost(_src(spark, sf_dir), CFG, counts), scratch_path(spark, "merged-counted"))
    got = counts.get()
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} bigint" for k in got))


QUERIES: dict[str, Query] = {
    # capacity: building blocks
    "purchased_parts": lambda spark, sf: cap.purchased_parts(_src(spark, sf), CFG)
    .select("PartID", "PartNumber", "Description", "SupplierID", "SupplierCode", "SupplierName"),
    "buyer_users": lambda spark, sf: buyer_users(_src(spark, sf)["portal_user"], CFG),
    "part_supplier_lookup": _on_src(cap.part_supplier_lookup),
    "user_manager_lookup": _on_src(cap.user_manager_lookup),
    "latest_enabled_tag": _latest_enabled_tag,
    "any_enabled_named_tag": _any_enabled_named_tag,
    "part_tag_flags": _part_tag_flags,
    "model_label": _on_src(cap.model_labels),
    "program_label": _on_src(cap.program_labels),
    "effective_status": _on_src(cap.effective_statuses),
    "task_status_v1": _on_src(cap.task_status_v1),
    "task_status_v2": _on_src(cap.task_status_v2),
    "task_rollup_max": lambda spark, sf: rollup_flags(_src(spark, sf)["portal_task"], CFG),
    "task_rollup_max_40": lambda spark, sf: rollup_flags(_src(spark, sf)["portal_task"], CFG,
                                                         task_id=CFG.capacity_task_id),
    "latest_capacity_task": _on_src(cap.latest_capacity_task),
    "ranked_scored_tasks": _on_src(cap.ranked_scored_tasks),
    "latest_contract_quote": _on_src(cap.latest_contract_quote),
    "latest_current_capacity": _on_src(cap.latest_current_capacity),
    "capacity_lines": _on_src(cap.capacity_lines),
    "measured_status": _on_src(cap.measured_status),
    "designed_status": _on_src(cap.designed_status),
    # capacity: reports
    "capacity_info_v1": lambda spark, sf: cap.capacity_info(_src(spark, sf), CFG, version=1),
    "capacity_info_v2": lambda spark, sf: cap.capacity_info(_src(spark, sf), CFG, version=2),
    "capacity_data_v1": lambda spark, sf: cap.capacity_data(_src(spark, sf), CFG, version=1),
    "capacity_data_v2": lambda spark, sf: cap.capacity_data(_src(spark, sf), CFG, version=2),
    "task_status_list": _on_src(cap.task_status_list),
    "task_status_for_parts": _task_status_for_parts,
    "task_status_counts": _on_src(cap.task_status_counts),
    # pricing / QPV
    "recent_bom_parts": lambda spark, sf: pr.recent_bom_parts(_src(spark, sf), CFG).distinct(),
    "bom_usage_latest": _on_src(pr.bom_usage_latest),
    "open_po_prices": _on_src(pr.open_po_prices),
    "date_priced_parts": _on_src(pr.date_priced_parts),
    "non_date_priced": _on_src(pr.non_date_priced),
    "month_end_fx": _on_src(pr.month_end_fx),
    "date_based_prices": _on_src(pr.date_based_prices),
    "price_candidates": _on_src(pr.price_candidates),
    "current_price": _on_src(pr.current_price),
    "unit_conversion": _on_src(pr.unit_conversion),
    "qpv_data": _on_src(pr.qpv_data),
    # merged reports, sources and sinks
    "merged_capacity_cost": _on_src(rep.merged_capacity_cost),
    "three_key_merge": _three_key_merge,
    "dashboard_left_merge": _dashboard_left_merge,
    "qualification_left_merge": _qualification_left_merge,
    "snapshot_append": _snapshot_append,
    "snapshot_stream": _snapshot_stream,
    "report_write": _report_write,
    "report_write_csv": _report_write_csv,
    "snapshot_append_csv": _snapshot_append_csv,
    "part_supplier_lookup_ci": _part_supplier_lookup_ci,
    "dashboard_left_merge_sql_nulls": lambda spark, sf: rep.dashboard_left_merge(
        _src(spark, sf)["portal_dashboard"], _src(spark, sf)["erp_dashboard"], null_keys="never"),
    "sql_file_report": _sql_file_report,
    "report_replace": _report_replace,
    "snapshot_evolving": _snapshot_evolving,
    "dashboard_merge_classes": _dashboard_merge_classes,
    "three_key_merge_groups": _three_key_merge_groups,
    "bom_usage_by_day": _bom_usage_by_day,
    "supplier_tasks_since": _supplier_tasks_since,
    "csv_rejected_rows": _csv_rejected_rows,
    "merge_counts": _merge_counts,
}
