"""Capacity reports: part/supplier/task base ("info"), capacity study lines,
task-status lists.

Plan shape (current version)::

    purchased parts ⋈ supplier                      (filter FabricatedFlag, SupplierCode)
      ⟕ part-supplier on (PartNumber, SupplierCode)
      ⟕ part-supplier tag                           (small dimension)
      ⟕ tag flags (top-1 window + aggregation)      -> program filter
      ⟕ capacity tasks (task 40)                    (fan-out join, skew-safe)
      ⟕ SIE user, manager; buyer users, manager     (user dimension)
      -> distinct info rows
      ⟕ latest contract quote and current capacity (one top-1 window over the lines)

Every step before the task join is per part, so the program filter runs on
parts, not on tasks.  Left joins that contribute no
column and whose fan-out the final DISTINCT removes (the enabled part-tag
join, the status lookup, the latest-task join of the current version) are
not part of the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan import config as C
from capstan.config import Config
from capstan.functions.labels import capacity_status, effective_status, model_label, program_label, task_status
from capstan.operators.joins import join_splittable, left_join_fanout
from capstan.operators.keyfilter import key_filter
from capstan.operators.latest import latest_per_key, ranked
from capstan.operators.rollup import rollup_flags
from capstan.operators.tags import tag_flags
from capstan.operators.users import buyer_users, with_user
from capstan.session import stored_table
from capstan.sources import Sources

INFO_COLUMNS = ["SupplierCode", "SupplierName", "PartSupplierTaskID", "PartSupplierID", "ProgramTag", "PartID",
                "PartNumber", "PartDescription", "EarliestEffectiveDateInBOM", "EffectiveStatus", "LatestEndDate",
                "PartIDX", "PartIDS", "PartID3", "PartIDte", "SIEUserID", "SIE", "SIEManager", "GSM", "GSMManager",
                "TaskStatus", "Model"]

REPORT_INFO_COLUMNS = ["PartSupplierTaskID", "SupplierCode", "CapSupplierName", "SIE", "SIEManager", "GSM",
                       "GSMManager", "PartID", "PartNumber", "PartDescription", "ProgramTag", "PartSupplierID",
                       "Model", "EarliestEffectiveDateInBOM", "LatestEffectiveDate", "EffectiveStatus", "Program",
                       "TaskStatus"]

REPORT_COLUMNS = ["PartSupplierTaskID", "SupplierCode", "CapSupplierName", "SIE", "SIEManager", "GSM",
                  "GSMManager", "PartID", "PartNumber", "PartDescription", "ProgramTag", "PartSupplierID", "Model",
                  "EarliestEffectiveDateInBOM", "LatestEffectiveDate", "EffectiveStatus", "Program", "QuoteDate",
                  "Quoted", "Other4CreateDate", "Measured", "Potential", "Designed", "Theoretical", "TaskStatus",
                  "MeasuredStatus", "DesignedStatus"]


# --------------------------------------------------------------- building blocks
def purchased_parts(src: Sources, cfg: Config) -> DataFrame:
    """Non-fabricated parts with their preferred supplier (inner join: supplier must exist)."""
    p = src["portal_part"].where(F.col("FabricatedFlag") == 0)
    s = src["portal_supplier"].select("SupplierID", "SupplierCode", F.col("Name").alias("SupplierName"))
    return p.join(s, F.col("PreferredSupplierID") == F.col("SupplierID"), "inner")


def part_supplier_lookup(src: Sources, cfg: Config) -> DataFrame:
    """Purchased parts ⟕ part-supplier on the composite (PartNumber, SupplierCode) key."""
    ps = src["portal_part_supplier"].select("PartNumber", "SupplierCode", "PartSupplierID", "PPAPStatus",
                                            "IsPartDefined", "PartSupplierTagID")
    return (purchased_parts(src, cfg).select("PartID", "PartNumber", "SupplierCode")
            .join(ps, ["PartNumber", "SupplierCode"], "left"))


def user_manager_lookup(src: Sources, cfg: Config) -> DataFrame:
    """Every part with its SIE, the SIE's manager, its buyer user(s) and their managers."""
    users = src["portal_user"]
    p = src["portal_part"].select("PartID", "SIEUserID", "BuyerCode")
    p = with_user(p, users, on="SIEUserID", user_key="UserID", name_as="SIE", manager_as="SIEManager")
    return with_user(p, buyer_users(users, cfg), on="BuyerCode", user_key="SAPUserID", name_as="GSM",
                     manager_as="GSMManager", managers=users)


def part_tag_flags(src: Sources, cfg: Config, parts: DataFrame | None = None) -> DataFrame:
    """Tag flags per part; with ``parts`` only tags that can belong to one of them are shuffled."""
    tags = src["portal_part_tag"]
    return tag_flags(tags if parts is None else key_filter(tags, parts, "PartID"), src["portal_tag"], cfg)


def model_labels(src: Sources, cfg: Config) -> DataFrame:
    """Model label of every part."""
    f = part_tag_flags(src, cfg)
    p = src["portal_part"].select("PartID").join(f, "PartID", "left")
    return p.select("PartID", model_label(F.col("is_model_3"), F.col("is_model_x"), F.col("is_model_s"),
                                          F.col("is_energy"), cfg.required("energy_label")).alias("Model"))


def program_labels(src: Sources, cfg: Config) -> DataFrame:
    """Program label of every part-supplier."""
    tag = src["portal_ps_tag"].select("PartSupplierTagID", F.col("Tag").alias("ProgramTag"))
    ps = (src["portal_part_supplier"].select("PartSupplierID", "PartID", "PartSupplierTagID")
          .join(tag, "PartSupplierTagID", "left").join(part_tag_flags(src, cfg), "PartID", "left"))
    return ps.select("PartSupplierID", "PartID", "ProgramTag",
                     program_label(F.col("ProgramTag"), F.col("is_model_3"), F.col("is_model_s"),
                                   F.col("is_model_x"), F.col("is_energy")).alias("Program"))


def effective_statuses(src: Sources, cfg: Config) -> DataFrame:
    p = src["portal_part"]
    return p.select("PartID", "EarliestEffectiveDateInBOM", "LatestEndDate",
                    effective_status(cfg.as_of_ts(), F.col("EarliestEffectiveDateInBOM"),
                                     F.col("LatestEndDate")).alias("EffectiveStatus"))


def capacity_tasks(src: Sources, cfg: Config) -> DataFrame:
    return (src["portal_task"].where(F.col("TaskID") == cfg.capacity_task_id)
            .select("PartSupplierID", "PartSupplierTaskID", "TaskID", "StatusID", "TaskScore", "TaskScore1"))


def latest_capacity_task(src: Sources, cfg: Config) -> DataFrame:
    """Latest capacity task per part-supplier by coalesce(ModifyDate, CreateDate)."""
    t = src["portal_task"].where(F.col("TaskID") == cfg.capacity_task_id)
    latest = latest_per_key(t, ["PartSupplierID"], [F.coalesce("ModifyDate", "CreateDate").desc_nulls_last(),
                                                    F.col("PartSupplierTaskID").desc()])
    return latest.select("PartSupplierID", "PartSupplierTaskID", "StatusID", "TaskScore", "TaskScore1")


def ranked_scored_tasks(src: Sources, cfg: Config) -> DataFrame:
    """Scored capacity tasks numbered per part-supplier (newest first), all rows kept."""
    t = (src["portal_task"].where((F.col("TaskID") == cfg.capacity_task_id)
                                  & (F.col("TaskScore").isNotNull() | F.col("TaskScore1").isNotNull()))
         .select("PartSupplierID", "PartSupplierTaskID", "StatusID", "TaskScore", "TaskScore1", "ModifyDate",
                 "CreateDate"))
    r = ranked(t, ["PartSupplierID"], [F.coalesce("ModifyDate", "CreateDate").desc_nulls_last(),
                                       F.col("PartSupplierTaskID").desc()])
    return r.select("PartSupplierID", "PartSupplierTaskID", "StatusID", "TaskScore", "TaskScore1", "rank")


def task_status_v2(src: Sources, cfg: Config) -> DataFrame:
    """Current task status of each part-supplier × capacity task."""
    ps = src["portal_part_supplier"].select("PartSupplierID", "PPAPStatus", "IsPartDefined")
    x = ps.join(capacity_tasks(src, cfg), "PartSupplierID", "left")
    return x.select("PartSupplierID", "PartSupplierTaskID", _task_status(x, None, True).alias("TaskStatus"))


def task_status_v1(src: Sources, cfg: Config) -> DataFrame:
    """Earlier task status (rollup flags OR-ed in, no PCR branch), distinct per task name."""
    ps = src["portal_part_supplier"].select("PartSupplierID", "PPAPStatus", "IsPartDefined")
    r = _prefixed(rollup_flags(src["portal_task"], cfg), "roll_")
    x = (ps.join(capacity_tasks(src, cfg), "PartSupplierID", "left")
         .join(r, F.col("PartSupplierID") == F.col("roll_PartSupplierID"), "left"))
    return x.select("PartSupplierID", "PartSupplierTaskID", F.col("roll_TaskName").alias("TaskName"),
                    _task_status(x, "roll_", False).alias("TaskStatus")).distinct()


def latest_contract_quote(src: Sources, cfg: Config) -> DataFrame:
    """Latest 'Contract' line with a quote per task (ModifyDate, CreateDate, line id; NULL dates last)."""
    csl = src["portal_capacity_line"].where((F.col("CapacityType") == C.CAPACITY_CONTRACT)
                                            & F.col("Quoted").isNotNull())
    latest = latest_per_key(csl, ["PartSupplierTaskID"], _line_order())
    return latest.select("PartSupplierTaskID", "Quoted", "ApprovalStatus",
                         F.coalesce("ModifyDate", "CreateDate").alias("LatestUpdateDate"), "CapacityType")


def latest_current_capacity(src: Sources, cfg: Config) -> DataFrame:
    """Latest 'Current Capacity' line with any of the four amounts per task."""
    csl = src["portal_capacity_line"].where((F.col("CapacityType") == C.CAPACITY_CURRENT) & _has_amount())
    latest = latest_per_key(csl, ["PartSupplierTaskID"], _line_order())
    return latest.select("PartSupplierTaskID", "ApprovalStatus",
                         F.coalesce("ModifyDate", "CreateDate").alias("LatestUpdateDate"), "Measured", "Potential",
                         "Designed", "Theoretical", "CapacityType")


def capacity_lines(src: Sources, cfg: Config, tasks: DataFrame | None = None) -> DataFrame:
    """Both latest-line lookups side by side: one row per task that has either kind of line.

    With ``tasks`` lines that belong to none of them are left out before the window's shuffle
    (all but a few; their number is counted while the plan is built).

    Columns: PartSupplierTaskID, QuoteDate, Quoted, Other4CreateDate,
    Measured, Potential, Designed, Theoretical.
    """
    # one scan and one top-1 per (task, type); then at most one line of each type per task to put side by side
    contract = (F.col("CapacityType") == C.CAPACITY_CONTRACT) & F.col("Quoted").isNotNull()
    current = (F.col("CapacityType") == C.CAPACITY_CURRENT) & _has_amount()
    lines = src["portal_capacity_line"].where(F.col("CapacityType").isin(C.CAPACITY_CONTRACT, C.CAPACITY_CURRENT)
                                              & (contract | current))
    if tasks is not None:
        lines = key_filter(lines, tasks, "PartSupplierTaskID")
    latest = latest_per_key(lines, ["PartSupplierTaskID", "CapacityType"], _line_order())

    def of(kind: str, value):
        return F.max(F.when(F.col("CapacityType") == kind, value))

    updated = F.coalesce("ModifyDate", "CreateDate")
    return latest.groupBy("PartSupplierTaskID").agg(
        of(C.CAPACITY_CONTRACT, updated).alias("QuoteDate"), of(C.CAPACITY_CONTRACT, F.col("Quoted")).alias("Quoted"),
        of(C.CAPACITY_CURRENT, updated).alias("Other4CreateDate"),
        *[of(C.CAPACITY_CURRENT, F.col(c)).alias(c) for c in ("Measured", "Potential", "Designed", "Theoretical")])


def measured_status(src: Sources, cfg: Config) -> DataFrame:
    lines = capacity_lines(src, cfg)
    return lines.select("PartSupplierTaskID", "Quoted", "Measured",
                        capacity_status(F.col("Measured"), F.col("Quoted"), "Measured").alias("MeasuredStatus"))


def designed_status(src: Sources, cfg: Config) -> DataFrame:
    lines = capacity_lines(src, cfg)
    return lines.select("PartSupplierTaskID", "Quoted", "Designed",
                        capacity_status(F.col("Designed"), F.col("Quoted"), "Designed").alias("DesignedStatus"))


# ----------------------------------------------------------------------- reports
def info_rows(src: Sources, cfg: Config, version: int = 2, users: bool = True,
              parts: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Un-deduplicated info rows with every column a report variant needs.

    Eager in one step: the parts side is written once below the checkpoint folder while
    the plan is built (and with ``parts`` the chosen keys are counted).

    ``version`` 2: task status with PCR branch; 1: rollup flags over all
    capacity-like task names; 3: rollup restricted to the capacity task and
    joined only where a capacity task matched (task-status-for-parts report).
    """
    cfg = cfg.fixed()
    p = purchased_parts(src, cfg).where(F.col("SupplierCode").isNotNull())
    if parts is not None:
        if isinstance(parts, DataFrame):
            keys = parts.select(F.col(parts.columns[0]).alias("__part")).distinct()
            p = p.join(keys, F.col("PartNumber") == F.col("__part"), "left_semi")
        else:
            p = p.where(F.col("PartNumber").isin(*parts))
    ps = src["portal_part_supplier"].select("PartNumber", "SupplierCode", "PartSupplierID", "PPAPStatus",
                                            "IsPartDefined", "PartSupplierTagID")
    tag = src["portal_ps_tag"].select("PartSupplierTagID", F.col("Tag").alias("ProgramTag"))
    x = (p.join(ps, ["PartNumber", "SupplierCode"], "left")
         .join(tag, "PartSupplierTagID", "left")
         .join(part_tag_flags(src, cfg, p if parts is not None else None), "PartID", "left"))
    flags = [F.coalesce(F.col(c), F.lit(False)) for c in ("is_model_s", "is_model_x", "is_model_3", "is_energy")]
    x = x.where(flags[0] | flags[1] | flags[2] | F.col("ProgramTag").isNotNull() | flags[3])
    # one row per part-supplier, small against the tasks: stored once, read by both branches of the fan-out join
    x = stored_table(x, "capacity-parts")
    # tasks per part-supplier: the fan-out join, safe against a hot part-supplier
    chosen, tasks = x, capacity_tasks(src, cfg)
    if parts is not None:
        tasks = key_filter(tasks, x, "PartSupplierID")
    x = left_join_fanout(x, tasks, ["PartSupplierID"])
    if users:
        # small dimension lookups, once on the joined rows (not in both branches above)
        all_users = src["portal_user"]
        x = with_user(x, all_users, on="SIEUserID", user_key="UserID", name_as="SIE", manager_as="SIEManager")
        x = with_user(x, buyer_users(all_users, cfg), on="BuyerCode", user_key="SAPUserID", name_as="GSM",
                      manager_as="GSMManager", managers=all_users)
    rollup = None
    if version == 1:
        r = _prefixed(rollup_flags(src["portal_task"], cfg), "roll_")
        x = x.join(r, F.col("PartSupplierID") == F.col("roll_PartSupplierID"), "left")
        rollup = "roll_"
    elif version == 3:
        rolled = src["portal_task"] if parts is None else key_filter(src["portal_task"], chosen, "PartSupplierID")
        r = _prefixed(rollup_flags(rolled, cfg, task_id=cfg.capacity_task_id), "roll_")
        cond = (F.col("PartSupplierID") == F.col("roll_PartSupplierID")) & (F.col("TaskID") == cfg.capacity_task_id)
        x = x.join(r, cond, "left")
        rollup = "roll_"
    return x.select(
        "*",
        F.col("Description").alias("PartDescription"),
        effective_status(cfg.as_of_ts(), F.col("EarliestEffectiveDateInBOM"),
                         F.col("LatestEndDate")).alias("EffectiveStatus"),
        F.when(flags[1], F.col("PartID")).alias("PartIDX"),
        F.when(flags[0], F.col("PartID")).alias("PartIDS"),
        F.when(flags[2], F.col("PartID")).alias("PartID3"),
        F.when(flags[3], F.col("PartID")).alias("PartIDte"),
        _task_status(x, rollup, version == 2).alias("TaskStatus"),
        model_label(flags[2], flags[1], flags[0], flags[3], cfg.required("energy_label")).alias("Model"),
        program_label(F.col("ProgramTag"), flags[2], flags[0], flags[1], flags[3]).alias("Program"),
    )


def capacity_info(src: Sources, cfg: Config, version: int = 2) -> DataFrame:
    """The report's base table ("info"): distinct part/supplier/task rows."""
    return info_rows(src, cfg, version).select(*INFO_COLUMNS).distinct()


def capacity_data(src: Sources, cfg: Config, version: int = 2) -> DataFrame:
    """Capacity report (27 columns; the current version's duplicated columns appear once).

    One DISTINCT on the report's info columns replaces the two of the
    original (inner and outer): the info columns dropped by the outer
    projection are functions of the part, and both line lookups have at
    most one row per task, so the result is the same.
    """
    info = (info_rows(src, cfg, version)
            .select(*[F.col(c) for c in REPORT_INFO_COLUMNS if c not in ("CapSupplierName", "LatestEffectiveDate")],
                    F.col("SupplierName").alias("CapSupplierName"),
                    F.col("LatestEndDate").alias("LatestEffectiveDate"))
            .distinct())
    # parts without a capacity task have a NULL task id: spread, they match no line; lines of other tasks match no part
    x = join_splittable(info, capacity_lines(src, cfg, capacity_tasks(src, cfg)), ["PartSupplierTaskID"], "left",
                        spread_nulls_by=["PartID", "SupplierCode"])
    return x.select(*[F.col(c) for c in REPORT_COLUMNS if c not in ("MeasuredStatus", "DesignedStatus")],
                    capacity_status(F.col("Measured"), F.col("Quoted"), "Measured").alias("MeasuredStatus"),
                    capacity_status(F.col("Designed"), F.col("Quoted"), "Designed").alias("DesignedStatus")
                    ).select(*REPORT_COLUMNS)


def task_status_list(src: Sources, cfg: Config) -> DataFrame:
    """(PartNumber, SupplierCode, TaskStatus, Program), ordered by part number."""
    rows = info_rows(src, cfg, version=2, users=False)
    return (rows.select("PartNumber", "SupplierCode", "TaskStatus", "Program").distinct()
            .orderBy(F.col("PartNumber").asc_nulls_first()))


def task_status_for_parts(src: Sources, cfg: Config, parts: Sequence[str] | DataFrame) -> DataFrame:
    """(PartNumber, TaskStatus) for the chosen parts (a list, or a DataFrame whose first column holds part numbers)."""
    rows = info_rows(src, cfg, version=3, users=False, parts=parts)
    return rows.select("PartNumber", "TaskStatus").distinct().orderBy(F.col("PartNumber").asc_nulls_first())


def task_status_counts(src: Sources, cfg: Config) -> DataFrame:
    """Number of capacity-report rows per task status, ascending."""
    rep = capacity_data(src, cfg, version=2)
    return (rep.groupBy("TaskStatus").agg(F.count("PartNumber").alias("part_count"))
            .orderBy(F.col("part_count").asc(), F.col("TaskStatus").asc_nulls_first()))


# ----------------------------------------------------------------------- helpers
def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _task_status(x: DataFrame, rollup_prefix: str | None, pcr_pending: bool):
    rollup = None
    if rollup_prefix:
        rollup = {k: F.col(rollup_prefix + k) for k in ("Approved", "Rejected", "Submitted", "Required")}
    return task_status(F.col("PPAPStatus"), F.col("IsPartDefined"), F.col("StatusID"), F.col("TaskScore"),
                       F.col("TaskScore1"), rollup=rollup, pcr_pending=pcr_pending)


def _line_order():
    return [F.col("ModifyDate").desc_nulls_last(), F.col("CreateDate").desc_nulls_last(),
            F.col("CapacityStudyLineID").desc()]


def _has_amount():
    return (F.col("Measured").isNotNull() | F.col("Potential").isNotNull() | F.col("Theoretical").isNotNull()
            | F.col("Designed").isNotNull())
