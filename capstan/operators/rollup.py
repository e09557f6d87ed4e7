"""Status rollup of tasks per (part-supplier, task name)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.config import Config
from capstan.functions.labels import like_any_all


def rollup_flags(tasks: DataFrame, cfg: Config, task_id: int | None = None) -> DataFrame:
    """``Max(CASE WHEN ... THEN 1 ELSE 0 END)`` flags per (PartSupplierID, TaskName).

    Only tasks whose name matches the configured capacity patterns count;
    ``task_id`` additionally restricts to one task type.  A plain hash
    aggregation: integer buffers, partial aggregation before the shuffle.
    """
    name_ok = like_any_all(F.col("TaskName"), cfg.rollup_any, cfg.rollup_all, cfg.case_insensitive)
    rows = tasks.where(name_ok if task_id is None else name_ok & (F.col("TaskID") == task_id))
    sid, s, s1 = F.col("StatusID"), F.col("TaskScore"), F.col("TaskScore1")

    def flag(cond):
        return F.max(F.when(cond, 1).otherwise(0))

    return rows.groupBy("PartSupplierID", "TaskName").agg(
        flag((sid == 3) | (s == 4) | (s1 == 4)).alias("Approved"),
        flag((sid == 4) | (s == 1) | (s1 == 1)).alias("Rejected"),
        flag(sid == 2).alias("Submitted"),
        flag(sid == 1).alias("Required"),
    )
