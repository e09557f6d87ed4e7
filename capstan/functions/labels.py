"""Column builders for the report's CASE logic.

Each function returns a ``Column``; all of them are built-in expressions, so
they stay inside whole-stage code generation.  A CASE without ELSE yields NULL
(``F.when`` chain without ``otherwise``) and three-valued logic is kept: a
NULL operand never satisfies a branch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from capstan import config as C


def ts_lit(value: dt.datetime) -> Column:
    """Wall-clock timestamp literal (timestamp_ntz, like the parquet columns).

    Built from text: a Python ``datetime`` literal would pass through the
    driver's local time zone and the session time zone on its way to
    timestamp_ntz and could shift when the two differ.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def effective_status(as_of: dt.datetime, start: Column, end: Column) -> Column:
    """Current / Past / Future / Dates missing for an effectivity window."""
    now = ts_lit(as_of)
    return (F.when(now.between(start, end), C.EFFECTIVE_CURRENT)
            .when(now > end, C.EFFECTIVE_PAST)
            .when(now < start, C.EFFECTIVE_FUTURE)
            .otherwise(C.EFFECTIVE_MISSING))


def task_status(ppap_status: Column, is_part_defined: Column, status_id: Column, score: Column,
                score1: Column, rollup: dict[str, Column] | None = None, pcr_pending: bool = True) -> Column:
    """Task status of a part-supplier task.

    ``pcr_pending=True, rollup=None`` is the current report; the earlier
    report has no PCR branch and ORs the rollup flags ``Approved``,
    ``Rejected``, ``Submitted`` and ``Required`` (1 = set) into four branches.
    """
    def flag(name: str) -> Column:
        return (rollup[name] == 1) if rollup else F.lit(False)

    approved = (status_id == 3) | flag("Approved") | (score == 4) | (score1 == 4)
    rejected = (status_id == 4) | flag("Rejected") | (score == 1) | (score1 == 1)
    reviewed = (status_id == 2) | flag("Submitted")
    submitted = (status_id == 1) | flag("Required")
    expr = (F.when(ppap_status.isin(*C.LEGACY_PPAP_STATUSES) & is_part_defined.isNull(), C.TASK_LEGACY)
            .when(is_part_defined.isNull(), C.TASK_UNDEFINED)
            .when(approved, C.TASK_APPROVED)
            .when(rejected, C.TASK_REJECTED)
            .when(reviewed, C.TASK_NOT_REVIEWED)
            .when(submitted, C.TASK_NOT_SUBMITTED))
    if pcr_pending:
        expr = expr.when(status_id == 7, C.TASK_PCR_PENDING)
    return expr.when(status_id.isNull() | (status_id == 5), C.TASK_NOT_REQUIRED)


def model_label(is_3: Column, is_x: Column, is_s: Column, is_energy: Column,
                energy_label: str) -> Column:
    """Vehicle program of a part from its latest model tags (flags are booleans, NULL = false)."""
    m3, mx, ms, te = (F.coalesce(c, F.lit(False)) for c in (is_3, is_x, is_s, is_energy))
    return (F.when(m3, C.MODEL_3)
            .when(mx & ms, C.MODEL_SHARED_SX)
            .when(mx & ~ms, C.MODEL_X)
            .when(~mx & ms, C.MODEL_S)
            .when(te, energy_label)
            .otherwise(C.MODEL_OTHER))


def program_label(program_tag: Column, is_3: Column, is_s: Column, is_x: Column, is_energy: Column) -> Column:
    """Program: six part-supplier tags pass through, then model tags, else NULL."""
    m3, mx, ms, te = (F.coalesce(c, F.lit(False)) for c in (is_3, is_x, is_s, is_energy))
    expr = None
    for tag in C.PROGRAM_PASSTHROUGH:
        cond = program_tag == tag
        expr = F.when(cond, tag) if expr is None else expr.when(cond, tag)
    return expr.when(m3, C.PROGRAM_MODEL_3).when(ms | mx | te, C.PROGRAM_EXISTING)


def capacity_status(value: Column, quoted: Column, kind: str) -> Column:
    """Compare a measured/designed capacity with the quoted one (``kind`` = 'Measured' | 'Designed')."""
    return (F.when(value.isNotNull() & quoted.isNotNull() & (value >= quoted), C.STATUS_GREATER.format(kind=kind))
            .when(value.isNotNull() & quoted.isNotNull(), C.STATUS_LESS.format(kind=kind))
            .when(value.isNotNull(), C.STATUS_NO_QUOTE)
            .when(quoted.isNotNull(), C.STATUS_NO_VALUE.format(kind=kind))
            .otherwise(C.STATUS_NO_DATA))


def flag_is_null_or_zero(c: Column) -> Column:
    """``(flag IS NULL OR flag = 0)``."""
    return c.isNull() | (c == 0)


def like_any_all(c: Column, any_patterns, all_patterns, case_insensitive: bool = False) -> Column:
    """``c LIKE any_1 OR ... OR (c LIKE all_1 AND c LIKE all_2 ...)``."""
    def like(p: str) -> Column:
        return c.ilike(p) if case_insensitive else c.like(p)

    cond = None
    for p in any_patterns:
        cond = like(p) if cond is None else cond | like(p)
    if all_patterns:
        conj = None
        for p in all_patterns:
            conj = like(p) if conj is None else conj & like(p)
        cond = conj if cond is None else cond | conj
    return cond
