"""Merged reports: capacity ⟕ cost, and the file-driven portal/ERP merges."""

from __future__ import annotations

from pyspark.sql import DataFrame

from capstan.config import Config
from capstan.operators.merge import GroupedMerge, MergeCounts, grouped_merge, null_safe_merge
from capstan.plans.capacity import capacity_data
from capstan.plans.pricing import qpv_data
from capstan.sources import Sources


def merged_capacity_cost(src: Sources, cfg: Config, counts: MergeCounts | None = None) -> DataFrame:
    """Capacity report (current version) left-merged with QPV/CPV on (PartNumber, SupplierCode).

    42 columns; ``PartID`` is on both sides and becomes ``PartID_x`` /
    ``PartID_y``.  The QPV side has at most a few rows per (part, supplier)
    (one per usage line), so the merge is a plain left join.  Two inputs are
    stored while the plan is built (the parts side of the capacity report and
    the PO lines of the price rules); all else is one lazy plan.  ``counts``
    takes row counts while the report runs.
    """
    cfg = cfg.fixed()
    return null_safe_merge(capacity_data(src, cfg, version=2), qpv_data(src, cfg), ["PartNumber", "SupplierCode"],
                           how="left", counts=counts)


def three_key_merge(left: DataFrame, right: DataFrame, null_keys: str = "match") -> DataFrame:
    """Left merge on (PartNumber, SupplierCode, TagName)."""
    return null_safe_merge(left, right, ["PartNumber", "SupplierCode", "TagName"], how="left", hot_right_keys=True,
                           null_keys=null_keys)


def dashboard_left_merge(portal: DataFrame, erp: DataFrame, null_keys: str = "match") -> DataFrame:
    """Portal rows left-merged with ERP rows on PartNumber."""
    return null_safe_merge(portal, erp, ["PartNumber"], how="left", hot_right_keys=True,
                           null_keys=null_keys)


def qualification_left_merge(erp: DataFrame, portal: DataFrame, null_keys: str = "match") -> DataFrame:
    """ERP rows left-merged with portal rows on (partnumber, suppliercode)."""
    return null_safe_merge(erp, portal, ["partnumber", "suppliercode"], how="left", hot_right_keys=True,
                           null_keys=null_keys)


def three_key_groups(left: DataFrame, right: DataFrame) -> GroupedMerge:
    """``three_key_merge`` in linear space, however many NULL keys both sides have."""
    return grouped_merge(left, right, ["PartNumber", "SupplierCode", "TagName"])


def dashboard_groups(portal: DataFrame, erp: DataFrame) -> GroupedMerge:
    """``dashboard_left_merge`` in linear space."""
    return grouped_merge(portal, erp, ["PartNumber"])


def qualification_groups(erp: DataFrame, portal: DataFrame) -> GroupedMerge:
    """``qualification_left_merge`` in linear space."""
    return grouped_merge(erp, portal, ["partnumber", "suppliercode"])
