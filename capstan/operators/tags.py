"""Part tag memberships.

Two different questions are asked of the part-tag history:

* model tags (S, X, 3): is the *latest* row of the (part, tag) pair enabled?
  (latest first, then the enabled test)
* the named tag (e.g. an energy product tag): does the part have *any*
  enabled row of an enabled tag whose name matches a pattern?
  (enabled first, then existence)

``tag_flags`` answers all four with one top-1 window over the model-tag rows
and one aggregation per part, instead of one windowed scan per tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.config import Config
from capstan.operators.latest import latest_per_key


def named_tags(tag: DataFrame, cfg: Config) -> DataFrame:
    """TagIDs of enabled tags of the configured type whose name matches the pattern."""
    name = F.col("TagName")
    pattern = cfg.required("named_tag_pattern")
    match = name.ilike(pattern) if cfg.case_insensitive else name.like(pattern)
    return (tag.where((F.col("Enabled") == 1) & (F.col("TagTypeID") == cfg.named_tag_type_id) & match)
            .select("TagID"))


def named_tag_members(part_tag: DataFrame, tag: DataFrame, cfg: Config) -> DataFrame:
    """Distinct PartID having an enabled row of a matching enabled tag."""
    return (part_tag.where(F.col("Enabled") == 1)
            .join(named_tags(tag, cfg), "TagID", "left_semi")
            .select("PartID").distinct())


def latest_enabled_tags(part_tag: DataFrame, tag_ids) -> DataFrame:
    """(PartID, TagID) pairs whose latest row (CreateDate, then PartTagID) is enabled."""
    rows = part_tag.where(F.col("TagID").isin(*tag_ids))
    latest = latest_per_key(rows, ["PartID", "TagID"],
                            [F.col("CreateDate").desc_nulls_last(), F.col("PartTagID").desc()])
    return latest.where(F.col("Enabled") == 1).select("PartID", "TagID")


def tag_flags(part_tag: DataFrame, tag: DataFrame, cfg: Config) -> DataFrame:
    """One row per tagged part: ``is_model_s``, ``is_model_x``, ``is_model_3``, ``is_energy``.

    Model flags are true/false (NULL when the part has no row for that tag),
    so a left join from parts followed by ``coalesce(flag, false)`` gives the
    membership tests of the report.  Plan: the latest row per (part, model
    tag) by a top-1 window (partial limit before its shuffle), united with the
    enabled rows of matching named tags, then one boolean hash aggregation
    per part (partial aggregation before its shuffle).
    """
    model_ids = (cfg.tag_model_s, cfg.tag_model_x, cfg.tag_model_3)
    latest = (latest_per_key(part_tag.where(F.col("TagID").isin(*model_ids)), ["PartID", "TagID"],
                             [F.col("CreateDate").desc_nulls_last(), F.col("PartTagID").desc()])
              .select("PartID", "TagID", (F.col("Enabled") == 1).alias("enabled"), F.lit(False).alias("named")))
    named = (part_tag.where(F.col("Enabled") == 1).join(named_tags(tag, cfg), "TagID", "left_semi")
             .select("PartID", "TagID", F.lit(None).cast("boolean").alias("enabled"), F.lit(True).alias("named")))
    rows = latest.unionByName(named)

    def model_flag(tag_id: int):
        return F.max(F.when(~F.col("named") & (F.col("TagID") == tag_id), F.col("enabled")))

    return rows.groupBy("PartID").agg(
        model_flag(cfg.tag_model_s).alias("is_model_s"),
        model_flag(cfg.tag_model_x).alias("is_model_x"),
        model_flag(cfg.tag_model_3).alias("is_model_3"),
        F.bool_or(F.col("named")).alias("is_energy"),
    )
