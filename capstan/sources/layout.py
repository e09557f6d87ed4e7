"""Storage layout of the domain tables for co-located joins.

The large tables are stored bucketed (and sorted) on the key of their
biggest join or window, so Spark reads them already clustered and plans
those joins and windows without a shuffle:

* PO lines and POs on ``PurchaseOrderID`` (the line ⋈ PO join of every price rule)
* tasks on ``PartSupplierID`` (the capacity report's fan-out join)
* capacity study lines on ``PartSupplierTaskID`` (latest quote / capacity windows)
* part tags on ``PartID`` (tag flags), pricing rows on ``PartID``
* BOM explosions on ``DetailPartNumber`` (required parts, usage sums)

Tables joined with each other on the bucket key must have the same number
of buckets.  Dimension tables are stored plainly.

BOM explosions may be stored by day instead (``store_by_day``): the reports read
the last few days of them, so whole folders are pruned whatever the history.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from capstan.sources.tables import Sources

EXPLOSION_DAY = "BOMExplosionDay"

BUCKET_KEYS: dict[str, tuple[str, ...]] = {
    "erp_po_line": ("PurchaseOrderID",),
    "erp_po": ("PurchaseOrderID",),
    "portal_task": ("PartSupplierID",),
    "portal_capacity_line": ("PartSupplierTaskID",),
    "portal_part_tag": ("PartID",),
    "erp_date_pricing": ("PartID",),
    "erp_bom_explosion": ("DetailPartNumber",),
}


def store_tables(src: Sources, database: str, names, buckets: int) -> Sources:
    """Write ``names`` of ``src`` as tables of ``database`` with the layout above; return a catalog source."""
    spark = src.spark
    for n in names:
        w = src[n].write.mode("overwrite").format("parquet")
        keys = BUCKET_KEYS.get(n)
        if keys:
            w = w.bucketBy(buckets, *keys).sortBy(*keys)
        w.saveAsTable(f"{database}.{n}")
    return Sources.catalog(spark, database)


def store_by_day(src: Sources, path: str) -> Sources:
    """``src`` with its BOM explosions stored at ``path`` in one folder per day (a rerun replaces the days that it has)."""
    rows = src["erp_bom_explosion"].withColumn(EXPLOSION_DAY, F.to_date("BOMExplosionDate"))
    # a day's rows in files of a common size, also a day that holds most of them
    (rows.hint("rebalance", EXPLOSION_DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(EXPLOSION_DAY).parquet(path))
    by_day = src.spark.read.parquet(path)
    return Sources(src.spark, lambda n: by_day if n == "erp_bom_explosion" else src[n])
