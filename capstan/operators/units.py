"""Unit-of-measure conversion between a part's stock unit and the purchase unit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_unit_divisor(df: DataFrame, general: DataFrame, part_specific: DataFrame, part: str = "PartID",
                      stock: str = "StockUnitID", purchase: str = "PurchaseUnitID",
                      out: str = "UnitDivisor") -> DataFrame:
    """Add the divisor that turns a stock quantity into purchase units.

    1 when both units are equal or the purchase unit is unknown; otherwise
    ``1 / factor`` with the factor taken, in this order, from the general
    table forward, the reciprocal of the general table reverse, the
    part-specific table forward, the reciprocal of the part-specific table
    reverse.  NULL when no factor exists (the caller turns that into 0).
    """
    g1 = general.select(F.col("FromUnitID").alias("__g1f"), F.col("ToUnitID").alias("__g1t"),
                        F.col("ConversionFactor").cast("double").alias("__g1"))
    g2 = general.select(F.col("FromUnitID").alias("__g2f"), F.col("ToUnitID").alias("__g2t"),
                        F.col("ConversionFactor").cast("double").alias("__g2"))
    p1 = part_specific.select(F.col("PartID").alias("__p1p"), F.col("FromUnitID").alias("__p1f"),
                              F.col("ToUnitID").alias("__p1t"), F.col("ConversionFactor").cast("double").alias("__p1"))
    p2 = part_specific.select(F.col("PartID").alias("__p2p"), F.col("FromUnitID").alias("__p2f"),
                              F.col("ToUnitID").alias("__p2t"), F.col("ConversionFactor").cast("double").alias("__p2"))
    s, p, k = F.col(stock), F.col(purchase), F.col(part)
    x = (df.join(g1, (s == F.col("__g1f")) & (p == F.col("__g1t")), "left")
         .join(g2, (s == F.col("__g2t")) & (p == F.col("__g2f")), "left")
         .join(p1, (k == F.col("__p1p")) & (s == F.col("__p1f")) & (p == F.col("__p1t")), "left")
         .join(p2, (k == F.col("__p2p")) & (s == F.col("__p2t")) & (p == F.col("__p2f")), "left"))
    factor = F.coalesce(F.col("__g1"), F.lit(1.0) / F.col("__g2"), F.col("__p1"), F.lit(1.0) / F.col("__p2"))
    divisor = F.when(s == p, F.lit(1.0)).when(p.isNull(), F.lit(1.0)).otherwise(F.lit(1.0) / factor)
    return x.withColumn(out, divisor).drop(*[c for c in x.columns if c.startswith("__")])
