"""A runtime filter of join keys: rows of a large table that can have a partner, before any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap of Spark's ``bitmap_construct_agg``.
BITMAP_BITS = 32_768
MAX_BITMAPS = 4_096


def key_filter(large: DataFrame, keys: DataFrame, key: str, bits_per_key: int = 32) -> DataFrame:
    """Rows of ``large`` whose ``key`` may occur in ``keys[key]`` (all that do; of others about one in ``bits_per_key``).

    The keys' hashes are set as bits of a bitmap in Spark (one aggregation over ``keys``),
    split into bitmaps of ``BITMAP_BITS``; the rows of ``large`` are tested against their
    bitmap where they are scanned.  ``bits_per_key`` sizes the bitmaps for the counted keys,
    up to ``MAX_BITMAPS`` of them (16 MB, the bound of what is broadcast; beyond, more rows pass).
    The join that follows decides; rows with a NULL key do not pass.
    """
    distinct = keys.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    bitmaps = max(1, min(MAX_BITMAPS, -(-distinct.count() * bits_per_key // BITMAP_BITS)))
    # bit numbers count from 1 in Spark's bitmap functions
    slot = F.pmod(F.xxhash64(F.col("__k")), F.lit(bitmaps * BITMAP_BITS)) + 1
    bits = (distinct.select(slot.alias("__s")).groupBy(F.bitmap_bucket_number("__s").alias("__b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__s")).alias("__bits")))
    marked = large.withColumn("__s", F.pmod(F.xxhash64(F.col(key).cast(distinct.schema["__k"].dataType)), F.lit(bitmaps * BITMAP_BITS)) + 1)
    position = F.bitmap_bit_position("__s")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (marked.join(F.broadcast(bits), F.bitmap_bucket_number("__s") == F.col("__b"), "inner")
            .where(F.col(key).isNotNull() & (F.call_function("getbit", byte, (position % 8).cast("int")) == 1))
            .drop("__s", "__b", "__bits"))
