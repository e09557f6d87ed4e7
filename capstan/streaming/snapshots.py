"""Accumulating snapshots as an incremental (streaming) append.

Each load run lands its result as files in a landing folder.  A file-source
stream picks up the files it has not seen, aligns them to the snapshot
schema and appends them to the snapshot table, partitioned by load date.
The checkpoint records which files were processed and the file sink's
metadata log records which output files are committed, so a rerun after a
failure (or a lost executor) neither drops nor duplicates a landed file.
``trigger(availableNow=True)`` processes everything landed so far and stops,
which suits a scheduled batch job; a continuous trigger works the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from capstan.operators.snapshot import align


def land_increment(df: DataFrame, landing: str, schema: StructType, fmt: str = "parquet") -> None:
    """Write one load run's rows into the landing folder (aligned to ``schema``)."""
    w = align(df, schema).write.mode("append")
    if fmt == "csv":
        w.option("header", True).csv(landing)
    else:
        w.parquet(landing)


def accumulate_snapshots(spark: SparkSession, landing: str, table: str, checkpoint: str, schema: StructType,
                         by: str = "Load_Date", fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Start the stream that appends newly landed increments to the snapshot table."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    increments = reader.format(fmt).load(landing)
    writer = (align(increments, schema).writeStream.format("parquet").outputMode("append")
              .option("path", table).option("checkpointLocation", checkpoint).partitionBy(by))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_snapshots(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The snapshot table (committed files only), columns in ``schema`` order."""
    return spark.read.schema(schema).parquet(table).select(*schema.fieldNames())
