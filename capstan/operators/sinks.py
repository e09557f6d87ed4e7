"""Report writers and readers (actions; everything else in the library is lazy)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from capstan.operators.versions import Files, current, publish


def write_report(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the report at ``path`` (part files written in parallel).

    ``fmt`` is 'parquet' or 'csv' (CSV gets a header row and no row index).  The rows go to
    a new version folder and are published by one rename of a pointer (see ``versions``): a
    run that fails at any point leaves the old report readable, and readers never see part
    of a report.  ``df`` may read the report that it replaces.  Read it with ``read_report``,
    or let other programs read the folder that ``report_location`` names.  Single-file
    spreadsheets are not produced: they would funnel the whole report through one writer.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unsupported format {fmt!r}")
    w = df.write.mode("errorifexists").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    publish(df.sparkSession, path, lambda folder: w.format(fmt).save(folder))


def report_location(spark: SparkSession, path: str) -> str:
    """The plain folder of part files that holds the current report.

    A finished report that was written straight into ``path`` counts until the first replace.
    """
    folder = current(spark, path)
    if folder is None and Files(spark, path).exists(f"{path.rstrip('/')}/_SUCCESS"):
        return path
    if folder is None:
        raise FileNotFoundError(f"no report was published at {path}")
    return folder


def read_report(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: StructType | str | None = None) -> DataFrame:
    """Read the current report; CSV is read with an explicit schema (names and types forced)."""
    if fmt == "parquet":
        return spark.read.parquet(report_location(spark, path))
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV reports are read with an explicit schema")
        return spark.read.schema(schema).option("header", True).csv(report_location(spark, path))
    raise ValueError(f"unsupported format {fmt!r}")
