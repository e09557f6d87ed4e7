"""Accumulating snapshots: each run appends the current state under its load date."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType, StructField,
                               StructType)

from capstan.operators.versions import Files

COLUMNS_FILE = "_columns.json"
_INTEGERS = (ByteType, ShortType, IntegerType, LongType)


def snapshot_append(history: DataFrame, increment: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become NULL (pandas ``append``)."""
    return history.unionByName(increment, allowMissingColumns=True)


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; columns ``df`` lacks become NULL.

    A column that ``schema`` does not have is an error: it would be lost.
    """
    lost = [c for c in df.columns if c not in set(schema.fieldNames())]
    if lost:
        raise ValueError(f"columns not in the snapshot's schema: {', '.join(lost)} (without a schema the snapshot takes new columns)")
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def common_type(a: DataType, b: DataType, name: str) -> DataType:
    """The type that holds both (integers widen, up to 32 bits they mix with floats as double, NULL takes any type)."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: [type(t) is k for k in _INTEGERS].index(True))
    if all(isinstance(t, (ByteType, ShortType, IntegerType, FloatType, DoubleType)) for t in (a, b)):
        return DoubleType()                  # exact; a long would not fit
    raise ValueError(f"column {name} was {a.simpleString()} and is {b.simpleString()} now")


def grown(stored: StructType | None, load: StructType) -> StructType:
    """Stored columns in their order, then the load's new ones; types widened where both have a column."""
    new = {f.name: f.dataType for f in load.fields}
    fields = [StructField(f.name, common_type(f.dataType, new.pop(f.name, f.dataType), f.name)) for f in (stored.fields if stored else [])]
    return StructType(fields + [StructField(n, t) for n, t in new.items()])


def stored_columns(spark: SparkSession, path: str) -> StructType | None:
    """Columns that the snapshot at ``path`` has taken so far (None: no load yet)."""
    text = Files(spark, path).read(f"{path.rstrip('/')}/{COLUMNS_FILE}")
    return StructType.fromJson(json.loads(text)) if text else None


def append_snapshot(df: DataFrame, path: str, schema: StructType | None = None, by: str = "Load_Date",
                    fmt: str = "parquet") -> None:
    """Append ``df`` to the snapshot table at ``path``, partitioned by ``by``.

    Without ``schema`` the table takes the columns that it gets: columns that earlier loads
    did not have are added at the end (earlier rows read NULL), columns that this load lacks
    are NULL in its rows, integer and float types widen.  The column list lies beside the
    data and is written before it, so a failed load leaves at most a column of NULLs, and no
    reader has to open every file to find the columns.  With ``schema`` the columns are
    fixed, and a column outside it is an error.

    Dynamic partition overwrite replaces only the load dates present in
    ``df``: re-running a load (for example after a failed job) does not
    duplicate rows, and earlier loads are never rewritten.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unsupported format {fmt!r}")
    if schema is None:
        spark = df.sparkSession
        before = stored_columns(spark, path)
        schema = grown(before, df.schema)
        if schema != before:
            Files(spark, path).replace(f"{path.rstrip('/')}/{COLUMNS_FILE}", schema.json())
        schema = StructType([f for f in schema.fields if not isinstance(f.dataType, NullType)])
        df = df.select(*[c for c in df.columns if c in schema.fieldNames()])
    w = align(df, schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by)
    w.option("header", True).format(fmt).save(path)


def read_snapshot(spark: SparkSession, path: str, schema: StructType | None = None, by: str = "Load_Date",
                  fmt: str = "parquet") -> DataFrame:
    """Read the snapshot table with the columns it has taken, or with those of ``schema`` (which includes ``by``).

    Filters on ``by`` prune whole partitions (folders) at planning time.
    """
    if schema is None:
        schema = stored_columns(spark, path)
        if schema is None:
            raise FileNotFoundError(f"no snapshot load at {path}")
        schema = StructType([f for f in schema.fields if not isinstance(f.dataType, NullType)])
    # files of narrower integers are read as the wider type; CSV files have the columns of their time, new ones come last
    return spark.read.schema(schema).option("header", True).format(fmt).load(path).select(*schema.fieldNames())
