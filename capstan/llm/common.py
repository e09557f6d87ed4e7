"""Scratch tables in the shared folder, and schema-preserving batch filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from capstan.session import scratch_path, shuffles_released


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table below ``spark.checkpoint.dir`` and read from there.

    Cuts the lineage: later stages survive lost executors by reading the files.  The shuffle
    files of the step go at once, so steps that follow one another do not add up on disk.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_rows(docs: DataFrame, mask: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` where ``mask(batch)`` is true, all columns unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(mask(b)))

    return docs.mapInArrow(run, docs.schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column by name as Spark resolves it (case-insensitively)."""
    names = [n.lower() for n in batch.schema.names]
    return batch.column(names.index(name.lower()))
