"""Spark session defaults and the shared folder for lineage cuts and sinks."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for: adaptive execution re-plans joins from
# runtime sizes (broadcast only below the threshold, sort-merge beyond it),
# splits skewed shuffle partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture costs several JVM round trips per Column call
    # while a plan is built; error messages lose the Python line only.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "capstan",
                  driver_memory: str = "6g", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the benchmark.

    On a cluster, build the session the usual way and keep ``DEFAULT_CONF``;
    nothing in the library depends on local mode.
    """
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory)
               # local sessions only: keep catalog tables out of the working directory
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="capstan-warehouse-")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only in local mode (tests) a private folder is made
    when it is unset, and removed when Python ends; on a cluster an unset
    folder is an error, because executors do not share local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="capstan-ckpt-")
        atexit.register(shutil.rmtree, conf, ignore_errors=True)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return it with a short lineage.

    A reliable checkpoint (never ``localCheckpoint``): the files live on the
    storage the cluster names in ``spark.checkpoint.dir`` and survive the
    loss of the executors that wrote them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SCRATCH: list[str] = []                 # folders handed out, in order


def scratch_path(spark: SparkSession, name: str, scoped: bool = True) -> str:
    """A fresh, unique folder below the checkpoint directory (shared storage).

    With ``scoped`` an enclosing ``scratch_scope`` deletes it at its end.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/capstan/{name}-{uuid.uuid4().hex[:12]}"
    if scoped:
        _SCRATCH.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made inside the block when it ends (its results must be written by then)."""
    start = len(_SCRATCH)
    try:
        yield
    finally:
        conf, made = spark._jsc.hadoopConfiguration(), _SCRATCH[start:]
        del _SCRATCH[start:]
        for p in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run inside are deleted when it ends; its result must be written by then."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet below the checkpoint folder and read from there (an eager step).

    Unlike a checkpoint the result is computed once, and later readers prune
    columns and push filters into it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables below the checkpoint folder (call when no result is read any more)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/capstan")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


__all__ = ["clean_scratch", "scratch_scope", "DEFAULT_CONF", "local_session", "ensure_checkpoint_dir", "cut_lineage", "shuffles_released", "stored_table", "scratch_path"]
