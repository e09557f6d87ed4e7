"""Where the domain tables come from.

``Sources`` maps a domain table name (``portal_part``, ``erp_po_line`` ...) to
a lazy DataFrame.  Reports only ever call ``src[name]`` and let Catalyst push
their filters and column selections into whatever scan backs the name:

* ``Sources.parquet(spark, root)``   – one parquet dataset per table
* ``Sources.csv(spark, root)``       – one CSV folder per table, declared schemas
* ``Sources.catalog(spark, db)``     – ``spark.table(f"{db}.{name}")``
* ``Sources.jdbc(spark, url, ...)``  – ``spark.read.jdbc`` per table
* ``Sources.fixtures(spark, sf_dir)``– derived from the driver test tables

Table names: portal (planning portal) ``portal_part portal_supplier
portal_part_supplier portal_task portal_part_tag portal_tag portal_ps_tag
portal_status portal_user portal_capacity_line``; ERP ``erp_part erp_part_tag
erp_supplier erp_bom_sample erp_bom_explosion erp_po erp_po_line
erp_date_pricing erp_currency erp_fx_map erp_unit erp_unit_conv
erp_part_unit_conv erp_buyer_mgr``.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from capstan.session import scratch_path
from capstan.sources import fixtures
from capstan.sources.schemas import SCHEMAS

_STORED: dict[tuple, tuple[str, set[str]]] = {}          # (application, folder, its files) -> (root, written tables)
_STORED_LOCK = threading.RLock()


class Sources:
    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame]):
        self.spark = spark
        self._loader = loader
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._loader(name)
        return self._cache[name]

    def register_views(self, names, prefix: str = "") -> None:
        """Expose tables to ``spark.sql`` text (temporary views of this session)."""
        for n in names:
            self[n].createOrReplaceTempView(prefix + n)

    # ------------------------------------------------------------ backends
    @classmethod
    def parquet(cls, spark: SparkSession, root: str) -> "Sources":
        root = root.rstrip("/")
        return cls(spark, lambda n: spark.read.parquet(f"{root}/{n}"))

    @classmethod
    def csv(cls, spark: SparkSession, root: str, header: bool = True) -> "CsvSources":
        """One CSV folder per table, read with the declared schema (no inference), header and rows checked."""
        return CsvSources(spark, root, header)

    @classmethod
    def catalog(cls, spark: SparkSession, database: str) -> "Sources":
        return cls(spark, lambda n: spark.table(f"{database}.{n}"))

    @classmethod
    def jdbc(cls, spark: SparkSession, url: str, tables: dict[str, str], properties: dict | None = None,
             partitioning: dict[str, dict] | None = None, declared_types: bool = True) -> "Sources":
        """``tables`` maps a domain name to the source table (``schema.Table``).

        ``partitioning`` optionally gives ``column/lowerBound/upperBound/
        numPartitions`` per large table so the read is split across tasks.
        With ``declared_types`` the declared schemas are passed as
        ``customSchema`` so column types do not depend on the driver's mapping.
        """
        props = dict(properties or {})
        parts = partitioning or {}

        def load(n: str) -> DataFrame:
            opts = {"url": url, "dbtable": tables[n], **props, **parts.get(n, {})}
            if declared_types and n in SCHEMAS:
                opts.setdefault("customSchema", SCHEMAS[n])
            return spark.read.format("jdbc").options(**opts).load()

        return cls(spark, load)

    @classmethod
    def fixtures(cls, spark: SparkSession, sf_dir: str) -> "Sources":
        sf_dir = sf_dir.rstrip("/")
        driver: dict[str, DataFrame] = {}
        holder: dict[str, Sources] = {}

        def table(n: str) -> DataFrame:
            if n in fixtures.DRIVER_TABLES:
                if n not in driver:
                    driver[n] = spark.read.parquet(f"{sf_dir}/{n}.parquet")
                return driver[n]
            return holder["src"][n]

        def load(n: str) -> DataFrame:
            ad = fixtures.ADAPTERS[n]
            return spark.sql(fixtures.render(n, "spark"), **{i: table(i) for i in ad.inputs})

        src = cls(spark, load)
        holder["src"] = src
        return src

    @classmethod
    def stored_fixtures(cls, spark: SparkSession, sf_dir: str) -> "Sources":
        """The derived test tables, written once per application and state of the test folder.

        A table is written when it is first asked for, after the tables that
        it derives from (those of one level as concurrent jobs), so a query
        writes what it needs only and reports scan stored tables as they
        would in production.  The tables of ``fixtures.BUCKETED`` are stored
        by order, so that joins on it read them without a shuffle,
        and those of ``fixtures.VIEWS`` are read from the line items stored
        so, not written again.  The folder lies under ``spark.checkpoint.dir``.
        """
        sf_dir = sf_dir.rstrip("/")
        listing = _listing(spark, sf_dir)
        key = (spark.sparkContext.applicationId, sf_dir, listing)
        buckets = max(8, sum(size for _, size, _ in listing) // fixtures.BUCKET_BYTES + 1)
        with _STORED_LOCK:
            root, written = _STORED.setdefault(key, (scratch_path(spark, "fixtures", scoped=False), set()))

        def table(n: str) -> DataFrame:
            if n in fixtures.DRIVER_TABLES:
                return spark.read.parquet(f"{sf_dir}/{n}.parquet")
            if n in fixtures.VIEWS:
                return _nullable(derived(n))
            return spark.read.table(bucketed(n)) if n in fixtures.BUCKETED else spark.read.parquet(f"{root}/{n}")

        def bucketed(n: str) -> str:
            return f"default.{root.rsplit('/', 1)[-1].replace('-', '_')}_{n}"

        def derived(n: str, **inputs: DataFrame) -> DataFrame:
            return spark.sql(fixtures.render(n, "spark"), **{i: inputs[i] if i in inputs else table(i) for i in fixtures.ADAPTERS[n].inputs})

        def write(n: str) -> None:
            if n not in fixtures.BUCKETED:
                derived(n).write.mode("overwrite").parquet(f"{root}/{n}")
                return
            source, theirs, ours = fixtures.BUCKETED[n]
            # dealt by the bucket key before any window: one shuffle, one file per bucket
            rows = derived(n, **{source: table(source).repartition(buckets, theirs)})
            (rows.write.mode("overwrite").format("parquet").option("compression", "zstd").option("path", f"{root}/{n}")
             .bucketBy(buckets, ours).saveAsTable(bucketed(n)))

        def load(n: str) -> DataFrame:
            with _STORED_LOCK:
                for level in fixtures.levels([n]):
                    missing = [x for x in level if x not in written and x not in fixtures.VIEWS]
                    with ThreadPoolExecutor(max_workers=4) as pool:
                        list(pool.map(write, missing))
                    written.update(missing)
            return table(n)

        return cls(spark, load)

    def prepare(self, names=None) -> "Sources":
        """Load ``names`` (all test tables by default) now."""
        for n in fixtures.ADAPTERS if names is None else names:
            self[n]
        return self

    def collated(self, collation: str = "UTF8_LCASE_RTRIM") -> "Sources":
        """The same tables with their strings under ``collation``.

        Equality, IN, joins and grouping then ignore case and trailing
        blanks, as a case-insensitive source database does.  ``plain`` turns a
        result's strings back into ordinary ones.
        """
        return Sources(self.spark, lambda n: _recollated(self[n], collation))


BAD_ROW = "_bad_row"


class CsvSources(Sources):
    """CSV folders with declared schemas.

    The header of every file must have the declared column names in their order, else
    reading fails (two swapped columns of one type would go unnoticed otherwise).  A row
    that does not fit the schema (a value of another type, missing or spare fields) is not
    in the table: ``rejected(name)`` has its text and file, so that it is neither lost nor
    turned into NULLs, and ``checked(name)`` raises if there is one.
    """

    def __init__(self, spark: SparkSession, root: str, header: bool = True):
        self._root, self._header = root.rstrip("/"), header
        super().__init__(spark, lambda n: self._split(n, bad=False).drop(BAD_ROW))

    def _split(self, name: str, bad: bool) -> DataFrame:
        rows = (self.spark.read.schema(f"{SCHEMAS[name]}, {BAD_ROW} STRING").option("header", self._header).option("mode", "PERMISSIVE")
                .option("enforceSchema", not self._header).option("columnNameOfCorruptRecord", BAD_ROW).csv(f"{self._root}/{name}"))
        # the parser judges a row by the columns it is asked for: a condition on all of them (always
        # true, though not to the optimizer) keeps the verdict the same whatever is selected later
        all_columns = F.xxhash64(*[c for c in rows.columns if c != BAD_ROW]) >= F.lit(-(1 << 63))
        text = F.coalesce(F.col(BAD_ROW), F.lit(""))
        return rows.where(all_columns & (text != "" if bad else text == ""))

    def rejected(self, name: str) -> DataFrame:
        """(file, row): text of the rows of ``name`` that do not fit its schema."""
        return self._split(name, bad=True).select(F.col("_metadata.file_path").alias("file"), F.col(BAD_ROW).alias("row"))

    def checked(self, name: str) -> DataFrame:
        """The table, after raising if any row of it was rejected (reads the files once more)."""
        some = [r["row"] for r in self.rejected(name).limit(3).collect()]
        if some:
            raise ValueError(f"{name} has rows that do not fit its schema, for example: {some}")
        return self[name]


def plain(df: DataFrame) -> DataFrame:
    """``df`` with ordinary string columns."""
    return _recollated(df, "UTF8_BINARY")


def _recollated(df: DataFrame, collation: str) -> DataFrame:
    return df.select(*[F.collate(F.col(f.name), collation).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
                       for f in df.schema.fields])


def _nullable(df: DataFrame) -> DataFrame:
    """``df`` with columns that may be NULL by schema, as those of a stored table (the optimizer drops the condition)."""
    return df.select(*[F.col(f.name) if f.nullable else F.when(F.lit(1) == F.lit(1), F.col(f.name)).alias(f.name) for f in df.schema.fields])


def _listing(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of the files of the driver tables: stored tables are not served after they change."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for n in fixtures.DRIVER_TABLES:
        for f in fs.listStatus(path(f"{folder}/{n}.parquet")):
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))
