"""Shared scratch folder rules and derived-table freshness."""

import pytest

from capstan import session
from capstan.sources import Sources
from capstan.sources import tables

SF = "/root/testdata/sf0.001"


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    sparkContext = _Context()
    conf = _Conf()


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session())


def test_only_the_needed_tables_are_written(spark, tmp_path):
    import shutil

    copy = tmp_path / "sf"
    copy.mkdir()
    for n in tables.fixtures.DRIVER_TABLES:
        shutil.copy(f"{SF}/{n}.parquet", copy / f"{n}.parquet")
    src = Sources.stored_fixtures(spark, str(copy))
    before = src["erp_unit"].count()
    key = (spark.sparkContext.applicationId, str(copy), tables._listing(spark, str(copy)))
    assert tables._STORED[key][1] == {"erp_unit"}
    # a changed file means new tables
    (copy / "region.parquet").chmod(0o644)
    spark.read.parquet(f"{SF}/region.parquet").limit(2).toPandas().to_parquet(copy / "region.parquet")
    assert Sources.stored_fixtures(spark, str(copy))["erp_unit"].count() == 2 != before
