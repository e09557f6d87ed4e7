"""What stored steps and stored tables leave on disk."""

import time

from pyspark.sql import functions as F


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    from capstan.llm.common import stored
    before = _shuffle_files(spark)
    rows = stored(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n")), "disk-test")
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert rows.agg(F.count("*"), F.sum("n")).first() == (700, 5000)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_line_items_are_shuffled_once(spark):
    """Stored by order: the joins on the order key read them without an exchange."""
    from capstan.config import FIXTURE_CONFIG as CFG
    from capstan.plans import pricing
    from capstan.sources import Sources
    src = Sources.stored_fixtures(spark, "/root/testdata/sf0.001")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in pricing.price_lines(src, CFG)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_lines_of_capacity_tasks_reach_the_window(spark):
    from capstan.config import FIXTURE_CONFIG as CFG
    from capstan.plans import capacity
    from capstan.sources import Sources
    src = Sources.stored_fixtures(spark, "/root/testdata/sf0.001")
    tasks, every = capacity.capacity_tasks(src, CFG), capacity.capacity_lines(src, CFG)
    some = capacity.capacity_lines(src, CFG, tasks)
    of_tasks = [df.join(tasks, "PartSupplierTaskID", "left_semi").collect() for df in (some, every)]
    assert sorted(map(str, of_tasks[0])) == sorted(map(str, of_tasks[1])) and of_tasks[0]
    assert some.count() < every.count() / 2
    assert "bitmap" in capacity.capacity_data(src, CFG)._jdf.queryExecution().optimizedPlan().toString().lower()
