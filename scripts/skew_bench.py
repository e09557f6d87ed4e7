"""Skew check: the capacity report with one part-supplier holding a third of all tasks.

The task table is derived from the stored test tables with every third task
moved to one part-supplier (a hot key).  The report runs with the skew-safe
fan-out join and with a plain left join, broadcasts disabled (as for large
tables) and AQE skew thresholds sized for the test data.  Prints one JSON
line: seconds per variant, whether AQE split a skewed join, and whether both
variants return the same rows (count and an order-insensitive checksum).

usage: python scripts/skew_bench.py [SF_DIR]
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

import capstan.plans.capacity as cap  # noqa: E402
from capstan.config import FIXTURE_CONFIG as CFG  # noqa: E402
from capstan.session import local_session  # noqa: E402
from capstan.sources import Sources  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(cores=8, shuffle_partitions=32, app="capstan-skew")
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}.items():
        spark.conf.set(k, v)
    stored = Sources.stored_fixtures(spark, sf)
    # the hot key: the first part-supplier that the capacity report keeps
    hot = (cap.info_rows(stored, CFG, users=False).where(F.col("PartSupplierID").isNotNull())
           .agg(F.min("PartSupplierID")).first()[0])
    tasks = stored["portal_task"].withColumn(
        "PartSupplierID", F.when(F.col("PartSupplierTaskID") % 3 == 0, F.lit(hot)).otherwise(F.col("PartSupplierID")))
    skewed = Sources(spark, lambda n: tasks if n == "portal_task" else stored[n])

    def run(variant: str) -> dict:
        orig = cap.left_join_fanout
        if variant == "plain_left_join":
            cap.left_join_fanout = lambda left, right, on: left.join(right, list(on), "left")
        try:
            df = cap.capacity_data(skewed, CFG, version=2)
            df.write.format("noop").mode("overwrite").save()
            times = []
            for _ in range(3):
                t = time.perf_counter()
                df.write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - t)
            df.collect()                     # run this DataFrame's own plan to completion,
            plan = df._jdf.queryExecution().executedPlan().toString()   # then read its final adaptive plan
            check = df.select(F.count(F.lit(1)).alias("n"),
                              F.sum(F.pmod(F.xxhash64(*df.columns), F.lit(1000000007))).alias("h")).first()
        finally:
            cap.left_join_fanout = orig
        return {"sec": round(statistics.median(times), 3), "rows": check["n"], "checksum": str(check["h"]),
                "skew_split": "skew=true" in plan}

    res = {v: run(v) for v in ("fanout", "plain_left_join")}
    res["same_rows"] = (res["fanout"]["rows"], res["fanout"]["checksum"]) == \
        (res["plain_left_join"]["rows"], res["plain_left_join"]["checksum"])
    res["hot_part_supplier"] = hot
    print(json.dumps(res))


if __name__ == "__main__":
    main()
