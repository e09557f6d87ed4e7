"""capstan: supply-chain capacity and cost reports as lazy Spark plans.

Layout
    config      business parameters (task/tag ids, cut-offs, ...) and fixed labels
    sources     where domain tables come from (parquet, catalog, JDBC, test fixtures)
    functions   Column builders: status and label CASE logic, date helpers
    operators   reusable DataFrame operators (latest per key, tag flags, merges, sinks)
    plans       the reports: capacity, pricing / QPV, merged reports
    streaming   incremental snapshot accumulation with Structured Streaming
    run         command line: run a report or a snapshot load and write it out
    queries     registry of the report queries over the test tables (driver contract)
    oracle      DuckDB SQL of each registered query (correctness oracle)
"""

from capstan.config import FIXTURE_CONFIG, Config
from capstan.sources import Sources

__all__ = ["Config", "FIXTURE_CONFIG", "Sources"]
