"""Training-data operators: quality rules, deduplication, sharding, scoring, extraction, archives.

Nothing outside this subpackage imports it.  Every operator takes and returns
Spark DataFrames; numpy works on the Arrow batches inside tasks only.  The
registered queries are in ``capstan.llm.queries``.
"""
