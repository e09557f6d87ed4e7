"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001.

sf0.01 for all keys: ``python scripts/check_oracle.py``.
"""

import pytest

import __spark_entry__ as E
from capstan.oracle import oracle_sql
from capstan.queries import QUERIES
from harness import compare, duck

SF_SMALL = "/root/testdata/sf0.001"
SF_GATE = "/root/testdata/sf0.01"
KEYS = sorted(QUERIES)          # the report keys; optional subpackages test their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    oracle = E.oracle_sql().get(key)
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    assert oracle is not None, f"{key} has no oracle"
    ok, msg = compare(got, con.execute(oracle).df())
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES) <= set(E.queries())
    assert set(oracle_sql()) <= set(E.oracle_sql()) <= set(E.queries())


def test_flagship_at_gate_scale(spark):
    ok, msg = compare(E.queries()["merged_capacity_cost"](spark, SF_GATE).toPandas(),
                      duck(SF_GATE).execute(E.oracle_sql()["merged_capacity_cost"]).df())
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 42 and "PartID_x" in df.columns and "PartID_y" in df.columns
    assert df.count() > 0
