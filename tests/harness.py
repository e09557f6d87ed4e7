"""Spark-vs-DuckDB comparison used by the tests and ``scripts/check_oracle.py``.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values with columns sorted by name.  Values are normalised so
that engine-specific representations (int vs float, Decimal, NaN vs NA, numpy
vs Python timestamps) compare equal when the value is the same.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pandas as pd

DRIVER_VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    try:
        if v is pd.NA or v is pd.NaT:
            return None
    except TypeError:
        pass
    if isinstance(v, (bool,)):
        return int(v)
    if isinstance(v, (int, float, decimal.Decimal)) or hasattr(v, "dtype"):
        try:
            f = float(v)
        except (TypeError, ValueError):
            return str(v)
        if math.isnan(f):
            return None
        r = round(f, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, "" if x is None else str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    sc, dc = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if [c.lower() for c in sc] != [c.lower() for c in dc]:
        return False, f"columns differ: spark-only {set(sc) - set(dc)} duck-only {set(dc) - set(sc)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row count spark={len(spark_pdf)} duckdb={len(duck_pdf)}"
    a, b = rows(spark_pdf), rows(duck_pdf.rename(columns={d: s for s, d in zip(sc, dc)}))
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ (first: {diff}) columns={sc}"
    return True, f"{len(a)} rows"
