"""Ranked lexical search against a plain scorer and DuckDB."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from capstan.llm import stratified_search as search
from capstan.llm.queries import ORACLE, QUERIES
from tests.harness import compare, duck
from tests.llm.conftest import LOWER, SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    text_of = {}
    for i, t in items:
        if i is not None:
            text_of[i] = t if text_of.get(i) is None else min(text_of[i], t if t is not None else text_of[i])
    out = []
    for item, text in text_of.items():
        scores = []
        for i, c, n in counts:
            m = 75 + (25 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scores[:top])]
    return sorted(out, key=lambda r: r[:2])


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_query_and_sql(spark, documents):
    got = QUERIES["op12_stratified_search"](spark, SF).toPandas()
    ok, why = compare(got, duck(SF).execute(ORACLE["op12_stratified_search"]).df())
    assert ok, why
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert result(spark.createDataFrame(got)) == brute(docs, items)


@pytest.mark.parametrize("settings", [search.Settings(), search.Settings(postings=64, block=16, vocabulary=4, visit=8, top=5)])
def test_odd_rows(spark, odd, settings):
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    items = [(1, "The OF end. w1 w2"), (2, None), (3, ""), (4, "w7 w7 w7 same"), (None, "w1"), (5, "nowhere else"), (6, "w1 w2"), (6, "w3"),
             (7, "naïve 漢字 Élan élan"), (8, docs[11][1])]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as terms", "2 as counts", "'s' as slice")
    assert result(search.search(odd, table, settings)) == brute(docs, items, settings.top)


def test_hot_stratum_and_ties(spark):
    """A third of the documents are copies of one text, most have one length: the stratum is cut into slices."""
    rows = [(i, "alpha beta gamma" if i % 3 == 0 else f"alpha w{i % 7} w{i % 11}") for i in range(900)] + [(5, "alpha beta gamma")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, "alpha beta"), (2, "w3 w3 w4 alpha"), (3, "gamma")]
    settings = search.Settings(postings=200, visit=50)
    assert result(search.search(docs, spark.createDataFrame(items, "item_id long, text string"), settings)) == brute(rows, items)
    index = search.build_index(docs)
    slices = search.laid_out(index, 200).groupBy("slice").count().collect()
    assert len(slices) > 10 and max(r["count"] for r in slices) < 120


def test_empty(spark, empty, odd):
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert search.search(empty, items).count() == 0
    assert search.search(odd, items.limit(0)).count() == 0
    assert search.search(odd, spark.createDataFrame([(1, None)], "item_id long, text string")).count() == 0


def test_strata_are_skipped():
    """Visiting by bound gives the same as visiting everything, and reads less."""
    rng = np.random.default_rng(5)
    n = np.sort(rng.integers(5, 400, 600))
    per = [np.unique(rng.zipf(1.3, k) % 50) for k in n]
    first = np.concatenate([[0], np.cumsum([len(p) for p in per])])
    part = search.Slice(n, np.concatenate(per).astype(np.int64), rng.integers(1, 9, first[-1]), first, np.arange(50), len(n), int(n.sum()))
    order = np.arange(len(n))
    at, w = np.array([3, 9, 40]), np.array([900, 4000, 8000])
    d, s = part.search(at, w, order, 20, 1)
    e, t = part.search(at, w, order, 20, 1 << 30)
    assert list(d) == list(e) and list(s) == list(t) and len(part.m) > 30
    read = []
    whole = part.doc
    part.doc = type("Counted", (), {"__getitem__": lambda self, p: read.append(len(p)) or whole[p]})()
    part.search(at, w, order, 20, 1)
    assert 0 < sum(read) < 0.9 * np.sum(np.isin(np.concatenate(per), at))
