"""Nearest vectors against brute force."""

import math

import numpy as np
import pytest

from capstan.llm import adaptive_scan as ann
from capstan.llm.queries import QUERIES


def brute(rows, top=20, every=20):
    """{query: [(vec_id, score)]}: all pairs, in double precision."""
    ok = {}
    for i, e in rows:
        if i is None or not e or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            continue
        e = tuple(float(x) + 0.0 for x in e)
        ok[i] = min(ok.get(i, e), e)
    dim = max(map(len, ok.values()), default=0)
    ids = np.array(sorted(ok))
    x = np.array([list(ok[i]) + [0.0] * (dim - len(ok[i])) for i in ids]).reshape(len(ids), -1)
    out = {}
    for k, i in enumerate(ids):
        if i % every == 0:
            s = x @ x[k]
            o = [j for j in np.lexsort((ids, -s)) if j != k][:top]
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in o]
    return out


def recall(got, want):
    """Share of the wanted rows found (by score, so that equal scores may stand for one another); checks ranks and scores."""
    have = {}
    for r in got:
        have.setdefault(r.query_id, []).append(r)
    assert set(have) == {q for q, w in want.items() if w}
    hit = total = 0
    for q, rows in have.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == len({r.vec_id for r in rows}) == len(want[q])
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        assert all(r.vec_id != q for r in rows)
        hit += len({r.vec_id for r in rows} & {i for i, _ in want[q]})
        total += len(want[q])
    return hit / max(total, 1)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_query_recall(spark, folder):
    sf = f"/root/testdata/{folder}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op11_adaptive_scan"](spark, sf).collect()
    assert recall(got, brute(rows)) >= 0.93


def test_scores_are_exact_and_lists_are_abandoned_early():
    """On clustered vectors few components are read, and every neighbour inside the probed lists is found."""
    rng = np.random.default_rng(1)
    mid = rng.standard_normal((40, 64))
    x = mid[rng.integers(0, 40, 6000)] + 0.3 * rng.standard_normal((6000, 64))
    norm = float(np.linalg.norm(x, axis=1).max()) * (1 + 1e-12)
    index = ann.fit(x[:2000], norm, len(x), ann.Settings())
    q = x[:200]
    home = ann._lists(index, ann.augmented(x, norm) @ index.rotation)
    every = [np.unique(home)] * len(q)
    s = q @ x.T
    floor = np.sort(s[:, :2000], axis=1)[:, -33]
    query, score, row, read = ann.scan(index, x, home, q, every, floor)
    assert read < 0.5 * len(q) * x.size
    found = total = 0
    for k in range(len(q)):
        want = set(np.argsort(-s[k], kind="stable")[:21])
        found += len(want & set(row[query == k]))
        total += 21
        assert np.allclose(np.sort(score[query == k]), np.sort(s[k][row[query == k]]), rtol=1e-12)
    assert found / total > 0.99


def test_quantile():
    rng = np.random.default_rng(2)
    x = rng.beta(8, 24.5, 400_000)
    assert abs(np.quantile(x, 0.999) - ann.beta_quantile(8, 24.5, 0.999)) < 0.004


def test_norms_of_all_sizes(spark):
    """Inner product, not angle: long vectors win."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(24) * 10.0 ** rng.uniform(-3, 3)).tolist()) for i in range(1500)]
    assert recall(ann.nearest(frame(spark, rows, "double")).collect(), brute(rows)) >= 0.95


def test_hot_vector_and_small_blocks(spark):
    """A third of the rows is one vector; units, query blocks and lists are split."""
    rng = np.random.default_rng(4)
    hot = rng.standard_normal(16).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.standard_normal(16).tolist()) for i in range(2400)]
    got = ann.nearest(frame(spark, rows, "double"), ann.Settings(block=128, fit_rows=400)).collect()
    want = brute(rows)
    assert recall(got, want) >= 0.93
    some = sorted((r for r in got if r.query_id == 60), key=lambda r: r.rank)
    assert [r.vec_id for r in some] == [i for i in range(0, 64, 3) if i != 60][:20]      # ties: the smallest ids


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (20, [1.0]),
            (7, [-0.0, 2.0]), (8, [0.0, 2.0]), (None, [1.0, 1.0]), (40, [-1.0, -1.0]), (40, [-2.0, 5.0]), (0, [1.0, 0.0]),
            (9, [1e30, -1e30]), (-20, [3.0, 3.0, 3.0])]
    df = frame(spark, rows).selectExpr("*", "1 as rank", "2.0 as score", "'q' as query_id", "7 as qid", "3 as unit")
    got = ann.nearest(df).collect()
    want = brute([(i, e and [x if x is None else float(np.float32(x)) for x in e]) for i, e in rows])
    assert set(want) == {0, 20, 40, -20}
    for q, w in want.items():
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == w
    assert ann.nearest(frame(spark, [])).count() == 0
    assert ann.nearest(frame(spark, [(0, [0.0]), (1, None)])).count() == 0
    assert ann.nearest(frame(spark, [(0, [1.0])])).count() == 0
    assert [tuple(r) for r in ann.nearest(frame(spark, [(0, [2.0]), (3, [1.0])])).collect()] == [(0, 1, 3, 2.0)]
