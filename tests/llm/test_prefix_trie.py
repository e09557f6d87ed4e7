"""Prefix trie of conversations against plain dictionaries and DuckDB."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from capstan.llm import prefix_trie as pt
from capstan.llm.queries import ORACLE, QUERIES
from tests.harness import compare, duck
from tests.llm.conftest import SF, split_words

COLUMNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    members, last = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        seq = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        last[seq].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        saved[k] = (len(members[k]) - 1) * (len(split_words(k[-1][1])) if k else 0) + sum(saved[x] for x in kids[k])
    return sorted((members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]), len(kids[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, last[k])).encode()).hexdigest()) for k in members)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def odd_turns():
    rng = random.Random(6)
    say = ["hi there", "hello\nworld  now", "", "x " * 200, "naïve 漢字", "\t \n"]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(say) if t > 1 else say[c % 2]) for c in range(90) for t in range(rng.randrange(0, 7))]
    rows += [(c, t, "user", f"turn {t}") for c in (200, 201, 202, 203, 219) for t in range(2 + c % 3)]
    rows += [(-7, 0, "user", "a"), (-20, 1, "user", "b"), (-19, 5, None, None), (300, None, "user", "late"), (300, 0, "user", "early"),
             (300, 0, "user", "early"), (300, 0, "a", "early"), (None, 0, "user", "nobody"), (301, 3, "user", "alone"), (2**62, 0, "user", "far")]
    rows += [(400, t, "user" if t % 2 else "assistant", f"long {t % 50}") for t in range(400)] + [(401, t, "user", "again") for t in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("settings", [pt.Settings(), pt.Settings(weight=8, shard=40, nodes=1 << 19), pt.Settings(weight=3, shard=10, nodes=5)])
def test_odd_rows(spark, odd_turns, settings):
    df = spark.createDataFrame(odd_turns, COLUMNS).repartition(4).selectExpr("*", "1 as pos", "'s' as slice", "2 as depth")
    assert result(pt.trie(df, settings)) == brute(odd_turns)


def test_query_and_sql(spark):
    got = QUERIES["op13_prefix_trie"](spark, SF).toPandas()
    ok, why = compare(got, duck(SF).execute(ORACLE["op13_prefix_trie"]).df())
    assert ok, why
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(spark.createDataFrame(got)) == [tuple(r) for r in brute(rows)]


def test_hot_conversation_spans_ranges(spark):
    """Half of all turns are one conversation, half of all conversations are copies: positions, digests and ends hold."""
    rows = [(1000, t, "user", f"say {t // 3}") for t in range(600)] + [(c, t, "user", f"copy {t}") for c in range(0, 6000, 20) for t in range(2)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = pt.turns(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges.where("conv_id = 1000").select("slice").distinct().count() > 2
    pos = sorted(r.pos for r in pt.positioned(ranges).where("conv_id = 1000").select("pos").collect())
    assert pos == list(range(602))
    many, pt.turns = pt.turns, lambda _: ranges
    try:
        assert result(pt.trie(df, pt.Settings(weight=50, shard=100, nodes=64))) == brute(rows)
    finally:
        pt.turns = many
    assert result(pt.trie(df, pt.Settings(weight=50, shard=100, nodes=64))) == brute(rows)


def test_empty(spark):
    assert pt.trie(spark.createDataFrame([], COLUMNS)).count() == 0
    assert pt.trie(spark.createDataFrame([(None, 1, "a", "b")], COLUMNS)).count() == 0


def test_arithmetic():
    rng = np.random.default_rng(7)
    p = int(pt.PRIME)
    a, b = (rng.integers(0, p, 300).astype(np.uint64) for _ in range(2))
    a[:3] = [0, p - 1, p - 1]
    b[:3] = [p - 1, p - 1, 1]
    assert [int(x) for x in pt.times(a, b)] == [int(x) * int(y) % p for x, y in zip(a, b, strict=True)]
    assert [int(x) for x in pt.power(pt.BASES[0], np.arange(300))] == [pow(pt.BASES[0], n, p) for n in range(300)]
    first = np.array([0, 7, 8, 100])
    got = pt.running(a, first)
    want, total = [], 0
    for i, x in enumerate(a):
        total = int(x) if i in first else (total + int(x)) % p
        want.append(total % p)
    assert [int(x) for x in got] == want


def test_node_table():
    rng = np.random.default_rng(8)
    keys = [rng.integers(-2**62, 2**62, 5000), rng.integers(0, 3, 5000), np.arange(5000) % 7]
    t = pt.NodeTable(keys)
    assert sorted(t.slots) == list(range(5000))
    assert (t.find([k[::-1].copy() for k in keys]) == t.slots[::-1]).all()
    absent = [keys[0] + 1, keys[1], keys[2]]
    assert (t.find(absent) == -1).all()
    with pytest.raises(RuntimeError):
        pt.NodeTable([np.zeros(2, np.int64)] * 3)
