"""Hot keys are split, repeated rows and long segments cost no more than their number."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstan.llm import bbit_minhash, byte_cnn, graph, piece_bpe, superkmer
from capstan.llm.queries import public_model

SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def skew(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def watched(monkeypatch, module):
    """Final plans of the tables that ``module`` stores, by name (each is run once more to see its adaptive plan)."""
    plans = []
    keep = module.stored

    def stored(df, name):
        df.collect()
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, name)

    monkeypatch.setattr(module, "stored", stored)
    return plans


def test_hub_of_a_component_is_split(spark, skew, monkeypatch):
    """A third of the edges meet in one node."""
    plans = watched(monkeypatch, graph)
    rows = [(0, i) for i in range(1, 9000)] + [(i, i + 1) for i in range(20_000, 38_000, 2)]
    edges = spark.createDataFrame(rows, "a long, b long").repartition(12)
    got = {r.id: r.component for r in graph.components(edges).collect()}
    assert all(got[i] == 0 for i in range(9000)) and got[20_001] == 20_000
    assert any("skew=true" in p for _, p in plans)


def test_class_of_equal_texts_is_split(spark, skew, monkeypatch):
    """A third of the documents is one text."""
    rows = [(i, "one text that very many documents share as it is" if i % 3 == 0 else f"text {i} of its own {i * 7} with words {i * 13} and {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    got = bbit_minhash.near_duplicates(docs, bbit_minhash.Settings(shingle=2))
    out = {r.doc_id: r.component_id for r in got.collect()}
    assert all(out[i] == 0 for i in range(0, 6000, 3)) and len(set(out.values())) == 4001
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_row_carry_each_range_once(spark):
    """Ranges carried per row do not grow with the number of copies."""
    passage = " ".join(f"w{i}" for i in range(40))
    sizes = []
    for copies in (100, 400):
        rows = [(0, passage)] + [(7, f"begin {passage} end")] * copies
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        with_ranges = superkmer._with_ranges(df, superkmer.Settings())
        sizes.append(with_ranges.agg(F.max(F.size("_lo"))).first()[0])
        got = superkmer.substring_digests(df).where("doc_id = 7").select("n_words", "n_removed").distinct().collect()
        assert [tuple(r) for r in got] == [(42, 40)]
    assert sizes[0] == sizes[1] <= 8


def test_fit_takes_one_row_per_id(spark, monkeypatch):
    """``fit_rows`` bounds what the driver gets, also when ids repeat thousands of times."""
    rows = [(i, f"good words here {i}" if i % 2 else f"@@ ## $$ {i}") for i in (1, 2, 3, 4)] * 500 + [(1, "zzz last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 4)] * 3, "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(byte_cnn, "train", lambda raw, y, s: seen.append(len(raw)) or "net")
    byte_cnn.fit(docs, labels, byte_cnn.Settings(fit_rows=4))
    assert seen and seen[0] <= 4


@pytest.mark.parametrize("text", [" " * 1_000_000, "=" * 1_000_000, "x" + "ab" * 150_000, "\n" * 200_000 + "tail",
                                  "".join(random.Random(5).choice("abcdefghij") for _ in range(1_000_000)),
                                  "".join(random.Random(6).choice(["  ", " ", "=", "==", "a"]) for _ in range(200_000))])
def test_very_long_segments_equal_the_library(text):
    import sentencepiece
    path = public_model()
    v = piece_bpe.load(path)
    raw = np.frombuffer(text.encode(), np.uint8)
    start = time.time()
    ids, _ = piece_bpe.Encoder(v).encode(raw, np.array([0, len(raw)]))
    assert time.time() - start < 30                   # quadratic work would take minutes
    assert ids.tolist() == sentencepiece.SentencePieceProcessor(model_file=path).encode(text, add_bos=True, add_eos=True)


def test_queue_and_rounds_agree(monkeypatch):
    """Forced to leave the rounds at once, words of every kind come out the same."""
    v = piece_bpe.load(public_model())
    rng = random.Random(7)
    text = " ".join("".join(rng.choice("abcé漢=- ") for _ in range(rng.randrange(1, 90))) for _ in range(300))
    raw = np.frombuffer(text.encode(), np.uint8)
    plain = piece_bpe.Encoder(v).encode(raw, np.array([0, len(raw)]))[0]
    monkeypatch.setattr(piece_bpe, "LONG", 4)
    assert piece_bpe.Encoder(v).encode(raw, np.array([0, len(raw)]))[0].tolist() == plain.tolist()


def plain_shards(rows, s):
    """The whole sharding over Python lists: hashes, sample, ranges, parts, cells and slots (cells are dealt by ``deal``)."""
    import bisect

    import xxhash

    def h64(*values):
        seed = 42
        for v in values:
            if v is not None:
                raw = v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True)
                seed = xxhash.xxh64_intdigest(raw, seed=seed)
        return seed - 2**64 if seed >= 2**63 else seed

    def pmod(*values, n):
        return h64(*values) % n

    recs = [(i, len((t or "").encode()) + 1, h64(t or "")) for i, t in rows]
    total = sum(size for _, size, _ in recs)
    n_ranges = max(s.ranges, 64 * s.shards)
    target = max(1, total // n_ranges)
    by_key = {}
    for _, size, key in recs:
        by_key[key] = by_key.get(key, 0) + size
    heavy = {k: b for k, b in by_key.items() if b > target}
    drawn = sorted((key, max(size, total / s.sample)) for i, size, key in recs
                   if key not in heavy and pmod(key, i, "draw", n=1 << 30) / float(1 << 30) < size * (s.sample / max(total, 1)))
    splitters, weight, goal = [], 0.0, float(target)
    for key, w in drawn:
        weight += w
        if weight >= goal and (not splitters or key > splitters[-1]):
            splitters.append(key)
            goal = weight + target
    base, order = len(splitters) + 1, sorted(heavy)
    named = []
    for i, size, key in recs:
        if key in heavy:
            named.append((base + order.index(key), pmod(i, "cut", n=-(-heavy[key] // target)), i, size, key))
        else:
            named.append((bisect.bisect_right(splitters, key), 0, i, size, key))
    filled = {}
    for r, _, _, size, _ in named:
        if r < base:
            filled[r] = filled.get(r, 0) + size
    over = {r: -(-b // target) for r, b in filled.items() if b > 2 * target}
    named = [(r, pmod(key, "again", n=over[r]) if r in over else p, i, size, key) for r, p, i, size, key in named]
    cells = {}
    for r, p, _, size, _ in named:
        b, n = cells.get((r, p), (0, 0))
        cells[r, p] = (b + size, n + 1)
    from capstan.llm.sharding import deal
    placed = deal([(r, p, b, n) for (r, p), (b, n) in cells.items()], s.shards, base, {base + k for k, x in enumerate(order) if heavy[x] <= max(1, total // s.shards)})
    out, seen = [], {}
    for r, p, i, size, key in sorted(named, key=lambda x: (x[0], x[1], x[4], x[2] is not None, x[2] or 0)):
        at = seen.get((r, p), 0)
        seen[r, p] = at + 1
        shard, before = placed[r, p]
        out.append((i is None, i or 0, size, shard, before + at))
    return sorted(out)


def test_shards_against_a_plain_version(spark, documents, odd, empty):
    from capstan.llm import sharding
    hot = spark.createDataFrame([(i, "one hot text of many copies" if i % 3 else f"text {i} " * (i % 9)) for i in range(4000)], "doc_id long, text string")
    for df in (documents, odd, hot, empty):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        for s in (sharding.Settings(), sharding.Settings(shards=3, ranges=16, sample=200)):
            got = sorted((r.doc_id is None, r.doc_id or 0, r.size, r.shard, r.slot) for r in sharding.shard(df, s).collect())
            assert got == plain_shards(rows, s)
