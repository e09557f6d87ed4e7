"""Quality rules, substring dedup, near duplicates, decontamination and tokens against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from capstan.llm import bbit_minhash, cgk, piece_bpe, quality_llr, superkmer
from capstan.llm.graph import components
from capstan.llm.words import hash_runs, slices, words
from tests.llm.conftest import LOWER, SF, odd_texts, split_words


def test_words_are_the_regular_expressions(spark):
    texts = [t for _, t in odd_texts()]
    got = []
    for _, _, data, off in slices(pa.array(texts), 700):
        s, e, first = words(data, off)
        h = hash_runs(data, s, e, 64)
        for a, b in zip(first[:-1], first[1:]):
            got.append([(data[s[k]:e[k]].tobytes().decode(), int(h[k])) for k in range(a, b)])
    assert [[w for w, _ in d] for d in got] == [split_words(t) for t in texts]
    names = defaultdict(set)
    for d in got:
        for w, h in d:
            names[h].add(w)
    assert all(len(v) == 1 for v in names.values())


# ------------------------------------------------------------------ op1

def brute_base(text):
    w = split_words(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    out = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
    return out + (out[0] < 20 or 100 * out[4] > 30 * out[0],)


def check_base(df, got):
    want = sorted(((i if i is not None else -1), *brute_base(t)) for i, t in df.select("doc_id", "text").collect())
    have = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in got)
    assert have == want


def brute_llr(texts, trusted, n, bits, threshold):
    def buckets(t):
        b = (t or "").encode()
        return [int.from_bytes(b[i:i + n], "big") * 0x9E3779B97F4A7C15 % 2 ** 64 >> (64 - bits) for i in range(len(b) - n + 1)]
    raw, target = Counter(), Counter()
    for t in texts:
        raw.update(buckets(t))
    for t in trusted:
        target.update(buckets(t))
    size, a = 2 ** bits, quality_llr.SMOOTHING
    total, ttotal = sum(raw.values()), sum(target.values())
    p = lambda b: (raw[b] + a) / (total + a * size)                                            # noqa: E731
    q = lambda b: (target[b] + a * size * p(b)) / (ttotal + a * size)                          # noqa: E731
    return [sum(math.log(q(b) / p(b)) for b in buckets(t)) / max(1, len(buckets(t))) if ttotal else 0.0 for t in texts]


def test_quality_rules_match_brute_force(spark, documents, labels):
    model = quality_llr.fit(documents, labels)
    got = quality_llr.quality_rules(documents, model).collect()
    check_base(documents, got)
    rows = documents.select("doc_id", "text").collect()
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    want = dict(zip([r.doc_id for r in rows], brute_llr([r.text for r in rows], [r.text for r in rows if r.doc_id in good],
                                                        model.ngram, model.bits, model.threshold)))
    for r in got:
        assert abs(r.llr - want[r.doc_id]) < 1e-4
        assert r.kept == (not r.base_failed and r.llr >= model.threshold)
    # clean labelled documents stay, labelled junk mostly goes
    q = {r.doc_id: r.quality for r in labels.collect()}
    sound = [r for r in got if q.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r for r in got if q.get(r.doc_id) == 0]
    assert all(r.kept for r in sound) and sum(r.kept for r in junk) <= 0.1 * len(junk)


def test_quality_rules_on_odd_tables(spark, odd, empty, labels):
    model = quality_llr.fit(odd, labels)
    check_base(odd, quality_llr.quality_rules(odd, model).collect())
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    blank = quality_llr.fit(odd, nothing)
    assert {r.llr for r in quality_llr.quality_rules(odd, blank).collect()} == {0.0}
    kept = quality_llr.quality_filter(odd, blank)
    assert kept.schema == odd.schema
    assert kept.count() == sum(not brute_base(t)[-1] for _, t in odd_texts())
    assert quality_llr.quality_rules(empty, quality_llr.fit(empty, labels)).count() == 0
    assert quality_llr.quality_filter(empty, blank).count() == 0


# ------------------------------------------------------------------ op2

def brute_repeats(rows, k=13):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = split_words(t)
        for j in range(len(w) - k + 1):
            first.setdefault(tuple(w[j:j + k]), i)
    out = []
    for i, t in rows:
        w = split_words(t)
        gone = set()
        if i is not None:
            for j in range(len(w) - k + 1):
                if first[tuple(w[j:j + k])] < i:
                    gone.update(range(j, j + k))
        out.append((-1 if i is None else i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out)


SPLIT = superkmer.Settings(slice_bytes=3000, bucket_bytes=3000, overfull=1)


@pytest.mark.parametrize("settings", [superkmer.Settings(), SPLIT])
def test_substring_dedup_matches_brute_force(spark, documents, odd, settings):
    for df in (documents, odd):
        got = superkmer.substring_digests(df, settings).collect()
        want = brute_repeats([tuple(r) for r in df.select("doc_id", "text").collect()])
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == \
            sorted((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in want)


def test_substring_dedup_changes_only_what_repeats(spark, odd, empty):
    out = superkmer.remove_repeats(odd)
    assert out.columns == odd.columns
    want = brute_repeats([tuple(r) for r in odd.select("doc_id", "text").collect()])
    raw = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    texts = sorted((-1 if i is None else i, t or "") for i, t in out.select("doc_id", "text").collect())
    expected = []
    for i, t in raw:
        n, g, kept = next((n, g, k) for j, n, g, k in want if j == (-1 if i is None else i) and n == len(split_words(t)))
        expected.append((-1 if i is None else i, kept if g else t or ""))
    assert texts == sorted(expected)
    # lengths follow the text where it changed, and only there
    sized = superkmer.remove_repeats(odd.selectExpr("doc_id", "text", "-7L as n_chars")).collect()
    raw_texts = {(-1 if i is None else i, t) for i, t in raw}
    assert all(r.n_chars == (-7 if (-1 if r.doc_id is None else r.doc_id, r.text) in raw_texts else len(r.text)) for r in sized)
    assert any(r.n_chars != -7 for r in sized)
    assert superkmer.substring_digests(empty).count() == 0 and superkmer.remove_repeats(empty).count() == 0


def test_equal_hashes_are_told_apart():
    """Windows are compared byte for byte: a bucket of equal hashes still separates different words."""
    text = np.frombuffer(b"aa bb aa bc aa bb ", np.uint8)
    assert superkmer._differs(text, np.array([0, 0]), np.array([6, 12]), np.array([5, 5])).tolist() == [True, False]


# ------------------------------------------------------------------ op10

def brute_components(rows, n, percent=80):
    sets = {}
    for i, t in rows:
        w = split_words((t or "").translate(LOWER))
        s = set(zip(*(w[k:] for k in range(n)))) if len(w) >= n else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    ids = sorted(i for i in sets if i is not None)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and any(p and q and 100 * len(p & q) >= percent * len(p | q) for p in sets[a] for q in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (find(i), [len(s) for s in sets[i]]) for i in ids}


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates_match_brute_force(spark, documents, odd, shingle):
    for df in (documents, odd):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        want = brute_components(rows, shingle)
        got = bbit_minhash.near_duplicates(df, bbit_minhash.Settings(shingle=shingle)).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.doc_id is None:
                assert r.component_id is None and r.kept
            else:
                assert r.component_id == want[r.doc_id][0] and r.n_shingles in want[r.doc_id][1]
                assert r.kept == (r.doc_id == r.component_id)


def test_a_large_ambiguous_family(spark):
    """Variants of one text near the threshold: links between variants are found, in one block or many."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(2, 16)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(9000)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 2)
    for block in (1024, 7):
        got = bbit_minhash.near_duplicates(df, bbit_minhash.Settings(shingle=2, block=block)).collect()
        assert {r.doc_id: r.component_id for r in got} == {i: c for i, (c, _) in want.items()}
    assert 1 < len({c for c, _ in want.values()}) < 90


def test_near_duplicate_filter(spark, odd, empty):
    kept = bbit_minhash.near_duplicate_filter(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert None in ids and 0 in ids
    assert bbit_minhash.near_duplicates(empty).count() == 0 and bbit_minhash.near_duplicate_filter(empty).count() == 0


def test_short_texts_keep_their_word_order(spark):
    texts = ["a b c", "a c b", "A b c", "b a c", "a b", "b a", "a", "a b c d", "a d c b", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in bbit_minhash.near_duplicates(df).collect()}
    assert got == {**{i: i for i in range(10)}, 2: 0, 9: 6}
    assert {r.doc_id for r in bbit_minhash.near_duplicate_filter(df).collect()} == {0, 1, 3, 4, 5, 6, 7, 8}


def test_components_of_paths_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_signature_estimate_is_unbiased():
    rng = np.random.default_rng(1)
    s = bbit_minhash.Settings()
    shared, a, b = (rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in (800, 100, 100))
    flat = [np.unique(np.concatenate([shared, x])) for x in (a, b)]
    m = bbit_minhash.minima(np.concatenate(flat), np.array([0, len(flat[0]), len(flat[0]) + len(flat[1])]), s.hashes)
    v = np.bitwise_xor(*bbit_minhash.pack((m ^ (m >> np.uint32(15))) & np.uint32(3), s.longs))
    match = 1 - int(np.bitwise_count((v | (v >> np.uint64(1))) & np.uint64(bbit_minhash._HALF)).sum()) / s.hashes
    assert abs((match - 0.25) / 0.75 - 0.8) < 0.13


# ------------------------------------------------------------------ op9

def brute_edits(words_, item):
    """Least edits between the item and any run of the words (semi-global alignment)."""
    line = [0] * (len(words_) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(words_):
            new.append(min(line[j] + (x != y), line[j + 1] + 1, new[j] + 1))
        line = new
    return min(line)


def test_decontamination_matches_brute_force(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: split_words(r.text.translate(LOWER)) for r in benchmark.collect()}
    rng = random.Random(2)
    rows = [(r.doc_id, r.text) for r in documents.limit(60).collect()]
    for k, (i, w) in enumerate(sorted(items.items())[:30]):
        w = list(w)
        for _ in range(rng.randrange(0, len(w) // 4 + 2)):
            p = rng.randrange(len(w))
            w[p:p + rng.randrange(2)] = [f"zz{rng.randrange(99)}"][:rng.randrange(2)]
        rows.append((10000 + k, "Some words before. " + " ".join(w).upper() + " and some after it"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {}
    for d, t in rows:
        w = split_words((t or "").translate(LOWER))
        for i, item in items.items():
            if len(item) >= 8 and len(set(w) & set(item)) > 2:
                e = brute_edits(w, item)
                if e <= int(0.2 * len(item)):
                    want[d, i] = e
    got = {(r.doc_id, r.item_id): r.edits for r in cgk.contaminated(df, benchmark).collect()}
    assert set(got) <= set(want) and len(want) > 15
    assert len(got) >= 0.98 * len(want)                       # target recall, over all allowed edits
    assert all(got[k] == want[k] for k in got)
    exact = {k for k, e in want.items() if e == 0}
    assert exact <= set(got)
    blocks = cgk.Settings(block_bytes=500)
    assert {(r.doc_id, r.item_id) for r in cgk.contaminated(df, benchmark, blocks).collect()} == set(got)
    clean = cgk.drop_contaminated(df, benchmark)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_short_items_match_brute_force(spark):
    """Items of one to seven words: all matches, with one edit from five words on."""
    rng = random.Random(8)
    say = lambda n: [f"w{rng.randrange(9)}" for _ in range(n)]                             # noqa: E731
    items = [(k, " ".join(say(1 + k % 9))) for k in range(45)] + [(90, None), (91, " "), (None, "W1 w2"), (92, "w1 w2")]
    rows = [(k, " ".join(say(rng.randrange(0, 40)))) for k in range(80)] + [(200, None), (201, "w1"), (202, "w1 w2")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in rows:
        for i, x in items:
            w, item = split_words((t or "").lower()), split_words((x or "").lower())
            if 0 < len(item) < 8 and (e := brute_edits(w, item)) <= int(0.2 * len(item)):
                want.add((d, i, e))
    long_items = {i for i, x in items if len(split_words(x)) >= 8}
    got = [tuple(r)[:3] for r in cgk.contaminated(docs, bench, cgk.Settings(shortest=1)).collect() if r.item_id not in long_items]
    assert len(got) == len(set(got)) and set(got) == want and {e for *_, e in want} == {0, 1}
    only = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")
    kept = {r.doc_id for r in cgk.drop_contaminated(docs, only, cgk.Settings(shortest=1)).collect()}
    assert kept == {d for d, _ in rows} - {d for d, i, _ in want if i == 92}


def test_registered_queries_search_short_items(spark, tmp_path):
    import corpus_pipeline
    from capstan.llm.queries import QUERIES
    docs = spark.createDataFrame([(1, "before this is a short benchmark item after"), (2, "something else")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "this is a short benchmark item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [(r.doc_id, r.item_id) for r in QUERIES["op9_cgk_decontamination"](spark, str(tmp_path)).collect()] == [(1, 7)]
    assert [r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()] == [2]


def test_decontamination_on_odd_tables(spark, odd, empty):
    item = next(t for _, t in odd_texts() if t and len(split_words(t)) == 40)
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "two words"), (None, item)], "item_id long, text string")
    got = cgk.contaminated(odd, bench, cgk.Settings(shortest=8)).collect()
    short = cgk.contaminated(odd, bench).collect()             # by default items of every length
    assert {(r.doc_id, r.item_id) for r in short} - {(r.doc_id, r.item_id) for r in got} == {(12, 5)}
    assert {r.item_id for r in got} == {1, 2, None} and {21, 24, 27, 30, 33} <= {r.doc_id for r in got}
    assert cgk.drop_contaminated(odd, bench).schema == odd.schema
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert cgk.contaminated(odd, nothing).count() == 0 and cgk.drop_contaminated(odd, nothing).count() == odd.count()
    assert cgk.contaminated(empty, bench).count() == 0


# ------------------------------------------------------------------ op7

@pytest.fixture(scope="module")
def model_path():
    public = pytest.importorskip("public_tokenizers")
    return public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model_path):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model_path)


def test_tokens_match_the_library(spark, documents, odd, empty, model_path, library):
    for df in (documents, odd):
        want = []
        for i, t in df.select("doc_id", "text").collect():
            ids = library.encode(t or "", add_bos=True, add_eos=True)
            want.append((-1 if i is None else i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        got = piece_bpe.token_digests(df, model_path).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert piece_bpe.token_digests(empty, model_path).count() == 0
    full = piece_bpe.encode_documents(odd, model_path).collect()
    assert all(r.ids[0] == library.bos_id() and r.ids[-1] == library.eos_id() for r in full)
    assert sorted(r.text for r in full) == sorted(library.decode(list(r.ids)) for r in full)


def test_tokens_of_random_texts(model_path, library):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    v = piece_bpe.load(model_path)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aabbc e▁ \n\t<s>0x0A"), st.characters(exclude_categories=["Cs"])), max_size=60),
                    min_size=1, max_size=6))
    def same(texts):
        enc = piece_bpe.Encoder(v)
        for lo, hi, data, off in slices(piece_bpe._plain(pa.array(texts, pa.string()))):
            ids, first = enc.encode(data, off)
            text, toff = piece_bpe.decode(v, ids, first)
            for k in range(lo, hi):
                want = library.encode(texts[k], add_bos=True, add_eos=True)
                assert ids[first[k - lo]:first[k - lo + 1]].tolist() == want
                assert text[toff[k - lo]:toff[k - lo + 1]].tobytes().decode() == library.decode(want)
    same()


def test_the_words_regex():
    assert [split_words(t) for _, t in odd_texts()] == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in odd_texts()]
