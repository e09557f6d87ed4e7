"""Sharding, classifier, language model, page text, archives, pipeline and registry."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from capstan.llm import arc_convert, byte_cnn, hpy, sharding, templates
from capstan.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import LOWER, SF, split_words


# ------------------------------------------------------------------ op3

def check_shards(rows, got, shards=8):
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (i is None, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding(spark, documents, odd, empty):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = sharding.shard(documents).collect()
    check_shards(rows, got)
    total = Counter()
    for r in got:
        total[r.shard] += r.size
    assert max(total.values()) <= 1.05 * sum(total.values()) / 8 and len(total) == 8
    shard_of = defaultdict(set)
    for r in got:
        shard_of[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())          # equal texts stay together
    assert sorted(map(tuple, got)) == sorted(map(tuple, sharding.shard(documents).collect()))
    check_shards([tuple(r) for r in odd.select("doc_id", "text").collect()], sharding.shard(odd).collect())
    assert sharding.shard(empty).count() == 0


def test_sharding_cuts_a_text_that_overfills_a_shard(spark):
    rows = [(i, "a common text" if i % 3 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(df).collect()
    check_shards(rows, got)
    total = Counter()
    for r in got:
        total[r.shard] += r.size
    assert max(total.values()) <= 1.1 * sum(total.values()) / 8


def test_range_search(spark):
    from pyspark.sql import functions as F
    cuts = sorted(random.Random(3).sample(range(-50, 50), 13))
    keys = spark.range(-60, 60).select("id", sharding._range_of(F.col("id"), cuts).alias("n")).collect()
    assert all(r.n == sum(c <= r.id for c in cuts) for r in keys)


# ------------------------------------------------------------------ op4

def test_classifier(spark, odd, empty, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    net = byte_cnn.fit(docs, marks)
    got = {r.doc_id: r for r in byte_cnn.classify(docs, net).collect()}
    assert len(got) == docs.count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.quality, got[r.doc_id].score) for r in marks.collect() if r.doc_id in got and got[r.doc_id].held_out]
    good, bad = [s for q, s in held if q == 1], [s for q, s in held if q == 0]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.95
    odd_scores = byte_cnn.classify(odd, net).collect()
    assert len(odd_scores) == odd.count() and all(0 <= r.score <= 1 for r in odd_scores)
    assert byte_cnn.classify(empty, net).count() == 0
    # labels of held-out rows are never used
    flipped = marks.selectExpr("doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2 then 1 - quality else quality end as quality")
    again = byte_cnn.fit(docs, flipped)
    assert np.array_equal(again.first, net.first) and again.out_bias == net.out_bias
    none = byte_cnn.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in byte_cnn.classify(odd, none).collect()} == {0.5}


def brute_score(net, text):
    """Filters over every position, chunk by chunk, in plain loops."""
    s = net.settings
    raw = list((text or "").encode())
    n = -(-len(raw) // s.stride) * s.stride
    sym = raw + [byte_cnn.PAD] * (n - len(raw))
    echo = [0.0] * n
    for i in range(len(raw)):
        for lag in byte_cnn.LAGS:
            if i - lag - s.echo + 1 >= 0 and all(raw[i - k] == raw[i - k - lag] for k in range(s.echo)):
                echo[i] = 1.0
    x = np.array([[*net.embed[c], e] for c, e in zip(sym, echo)]).reshape(-1, s.step * (s.width + 1)) if n else np.zeros((0, 1))
    pad = np.array([[*net.embed[byte_cnn.PAD], 0.0]] * s.step).reshape(-1) if n else None
    y = [x[i] @ net.first + (x[i + 1] if i + 1 < len(x) else pad) @ net.second for i in range(len(x))]
    per, width = s.stride // s.step, (s.stride + s.overlap) // s.step
    chunks = [np.maximum(np.max(y[a:a + width], axis=0) + net.bias, 0) for a in range(0, len(y), per)]
    pooled = np.mean(chunks, axis=0) if chunks else np.zeros(s.filters)
    return 1 / (1 + math.exp(-float(pooled @ net.out + net.out_bias)))


def test_scores_cover_every_byte():
    import pyarrow as pa

    from capstan.llm.words import slices
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n") for _ in range(n)) for n in (0, 1, 447, 448, 449, 460, 900, 2000)]
    net = byte_cnn.train([t.encode() for t in texts], np.array([0, 1] * 4, np.float32), byte_cnn.Settings(updates=3))
    for size in (500, 1 << 20):
        got = np.concatenate([byte_cnn.scores(net, data, off) for _, _, data, off in slices(pa.array(texts), size)])
        assert np.allclose(got, [brute_score(net, t) for t in texts], atol=1e-5)


# ------------------------------------------------------------------ op5

def test_language_model(spark, documents, odd, empty):
    for df, s in ((documents, hpy.Settings()), (documents, hpy.Settings(unit_bytes=60_000, bucket_bytes=40_000)), (odd, hpy.Settings())):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        tokens = [(i, [*split_words((t or "").translate(LOWER)), None]) for i, t in rows]
        held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0                    # noqa: E731
        c = Counter(w for i, ws in tokens if not held(i) for w in ws)
        n, v = sum(c.values()), len(c)
        base = lambda ws: sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)      # noqa: E731
        want = sorted((i is None, i or 0, held(i), len(ws), sum(c[w] > 0 for w in ws), round(base(ws), 6)) for i, ws in tokens)
        got = hpy.score_documents(df, s).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
        assert {r.train_tokens for r in got} == {n}
        assert all(math.isfinite(r.score) and r.score < 0 and r.perplexity >= 1 for r in got)
        if df is documents:
            out = [r for r in got if r.held_out]
            assert sum(r.score for r in out) > sum(r.base_score for r in out)                  # better than the unigram base
    assert hpy.score_documents(empty).count() == 0


def test_tables_of_few_customers():
    """One table for one customer, at most one a customer; two share with chance (1 - d) / (1 - d + a)."""
    rng = np.random.default_rng(2)
    customers = np.array([0, 1, 2, 5, 300, 40000])
    for _ in range(30):
        tables = hpy.draw_tables(customers, np.full(6, 0.7), 0.8, rng)
        assert tables[0] == 0 and tables[1] == 1 and (tables[2:] >= 1).all() and (tables <= customers).all()
    n, d, a = 4000, 0.5, 0.9
    shared = (hpy.draw_tables(np.full(n, 2), np.full(n, a), d, rng) == 1).mean()
    assert abs(shared - (1 - d) / (1 - d + a)) < 0.03


def exact_tables(dishes, s):
    """Mean tables of each dish {(word, room): customers}, over all seatings of the whole model."""
    keys = list(dishes)

    def stirling(c, d):
        row = {1: 1.0}
        for k in range(1, c):
            row = {t: row.get(t - 1, 0) + (k - d * t) * row.get(t, 0) for t in range(1, k + 2)}
        return row

    def rise(x, step, n):
        return math.prod(x + step * i for i in range(n))

    words = {w for w, _ in keys}
    total, mean = 0.0, np.zeros(len(keys))
    for t in itertools.product(*[range(1, dishes[k] + 1) for k in keys]):
        p = math.prod(stirling(dishes[k], s.discount)[x] for k, x in zip(keys, t, strict=True))
        for room in {r for _, r in keys}:
            p *= rise(s.strength, s.discount, sum(x for k, x in zip(keys, t, strict=True) if k[1] == room))
        up = {w: sum(x for k, x in zip(keys, t, strict=True) if k[0] == w) for w in words}
        # the parent: its tables summed out
        inner = 0.0
        for t0 in itertools.product(*[range(1, up[w] + 1) for w in sorted(words)]):
            q = math.prod(stirling(up[w], s.parent_discount)[x] for w, x in zip(sorted(words), t0, strict=True))
            inner += q * rise(s.parent_strength, s.parent_discount, sum(t0)) * (1 / (len(words) + 1)) ** sum(t0)
        p *= inner / rise(s.parent_strength, 1, sum(t))
        total += p
        mean += p * np.array(t)
    return mean / total


@pytest.mark.parametrize("discount, strength", [(0.8, 2.0), (0.4, 0.5)])
def test_sampler_reaches_the_exact_small_model(discount, strength):
    """Rounds of sweeps with exchanged totals against all seatings of a small model."""
    s = hpy.Settings(discount=discount, strength=strength, contexts=3, samples=1, sweeps=3)
    dishes = {(0, 0): 4, (0, 1): 3, (1, 0): 2, (1, 2): 4, (2, 2): 1, (2, 0): 1}
    word, ctx = (np.array([k[i] for k in dishes]) for i in (0, 1))
    customers = np.array(list(dishes.values()))
    got = []
    for seed in range(1500):
        # two buckets, words 0 and 1 in one and word 2 in the other, which is not moved: its dishes have one customer
        own, apart = word < 2, np.bincount(ctx[word == 2], minlength=3).astype(float)
        others = hpy.Totals(apart, 3.0, 3.0, apart.sum())
        for r in range(3):
            end = hpy.sample(word[own], ctx[own], customers[own], np.ones(2, np.int64), others, s, 10 * seed + r, False)
            others = hpy.Totals(apart, 3.0, float(end.parent_tables[0].sum()) + 1.0, apart.sum())
        got.append(hpy.sample(word[own], ctx[own], customers[own], np.ones(2, np.int64), others, s, 10 * seed + 9, True).tables[0])
    want = exact_tables(dishes, s)
    assert want[4] == want[5] == 1 and np.abs(np.mean(got, axis=0) - want[:4]).max() < 0.06


@pytest.mark.parametrize("contexts", [1 << 16, 1 << 18])
def test_score_against_a_plain_model(spark, contexts):
    """With seatings that leave nothing to chance (one table a dish), every score is that of a plain dictionary model."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(70_000)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=400) + rng.choices(vocabulary[:30], k=100))) for i in range(400)]
    tiny = 1e-9
    s = hpy.Settings(contexts=contexts, discount=tiny, strength=tiny, parent_discount=tiny, parent_strength=tiny, unit_bytes=200_000, bucket_bytes=100_000)
    u64 = lambda h: hpy.mix(np.array([h], np.uint64))[0]                                     # noqa: E731
    room_of = {}

    def room(w):
        if w not in room_of:
            if w is None:
                h = hpy.START
            else:
                raw = np.frombuffer(w.encode(), np.uint8)
                h = hpy.hash_runs(raw, np.array([0]), np.array([len(raw)]))[0]
            room_of[w] = int(u64(h) % np.uint64(contexts))
        return room_of[w]

    pairs, rooms, types = Counter(), Counter(), defaultdict(set)
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            for a, b in zip([None, *t.split()], [*t.split(), ""], strict=True):
                pairs[room(a), b] += 1
                rooms[room(a)] += 1
                types[b].add(room(a))
    tables = sum(map(len, types.values()))
    assert len(rooms) > (40_000 if contexts > 1 << 16 else 30_000)
    for r in hpy.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), s).collect():
        words = rows[r.doc_id][1].split()
        want = 0.0
        for a, b in zip([None, *words], [*words, ""], strict=True):
            c, parent = rooms[room(a)], len(types[b]) / tables
            # without customers the restaurant passes everything up; an unknown word has next to nothing
            want += math.log10(pairs[room(a), b] / c if pairs[room(a), b] else (tiny / c if c else 1.0) * max(parent, tiny))
        if r.held_out:
            continue                                       # their unseen pairs rest on the tiny numbers alone
        assert abs(r.score - want) < 1e-3 * len(words)


@pytest.mark.parametrize("c", [5, 300, 1500])
@pytest.mark.parametrize("a", [0.05, 0.9, 40.0, 900.0])
def test_sweeps_reach_the_exact_posterior_of_large_dishes(c, a):
    """t tables have weight S(c, t) * a ** t, S by its recursion over customers."""
    rng = np.random.default_rng(4)
    n, d = 1000, 0.8
    log_s = np.array([0.0])
    for k in range(1, c):
        t = np.arange(1, k + 2)
        log_s = np.logaddexp(np.append(-np.inf, log_s), np.append(np.log(k - d * t[:-1]) + log_s, -np.inf))
    t = np.arange(1, c + 1)
    p = np.exp(log_s + t * math.log(a) - (log_s + t * math.log(a)).max())
    p /= p.sum()
    mean = (p * t).sum()
    sd = math.sqrt((p * (t - mean) ** 2).sum())
    got = hpy.draw_tables(np.full(n, c), np.full(n, a), d, rng)
    assert abs(got.mean() - mean) < 5 * sd / math.sqrt(n) + 1e-9
    assert 0.8 * sd < got.std() + 0.02 and got.std() < 1.2 * sd + 0.02


def test_rounds_count_all_words_and_tables(spark, documents, empty):
    """Totals between rounds: exact words, a table a dish at least and a customer at most, per restaurant."""
    for df in (documents, documents.limit(20), empty):
        for s in (hpy.Settings(), hpy.Settings(unit_bytes=60_000, bucket_bytes=40_000)):
            rows = [[*split_words((r.text or "").translate(LOWER)), None] for r in df.collect() if zlib.crc32(str(r.doc_id).encode()) % 10]
            pairs = {(a, b) for ws in rows for a, b in zip([""] + ws, ws)}
            size = sum(len(w or "") for ws in rows for w in ws)
            s = hpy.sized(s, size)
            units = hpy._units(df, s)
            plan = hpy._plan(units, size, s)
            shared = spark.sparkContext.broadcast(plan)
            first = hpy._round(hpy._ask(units, shared, s), None, shared, s, 0)
            totals = hpy._round(hpy._ask(units, shared, s), first, shared, s, 1).totals
            if not len(plan.split):
                assert totals.words == max(1, len({w for ws in rows for w in ws}))
            assert abs(totals.words - max(1, len({w for ws in rows for w in ws}))) < 3
            assert 0.98 * len(pairs) <= totals.tables.sum() and (totals.tables <= plan.c_context).all()       # contexts may share a restaurant
            assert ((totals.tables > 0) == (plan.c_context > 0)).all()


def test_model_is_normalised(spark, documents):
    """For any restaurant the weights of all words and the unknown class add up to 1."""
    s = hpy.Settings(contexts=64)
    units = hpy._units(documents, s)
    plan = hpy._plan(units, 10_000_000, s)
    sc = spark.sparkContext
    shared = sc.broadcast(plan)
    totals = hpy._round(hpy._ask(units, shared, s), None, shared, s, 0)
    answers = hpy.stored(hpy._answer(hpy._ask(units, shared, s), totals, shared, s), "t")
    m = hpy._model(answers, totals, plan, s)
    # the parent: words with customers, words without, the unknown class
    net = np.zeros(s.samples)
    for r in answers.filter("kind = 3").collect():
        t = np.frombuffer(hpy._unpack(r.blob), np.int64)
        net += t[2:2 + s.samples] - s.parent_discount * t[2 + s.samples:]
    if len(plan.split):
        split_t = np.zeros_like(net)
        for r in answers.filter("kind = 2").collect():
            raw = hpy._unpack(r.blob)
            split_t += np.frombuffer(raw, np.int64, -1, 16 * r.n_words).reshape(s.samples, r.n_words).sum(axis=1)
        net += m.split_net.sum(axis=1) - split_t
    assert np.allclose(net * m.scale + (m.vocabulary + 1) * m.floor, 1)
    # a restaurant: its dishes' own parts and the parent's weight
    own = np.zeros(s.contexts)
    tables = (m.gamma * (s.strength + plan.c_context) - s.strength) / s.discount
    own = (plan.c_context - s.discount * tables) / (s.strength + plan.c_context)
    assert np.allclose(own + m.gamma, 1, atol=1e-5) and (tables >= -1e-3 * plan.c_context - 1e-3).all() and (tables <= 1.001 * plan.c_context + 1e-3).all()


# ------------------------------------------------------------------ op6

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/a">Menu {k}</a><li><a>More</ul></nav><!-- <p>no</p> --><div class="ad box">Buy {k}</div>
<aside>Side</aside><{tag}><h1>Title {k} &amp; more</h1><p>First <b>bold</b>
 paragraph &eacute;&#233; {k}.<br>next line<p>Second &lt;tag&gt; {k}<div id="comments"><p>A reader {k}</div>
<form><p>Name</p><input></form><ul><li>point {k}</li></ul></{tag}><div class="cookie-notice">We use cookies</div><footer>&copy; x</footer></body></html>"""
WANT = "Title {k} & more\n\nFirst bold paragraph éé {k}. next line\n\nSecond <tag> {k}\n\npoint {k}"


def test_page_text(spark):
    rows = [(k, f"http://h{k % 2}.example/p{k}", PAGE.format(k=k, tag="article")) for k in range(30)]
    rows += [(100 + k, f"https://plain.example/{k}", PAGE.format(k=k, tag="div").replace("<footer>", "<p>Same line on every page</p><footer>"))
             for k in range(12)]
    rows += [(200, "http://h0.example/x", None), (201, None, ""), (202, "no url", "plain &amp; text"), (203, "http://one.example/", "<p>a<p>b</b></div>c"),
             (204, "http://one.example/2", "<div <p>x"), (0, "http://h0.example/p0", rows[0][2]), (205, "http://h1.example", "<article>" + "x " * 90000)]
    df = spark.createDataFrame([(*r, "extra", "n") for r in rows], "page_id long, url string, html string, text string, host string")
    got = defaultdict(list)
    for r in templates.main_text(df).collect():
        got[r.page_id].append(r)
        assert r.n_chars == len(r.text)
    assert sum(map(len, got.values())) == len(rows)
    for k in range(30):
        assert {r.text for r in got[k]} == {WANT.format(k=k)}
    for k in range(12):
        assert got[100 + k][0].text == WANT.format(k=k)          # no article element: found by the template
    assert got[200][0].text == got[201][0].text == "" and got[202][0].text == "plain & text"
    assert got[203][0].text == "a\n\nbc" and got[205][0].n_chars == 179999
    assert templates.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("before, after", [
    ('<body class="has-sidebar">', "</body>"), ('<body class="search search-results">', "</body>"), ('<main class="search-results">', "</main>"),
    ('<main id="form">', "</main>"), ('<div class="post-form">', "</div>"), ('<div class="widget"><div id="with-header">', "</div></div>")])
@pytest.mark.parametrize("article", ["<article>", '<article class="post comments-open">', '<article class="widget">', '<div class="story-share">'])
def test_names_around_the_article_say_nothing(before, after, article):
    tag = article[1:].split()[0].rstrip(">")
    source = [before + '<p class="sidebar">Side</p>' + article + f"<h1>Title {k}</h1>" + f"<p>Text {k}." * 20 + f'<div id="comments"><{tag} class="comment">'
              + "Reader. " * 90 + f'</{tag}></div><p class="share">Share</p></{tag}>' + after for k in range(9)]
    pages = [templates.parse(x) for x in source]
    for template in (None, templates.deduce(pages)):
        for k, p in enumerate(pages):
            assert templates.extract(p, template) == "\n\n".join([f"Title {k}"] + [f"Text {k}."] * 20)


def test_names_beside_the_article_count():
    page = templates.parse("<article>Post</article><div class='related-posts'><article>" + "Other " * 9 + "</article></div>"
                           "<div class='comments'><article class='comment'>" + "Reader " * 99 + "</article></div>")
    assert templates.extract(page, None) in ("Post", "Post\n\n" + " ".join(["Other"] * 9))
    page = templates.parse("<main><article>Post</article><article class='comment'>Reader reader</article></main>")
    assert templates.extract(page, None) == "Post"
    page = templates.parse("<p>Post without an article</p><div class='comments'><article class='comment'>Reader</article></div>")
    assert templates.extract(page, None) == "Post without an article"


def test_template_classes():
    pages = [templates.parse(PAGE.format(k=k, tag="article").replace("<li><a>More", "<li><a>More" * (k + 1))) for k in range(6)]
    t = templates.deduce(pages)
    assert t.element.endswith("/article") and t.skeleton.index(t.element) < t.skeleton.index("/" + t.element)
    repeated = [c for classes in t.nested.values() for c in classes]
    assert any(any(x.endswith("/nav/ul/li") for x in c) for c in repeated)      # the menu's records nest in one slot
    assert templates.deduce(pages[:1]) is None


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    import html as entities
    for r in templates.main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body))
        assert r.text == "\n\n".join(x for x in blocks if x)


# ------------------------------------------------------------------ op8

def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_archives_round_trip(spark, min_bytes, tmp_path):
    rows = [(k, f"http://h/{k} a", "same page" if k % 3 else f"page {k}\r\n\r\nWARC/1.0\r\nContent-Length: 9\r\n\r\n é") for k in range(40)]
    rows += [(50, None, None), (51, "", ""), (52, "http://x", None), (None, "http://n", "same page"), (3, "http://h/3 a", rows[3][2])]
    df = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, record_type string").repartition(2)
    typed = arc_convert.with_types(arc_convert.arc_records(arc_convert.arc_archives(df)), min_bytes)
    path = str(tmp_path / "warc")
    arc_convert.write_warc(typed, path, records_per_file=7)
    got = arc_convert.read_warc(spark, path).collect()
    latest = {}
    for i, _, h in rows:
        if i is not None:
            latest[h or ""] = max(latest.get(h or "", -1), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = i is not None and len(b) >= min_bytes and i < latest[h or ""]
        want.append((i is None, i or 0, len(b), digest(b), "revisit" if again else "response", latest[h or ""] if again else -1))
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type,
                   -1 if r.refers_to is None else r.refers_to) for r in got) == sorted(want)


def test_empty_archives(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    arc_convert.write_warc(arc_convert.with_types(arc_convert.arc_records(arc_convert.arc_archives(df))), str(tmp_path / "w"))
    assert arc_convert.read_warc(spark, str(tmp_path / "w")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_legacy_header_lines(version):
    records = [({"URL": f"http://h/{i} x", "Content-type": "text/html"}, b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n" + bytes(range(i, 200))) for i in range(5)]
    records.append(({"URL": "dns:h", "Content-type": "text/dns"}, b"20000101 h 1.2.3.4\n\n\n"))
    data = arc_convert.build_arc(version, "x.arc", "20010203", records)
    for raw in (data, __import__("gzip").compress(data), data.replace(b"dns:h", b"dns: h")):
        got_version, got = arc_convert.parse_arc(raw)
        assert got_version == version and [r.block for r in got] == [b for _, b in records]
        assert got[-1].fields["Content-type"] == "text/dns" and not got[-1].http
        assert got[0].payload == bytes(range(0, 200))
    assert arc_convert.warc_date("20010203") == "2001-02-03T00:00:00Z"
    assert arc_convert.warc_date("19991231235958") == "1999-12-31T23:59:58Z"
    with pytest.raises(ValueError, match="shorter"):
        arc_convert.parse_arc(data[:-8])


# ------------------------------------------------------------------ registry and pipeline

def test_registry():
    import __spark_entry__ as entry
    names = entry.queries()
    assert sorted(QUERIES) == sorted(k for k in names if re.match(r"op\d+_", k)) and len(QUERIES) == 13
    assert "pipeline" in names and set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    from harness import compare, duck
    ok, message = compare(QUERIES[name](spark, SF).toPandas(), duck(SF).execute(ORACLE[name]).df())
    assert ok, message


def test_pipeline(spark):
    import corpus_pipeline as p
    assert [n for n, _ in p.STAGES] == ["quality_rules", "near_duplicates", "substring_dedup", "decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for name, stage in p.STAGES[:-1]:
        out = p.stored(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        assert out.join(docs, "doc_id", "left_anti").count() == 0
        sizes.append((docs.count(), out.count()))
        docs = out
    assert sizes[0][1] < sizes[0][0] and sizes[1][1] < sizes[1][0] and sizes[2][0] == sizes[2][1] and sizes[3][1] <= sizes[3][0]
    final = p.run(spark, SF).collect()
    assert sorted(r.doc_id for r in final) == sorted(r.doc_id for r in docs.collect())
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == texts[r.doc_id] for r in final)


def test_pipeline_stages_on_odd_tables(spark, odd, empty):
    import corpus_pipeline as p
    for name, stage in p.STAGES:
        assert stage(spark, empty, SF).count() == 0
        out = stage(spark, odd, SF)
        if name != "sentencepiece":
            assert out.columns == odd.columns
        assert out.count() <= odd.count()
