"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

A document is contaminated by an item when some run of its words (A-Z
lower-cased) is within ``floor(max_edits * n)`` word edits (insertions, deletions,
substitutions) of the item's n words.

* CGK walk: a pointer starts at a window's first word; step j outputs the word
  under the pointer and advances when a random bit of (j, word) is set.  Few edits
  become few differing steps, so edit distance turns into Hamming distance.
* Bit sampling: ``samples`` steps of the output make one key; ``walks * draws`` keys
  per window.  Windows have the item's size class; every window sharing a key
  with an item is a candidate.
* Verification: the exact semi-global edit distance decides.

Items longer than about ``segment`` words are windowed part by part (the walks of a
long window drift apart after many edits, and one of the parts always has its
share of the edits at most); verification is over the whole item.  Only windows
around which enough of an item's word groups occur are walked.  That loses
nothing: within k edits, n words keep n - q + 1 - k * q of their q-word groups.
Items are read in blocks of bounded size; a pass over the documents cuts them into words
once and searches several blocks.  There is no shuffle.

Items of fewer than ``min_words`` words allow one edit at most: those without are
looked up as a whole, the others by their halves, one of which is untouched by the
edit, and verified like the rest.  This finds every match.

Defined cases: items of fewer than ``shortest`` words, and items without a word, are
not searched; NULL and empty texts are clean; items with equal texts are
reported each; a repeated row is reported once per row; rows without doc_id are
reported with NULL.  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import column, keep_rows
from capstan.llm.words import LOWER, hash_runs, mix, slices, words

_PAD = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class Settings:
    max_edits: float = 0.2        # of an item's words
    min_words: int = 8            # items of fewer words are looked up by exact word groups
    shortest: int = 1             # least words of an item; 1: all that have a word
    walks: int = 8
    draws: int = 6                # samplings per walk
    samples: int = 4              # steps in one sampling
    segment: int = 16             # longer items are windowed by parts of about this many words
    group: int = 3                # words in the groups that a window must share
    block_bytes: int = 4 << 20    # item text of an index
    blocks: int = 4               # indexes that a pass over the documents holds


@dataclass
class _Item:
    item_id: int | None
    h: np.ndarray
    k: int


@dataclass
class _Class:
    """Segments of one size class: the walk sees their first ``length`` words."""
    length: int
    reach: int                   # words that a segment can span in a document
    least: int                   # groups that it keeps within its share of edits
    grams: np.ndarray            # groups of its items, sorted
    item: np.ndarray
    offset: np.ndarray
    keys: list[list[tuple[np.ndarray, np.ndarray]]]     # per walk and draw: sorted keys, their segments


@dataclass
class _Short:
    """Word groups of one length of the items below ``min_words``."""
    length: int
    whole: bool                  # a group is the item, which allows no edit
    keys: np.ndarray             # sorted
    item: np.ndarray
    offset: np.ndarray


@dataclass
class Index:
    items: list[_Item]
    classes: list[_Class]
    short: list[_Short]
    settings: Settings


def _steps(length: int, walk: int, s: Settings) -> np.ndarray:
    """Sampled steps of each draw of a walk, in the first two steps per word."""
    rng = np.random.default_rng([length, walk])
    return np.stack([rng.choice(2 * length, s.samples, replace=False) for _ in range(s.draws)])


def _walk(h: np.ndarray, start: np.ndarray, stop: np.ndarray, length: int, walk: int, s: Settings) -> np.ndarray:
    """Keys (draws, starts) of the windows of ``length`` words at ``start``; words from ``stop`` on are padding."""
    steps = _steps(length, walk, s)
    at = start.copy()
    end = np.minimum(start + length, stop)
    keys = np.full((s.draws, len(start)), np.uint64(walk + 1))
    last = int(steps.max())
    padded = np.append(h, _PAD)
    for j in range(last + 1):
        word = padded[np.where(at < end, at, len(h))]
        for d in np.flatnonzero((steps == j).any(axis=1)):
            # order of the sampled steps is increasing j for both sides
            keys[d] = mix(keys[d] + word)
        if j < last:
            seed = np.uint64((walk << 32 | j) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            at = at + (mix(word ^ seed) & np.uint64(1)).astype(np.int64)
    return keys


def _hashes(text: str | None) -> np.ndarray:
    col = pa.array([text or ""])
    for _, _, data, off in slices(col):
        data = LOWER[data]
        starts, ends, _ = words(data, off)
        return hash_runs(data, starts, ends)
    return np.zeros(0, np.uint64)


def _group(h: np.ndarray, n: int) -> np.ndarray:
    m = max(len(h) - n + 1, 0)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(3) + h[k:k + m])
    return out


def build_index(rows: list[tuple[int | None, str | None]], s: Settings) -> Index | None:
    """Index of the items ``(item_id, text)``."""
    items = []
    for item_id, text in rows:
        h = _hashes(text)
        if len(h) >= max(1, s.shortest):
            items.append(_Item(item_id, h, int(s.max_edits * len(h))))
    if not items:
        return None
    segs: dict[int, list[tuple[int, int, int]]] = {}
    groups: dict[tuple[int, bool], list[tuple[np.uint64, int, int]]] = {}
    for i, it in enumerate(items):
        n = len(it.h)
        if n < s.min_words and it.k <= 1:
            cuts = [n * p // (it.k + 1) for p in range(it.k + 2)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                groups.setdefault((b - a, it.k == 0), []).append((_group(it.h[a:b], b - a)[0], i, a))
            continue
        parts = max(1, round(n / s.segment))
        cuts = [n * p // parts for p in range(parts + 1)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            size = b - a
            length = s.min_words // 2
            while length * 3 // 2 <= size:                # size classes in steps of one and a half
                length = length * 3 // 2
            segs.setdefault(min(length, size), []).append((i, a, size))
    classes = []
    for length, members in sorted(segs.items()):
        flat = np.concatenate([items[i].h[a:a + length] for i, a, _ in members])
        start = np.arange(len(members), dtype=np.int64) * length
        keys = []
        for w in range(s.walks):
            own = []
            for row in _walk(flat, start, start + length, length, w, s):
                order = np.argsort(row, kind="stable")
                own.append((row[order], order))
            keys.append(own)
        # not every part of n words can have more than k * n / whole of an item's k edits
        k = [items[i].k * n // len(items[i].h) for i, _, n in members]
        sizes = [n for _, _, n in members]
        grams = np.unique(np.concatenate([_group(items[i].h[a:a + n], s.group) for i, a, n in members]))
        classes.append(_Class(length, max(n + e for n, e in zip(sizes, k)),
                              min(n - s.group + 1 - e * s.group for n, e in zip(sizes, k)), grams,
                              np.array([i for i, _, _ in members]), np.array([a for _, a, _ in members]), keys))
    short = []
    for (length, whole), members in sorted(groups.items()):
        key, item, offset = (np.array(x) for x in zip(*members))
        order = np.argsort(key, kind="stable")
        short.append(_Short(length, whole, key[order], item[order], offset[order]))
    return Index(items, classes, short, s)


def _short_matches(h: np.ndarray, doc: np.ndarray, c: _Short) -> tuple[np.ndarray, np.ndarray]:
    """(words where a group of an item is, which group); a whole item is given once per document."""
    g = _group(h, c.length)
    left = np.searchsorted(c.keys, g, "left")
    at = np.flatnonzero((left < len(c.keys)) & (c.keys[np.minimum(left, len(c.keys) - 1)] == g))
    at = at[doc[at] == doc[at + c.length - 1]]
    if c.whole:
        at = at[np.unique(doc[at] * len(c.keys) + left[at], return_index=True)[1]]
    n = np.searchsorted(c.keys, g[at], "right") - left[at]
    edge = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(at, n), np.arange(int(edge[-1])) + np.repeat(left[at] - edge[:-1], n)


def _active(h: np.ndarray, doc: np.ndarray, g: np.ndarray, c: _Class, q: int) -> np.ndarray:
    """Words where a window of the class can start: enough groups of its items follow."""
    if c.least <= 0:
        return np.arange(len(h))
    seen = np.zeros(1 << 20, bool)
    seen[c.grams >> np.uint64(44)] = True
    hit = np.flatnonzero(seen[g >> np.uint64(44)])
    hit = hit[np.isin(g[hit], c.grams)]
    hit = hit[doc[hit] == doc[hit + q - 1]]
    mark = np.zeros(len(h) + 1, np.int64)
    mark[hit + 1] = 1
    before = np.cumsum(mark)                              # hits before each word
    n = before[np.minimum(np.arange(len(h)) + c.reach, len(h))] - before[:-1]
    # starts within the edits of a window with enough groups (its own start may be shifted)
    return np.flatnonzero(n >= c.least)


def _distances(text: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between ``item`` and any run of each row of ``text`` (rows, words), and where that run ends."""
    rows, width = text.shape
    step = np.arange(width + 1, dtype=np.int32)
    line = np.zeros((rows, width + 1), np.int32)
    for i, word in enumerate(item):
        new = np.empty_like(line)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(line[:, 1:] + 1, line[:, :-1] + (text != word))
        line = np.minimum.accumulate(new - step, axis=1) + step
    end = line.argmin(axis=1)
    return line[np.arange(rows), end], end


@dataclass
class _Slice:
    """Documents cut into words, once for all indexes of a pass."""
    h: np.ndarray                # word hashes
    first: np.ndarray            # first word of each document
    doc: np.ndarray              # document of each word
    g: np.ndarray                # word groups


def _cut(data: np.ndarray, offsets: np.ndarray, s: Settings) -> _Slice:
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    h = hash_runs(data, starts, ends)
    return _Slice(h, first, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), _group(h, s.group))


def _matches(part: _Slice, ix: Index) -> tuple[np.ndarray, ...]:
    """(document, item, edits, end word) of every contaminated (document, item) of a slice."""
    s = ix.settings
    h, first, doc, g = part.h, part.first, part.doc, part.g
    none = (np.zeros(0, np.int64),) * 4
    if not len(h):
        return none
    found = [np.zeros((0, 3), np.int64)]
    for c in ix.short:
        at, k = _short_matches(h, doc, c)
        found.append(np.stack([c.item[k], at - c.offset[k], doc[at]], axis=1))
    for c in ix.classes:
        active = _active(h, doc, g, c, s.group)
        if not len(active):
            continue
        stop = first[doc[active] + 1]
        for w in range(s.walks):
            for row, (keys, segment) in zip(_walk(h, active, stop, c.length, w, s), c.keys[w]):
                left = np.searchsorted(keys, row, "left")
                at = np.flatnonzero((left < len(keys)) & (keys[np.minimum(left, len(keys) - 1)] == row))
                n = np.searchsorted(keys, row[at], "right") - left[at]
                edge_n = np.concatenate([[0], np.cumsum(n)])
                seg = segment[np.arange(int(edge_n[-1])) + np.repeat(left[at] - edge_n[:-1], n)]
                found.append(np.stack([c.item[seg], np.repeat(active[at], n) - c.offset[seg], doc[np.repeat(active[at], n)]], axis=1))
    cand = np.concatenate(found)
    if not len(cand):
        return none
    k = np.array([it.k for it in ix.items])[cand[:, 0]]
    cand[:, 1] -= cand[:, 1] % (k + 1)                    # one check for neighbouring starts
    cand = np.unique(cand, axis=0)
    out = []
    for i in np.unique(cand[:, 0]):
        it = ix.items[i]
        own = cand[cand[:, 0] == i]
        width = len(it.h) + 4 * it.k + 1
        per = max(1, (1 << 22) // width)
        for p in range(0, len(own), per):
            d = own[p:p + per, 2]
            at = own[p:p + per, 1][:, None] - it.k + np.arange(width)
            inside = (at >= first[d][:, None]) & (at < first[d + 1][:, None])
            text = np.where(inside, h[np.clip(at, 0, len(h) - 1)], _PAD)
            edits, end = _distances(text, it.h)
            ok = edits <= it.k
            out.append(np.stack([d[ok], np.full(ok.sum(), i), edits[ok], (at[:, 0] + end)[ok] - first[d[ok]]], axis=1))
    if not out:
        return none
    m = np.concatenate(out)
    m = m[np.lexsort((m[:, 3], m[:, 2], m[:, 1], m[:, 0]))]
    new = np.ones(len(m), bool)
    new[1:] = (m[1:, :2] != m[:-1, :2]).any(axis=1)
    return tuple(m[new].T)


def _blocks(benchmark: DataFrame, s: Settings) -> Iterator[Index]:
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // s.block_bytes) + 1
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        index = build_index([(r[0], r[1]) for r in part.collect()], s)        # about block_bytes at a time
        if index:
            yield index


def _passes(benchmark: DataFrame, s: Settings) -> Iterator[list[Index]]:
    """The indexes, some at a time: what one pass over the documents searches."""
    held: list[Index] = []
    for index in _blocks(benchmark, s):
        held.append(index)
        if len(held) == s.blocks:
            yield held
            held = []
    if held:
        yield held


RESULT = "doc_id long, item_id long, edits long, end_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, edits, end_word): every document and item that it holds."""
    spark = docs.sparkSession
    source = docs.select("doc_id", "text")
    out = spark.createDataFrame([], RESULT)
    for indexes in _passes(benchmark, settings):
        shared = spark.sparkContext.broadcast(indexes)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column(0).cast(pa.int64())
                for lo, hi, data, off in slices(b.column(1)):
                    part = _cut(data, off, settings)
                    for ix in shared.value:
                        d, i, edits, end = _matches(part, ix)
                        found = [ix.items[k].item_id for k in i.tolist()]
                        yield pa.RecordBatch.from_arrays(
                            [ids.slice(lo, hi - lo).take(pa.array(d, pa.int64())), pa.array(found, pa.int64()), pa.array(edits), pa.array(end)],
                            ["doc_id", "item_id", "edits", "end_word"])

        out = out.unionByName(source.mapInArrow(run, RESULT))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that hold no item, every column unchanged."""
    for indexes in _passes(benchmark, settings):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def clean(batch: pa.RecordBatch, shared=shared) -> np.ndarray:
            ok = np.ones(batch.num_rows, bool)
            for lo, _, data, off in slices(column(batch, "text")):
                part = _cut(data, off, settings)
                for ix in shared.value:
                    ok[lo + _matches(part, ix)[0]] = False
            return ok

        docs = keep_rows(docs, clean)
    return docs
