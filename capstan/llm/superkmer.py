"""Substring deduplication by super-k-mer partitioning.

A window is ``window`` consecutive words.  A word is removed when a window that
covers it also starts in a document with a smaller doc_id; windows are judged
on the input.

1. Within a slice of documents, a window repeated in several documents is
   settled on the spot: all but its smallest doc_id lose it, and only that one
   travels.  A passage that a third of all documents share thus sends one row
   per slice.
2. Every remaining window has a minimiser, the smallest hash of the
   ``minimiser``-word groups in it.  Consecutive windows with one minimiser are
   packed as one string of words (a super-k-mer) and sent to that minimiser's
   bucket, so words shared by neighbouring windows travel once.
3. A bucket sorts its windows, compares equal hashes byte for byte, and answers
   with the word ranges of windows whose smallest document is another one.
   Buckets are sized from a counting pass; an overfull one (a frequent
   minimiser) is split by window hash, so no task holds an unbounded group.
4. The ranges of a document join its text once.

Defined cases: NULL and empty texts have no word (digest of the empty text);
texts shorter than a window lose nothing; rows without doc_id take no part and
keep all words; repeated rows of one doc_id never remove each other's words,
and each keeps its own text.  Columns other than doc_id and text pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.words import hash_runs, mix, slices, words


@dataclass(frozen=True)
class Settings:
    window: int = 13
    minimiser: int = 3
    slice_bytes: int = 8 << 20       # documents looked at together in a task
    bucket_bytes: int = 16 << 20     # packed words that a bucket should hold
    overfull: int = 4                # a bucket beyond so many times that is split


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (the last n - 1 and those across documents are meaningless)."""
    m = max(len(h) - n + 1, 0)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + h[k:k + m]
        out ^= out >> np.uint64(29)
    return mix(out)


def _sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    size, have = a, 1
    while have * 2 <= n:
        size = np.minimum(size[:-have], size[have:]) if len(size) > have else size[:0]
        have *= 2
    rest = n - have
    return np.minimum(size[:-rest], size[rest:]) if rest and len(size) > rest else (size[:0] if rest else size)


def _merge_runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive window starts of one document as (document, first start, last start)."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(doc)]]) - 1 if len(at) else at
    return doc[at], start[at], start[last]


@dataclass
class _Slice:
    """Windows of one slice: what is settled here, and the super-k-mers that travel."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    gone_doc: np.ndarray
    gone_lo: np.ndarray
    gone_hi: np.ndarray
    run_doc: np.ndarray
    run_word: np.ndarray         # first word (in the slice)
    run_windows: np.ndarray
    run_bucket: np.ndarray


def _cut(data, offsets, ids: np.ndarray, has_id: np.ndarray, s: Settings, buckets: int, split: dict[int, int]) -> _Slice:
    starts, ends, first = words(data, offsets)
    h = hash_runs(data, starts, ends)
    k = s.window
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    n = max(len(h) - k + 1, 0)
    at = np.flatnonzero((doc[:n] == doc[k - 1:k - 1 + n]) & has_id[doc[:n]]) if n else np.zeros(0, np.int64)
    w = _grams(h, k)[at] if n else np.zeros(0, np.uint64)
    owner = ids[doc[at]]
    order = np.argsort(w)
    ordered = w[order]
    new = np.ones(len(w), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.flatnonzero(new)
    gone = np.zeros(len(w), bool)
    if len(group):
        least = np.repeat(np.minimum.reduceat(owner[order], group), np.diff(np.concatenate([group, [len(w)]])))
        gone[order] = owner[order] > least
    gd, glo, ghi = _merge_runs(doc[at[gone]], at[gone] - first[doc[at[gone]]])
    at, w = at[~gone], w[~gone]
    low = _sliding_min(_grams(h, s.minimiser), k - s.minimiser + 1)
    low = low[at] if len(at) else np.zeros(0, np.uint64)
    bucket = (mix(low) % np.uint64(buckets)).astype(np.int64)
    cut = np.ones(len(at), bool)
    cut[1:] = (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]]) | (low[1:] != low[:-1])
    if split:
        full = np.isin(bucket, np.fromiter(split, np.int64))
        parts = np.array([split[b] for b in bucket[full].tolist()], np.uint64)
        # windows of an overfull bucket travel one by one, to a part of it given by their own hash
        bucket[full] = buckets * (1 + (mix(w[full]) % parts).astype(np.int64)) + bucket[full]
        cut |= full
        cut[1:] |= full[:-1]
    run = np.flatnonzero(cut)
    size = np.diff(np.concatenate([run, [len(at)]]))
    return _Slice(data, starts, ends, first, gd, glo, ghi, doc[at[run]], at[run], size, bucket[run])


def _documents(batch: pa.RecordBatch, s: Settings) -> Iterator[tuple]:
    ids = batch.column(0).cast(pa.int64())
    has = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy()
    marks = batch.column(2).to_numpy()
    for lo, hi, data, off in slices(batch.column(1), s.slice_bytes):
        yield ids[lo:hi], has[lo:hi], marks[lo:hi], data, off


def _bucket_sizes(docs: DataFrame, s: Settings, buckets: int) -> dict[int, int]:
    """Overfull buckets -> number of parts, from a counting pass over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, has, _, data, off in _documents(b, s):
                c = _cut(data, off, ids, has, s, buckets, {})
                size = c.ends[c.run_word + c.run_windows + s.window - 2] - c.starts[c.run_word] if len(c.run_word) else c.run_word
                total = np.bincount(c.run_bucket, weights=size, minlength=1) if len(size) else np.zeros(1)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at].astype(np.int64))], ["bucket", "n"])

    sizes = docs.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    full = sizes.filter(F.col("n") > s.overfull * s.bucket_bytes).collect()      # fewer than buckets / overfull
    # single windows carry all their words: about window / 3 times the bytes of a super-k-mer
    return {r["bucket"]: int(r["n"] * s.window // (3 * s.bucket_bytes)) + 1 for r in full}


def _pack(*arrays: np.ndarray) -> tuple[bytes, int]:
    raw = b"".join(a.tobytes() for a in arrays)
    return pa.Codec("zstd", compression_level=4).compress(raw, asbytes=True), len(raw)


def _super_kmers(table: pa.Table) -> tuple[np.ndarray, ...]:
    """All super-k-mers of a bucket: (doc_id, text mark, first word, bytes) of each, and the text of all."""
    ids, marks, begin, length, text = [], [], [], [], []
    for blob, raw, n in zip(table["blob"], table["raw"].to_pylist(), table["n"].to_pylist()):
        buf = pa.decompress(blob.as_buffer(), raw, codec="zstd", asbytes=True)
        ids.append(np.frombuffer(buf, np.int64, n))
        marks.append(np.frombuffer(buf, np.int64, n, 8 * n))
        begin.append(np.frombuffer(buf, np.int32, n, 16 * n))
        length.append(np.frombuffer(buf, np.int32, n, 20 * n))
        text.append(np.frombuffer(buf, np.uint8, raw - 24 * n, 24 * n))
    return (np.concatenate(ids), np.concatenate(marks), np.concatenate(begin).astype(np.int64),
            np.concatenate(length).astype(np.int64), np.concatenate(text))


def _differs(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, block: int = 1 << 14) -> np.ndarray:
    """Whether the spans of ``size`` bytes at a and at b differ, byte for byte."""
    out = np.zeros(len(a), bool)
    for lo in range(0, len(a), block):
        n = size[lo:lo + block]
        edge = np.concatenate([[0], np.cumsum(n)])
        step = np.arange(int(edge[-1])) - np.repeat(edge[:-1], n)
        bad = text[np.repeat(a[lo:lo + block], n) + step] != text[np.repeat(b[lo:lo + block], n) + step]
        out[lo:lo + block] = np.add.reduceat(bad, edge[:-1]) > 0
    return out


def _settle(table: pa.Table, k: int) -> tuple[np.ndarray, ...]:
    """(doc_id, text mark, first start, last start) of the windows that a smaller document also has."""
    ids, marks, begin, length, text = _super_kmers(table)
    offsets = np.concatenate([[0], np.cumsum(length)])
    starts, ends, first = words(text, offsets)
    h = hash_runs(text, starts, ends)
    piece = np.repeat(np.arange(len(ids)), np.diff(first))
    n = max(len(h) - k + 1, 0)
    at = np.flatnonzero(piece[:n] == piece[k - 1:k - 1 + n])
    w = _grams(h, k)[at]
    order = np.argsort(w)
    ordered = w[order]
    same = ordered[1:] == ordered[:-1]
    dup = np.zeros(len(w), bool)
    dup[1:] |= same
    dup[:-1] |= same
    order = order[dup]                                   # windows whose hash occurs twice or more
    at = at[order]
    key = w[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    group = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    a, b = starts[at], starts[at[head]][group] if len(at) else starts[at]
    size = ends[at + k - 1] - a
    size_head = size[head][group] if len(at) else size
    unequal = size != size_head
    check = np.flatnonzero(~unequal)
    unequal[check] = _differs(text, a[check], b[check], size[check])
    if unequal.any():                                    # equal hashes of different words: regroup by the words
        names: dict[tuple, int] = {}
        group = np.array([names.setdefault((int(g), text[p:p + z].tobytes()), len(names))
                          for g, p, z in zip(group, a, size)], np.int64)
        back = np.argsort(group, kind="stable")
        at, group = at[back], group[back]
    owner = ids[piece[at]]
    if not len(at):
        return owner, owner, owner, owner
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(owner, edge), np.diff(np.concatenate([edge, [len(at)]])))
    at = at[owner > least]
    p = piece[at]
    start = begin[p] + at - first[p]
    # runs are merged per (document, text)
    _, doc = np.unique(np.stack([ids[p], marks[p]], axis=1), axis=0, return_inverse=True)
    doc = doc.ravel()
    rep = np.zeros(int(doc.max()) + 1 if len(doc) else 0, np.int64)
    rep[doc] = p
    d, lo, hi = _merge_runs(doc, start)
    return ids[rep[d]], marks[rep[d]], lo, hi


def removed_ranges(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, mark, lo, hi): windows starting at words lo..hi of the text with that mark are covered."""
    k = s.window
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, int(3.2 * total / s.bucket_bytes) + 1)
    split = _bucket_sizes(docs, s, buckets)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, has, marks, data, off in _documents(batch, s):
                c = _cut(data, off, ids, has, s, buckets, split)
                rows = []
                if len(c.gone_doc):                      # settled here: handed through
                    blob, raw = _pack(ids[c.gone_doc], marks[c.gone_doc], c.gone_lo.astype(np.int32), c.gone_hi.astype(np.int32))
                    rows.append((-1 - int(ids[c.gone_doc[0]] % buckets), len(c.gone_doc), raw, blob))
                order = np.argsort(c.run_bucket, kind="stable")
                ordered = c.run_bucket[order]
                edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else []
                for p, q in zip(edge, [*edge[1:], len(ordered)]):
                    r = order[p:q]
                    n_words = c.run_windows[r] + k - 1
                    we = np.concatenate([[0], np.cumsum(n_words)])
                    word = np.arange(int(we[-1])) + np.repeat(c.run_word[r] - we[:-1], n_words)
                    # every word with one separator byte after it
                    length = c.ends[word] - c.starts[word] + 1
                    edge_b = np.concatenate([[0], np.cumsum(length)])
                    index = np.arange(int(edge_b[-1])) + np.repeat(c.starts[word] - edge_b[:-1], length)
                    text = c.data[np.minimum(index, len(c.data) - 1)]
                    text[edge_b[1:] - 1] = 32
                    d = c.run_doc[r]
                    blob, raw = _pack(ids[d], marks[d], (c.run_word[r] - c.first[d]).astype(np.int32),
                                      (edge_b[we[1:]] - edge_b[we[:-1]]).astype(np.int32), text)
                    rows.append((int(ordered[p]), len(r), raw, blob))
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                         pa.array(cols[3], pa.binary())], ["bucket", "n", "raw", "blob"])

    def answer(table: pa.Table) -> pa.Table:
        if table["bucket"][0].as_py() < 0:
            parts = []
            for blob, raw, n in zip(table["blob"], table["raw"].to_pylist(), table["n"].to_pylist()):
                buf = pa.decompress(blob.as_buffer(), raw, codec="zstd", asbytes=True)
                parts.append((np.frombuffer(buf, np.int64, n), np.frombuffer(buf, np.int64, n, 8 * n),
                              np.frombuffer(buf, np.int32, n, 16 * n).astype(np.int64),
                              np.frombuffer(buf, np.int32, n, 20 * n).astype(np.int64)))
            cols = [np.concatenate(x) for x in zip(*parts)]
        else:
            cols = _settle(table, k)
        return pa.table([pa.array(x) for x in cols], ["doc_id", "mark", "lo", "hi"])

    packed = docs.mapInArrow(send, "bucket long, n long, raw long, blob binary")
    return packed.groupBy("bucket").applyInArrow(answer, "doc_id long, mark long, lo long, hi long")


def _kept(text: pa.Array, lo: pa.Array, hi: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, np.ndarray]]:
    """Per slice: (words, removed words, kept words joined by one space, offsets)."""
    first_range = np.concatenate([[0], np.cumsum(lo.value_lengths().fill_null(0).to_numpy())])
    lows, highs = lo.flatten().to_numpy(), hi.flatten().to_numpy()
    for a, b, data, off in slices(text):
        starts, ends, first = words(data, off)
        r = slice(int(first_range[a]), int(first_range[b]))
        base = np.repeat(first[:-1], np.diff(first_range[a:b + 1]))
        edge = np.zeros(len(starts) + 1, np.int64)
        np.add.at(edge, base + lows[r], 1)
        np.add.at(edge, base + highs[r] + k, -1)
        keep = np.cumsum(edge[:-1]) == 0
        doc = np.repeat(np.arange(b - a), np.diff(first))
        n_words = np.diff(first)
        n_kept = np.bincount(doc[keep], minlength=b - a)
        ws, we = starts[keep], ends[keep]
        length = we - ws + 1
        edge_b = np.concatenate([[0], np.cumsum(length)])
        index = np.arange(int(edge_b[-1])) + np.repeat(ws - edge_b[:-1], length)
        out = data[np.minimum(index, max(len(data) - 1, 0))] if len(data) else data
        out[edge_b[1:] - 1] = 32
        last = np.cumsum(n_kept)                        # the separator after a document's last word goes
        at = edge_b[last[n_kept > 0]] - 1
        solid = np.ones(len(out), bool)
        solid[at] = False
        offsets = np.concatenate([[0], edge_b[last]])
        offsets = offsets - np.searchsorted(at, offsets)
        yield n_words, n_words - n_kept, out[solid].tobytes(), offsets


def _with_ranges(docs: DataFrame, s: Settings) -> DataFrame:
    # copies of a row have the same ranges: each range is kept once
    ranges = (removed_ranges(docs, s).groupBy("doc_id", "mark")
              .agg(F.collect_set(F.struct("lo", "hi")).alias("r"))
              .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"),
                      F.col("r.lo").alias("_lo"), F.col("r.hi").alias("_hi")))
    return docs.join(ranges, (docs["doc_id"] == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_mark")), "left").drop("_id", "_mark")


def substring_digests(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    k = settings.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = 0
            ids = b.column(0).cast(pa.int64())
            for n_words, n_removed, text, off in _kept(b.column(1), b.column(2), b.column(3), k):
                sha = [hashlib.sha256(text[p:q]).hexdigest() for p, q in zip(off[:-1].tolist(), off[1:].tolist())]
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(sha)), pa.array(n_words), pa.array(n_removed), pa.array(sha)],
                                                 ["doc_id", "n_words", "n_removed", "kept_sha256"])
                row += len(sha)

    return (_with_ranges(docs.select("doc_id", "text"), settings).select("doc_id", "text", "_lo", "_hi")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def remove_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (kept words joined by one space).

    Texts that lose nothing, and all other columns, stay as they are; a column
    integer column ``n_chars`` is set to the new length where the text changed.
    """
    k = settings.window
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [n.lower() for n in b.schema.names]
            at = names.index("text")
            texts = b.column(at).to_pylist()
            sizes = names.index("n_chars") if "n_chars" in names else None
            lengths = b.column(sizes).to_pylist() if sizes is not None else []
            row = 0
            for _, n_removed, text, off in _kept(b.column(at), b.column(b.num_columns - 2), b.column(b.num_columns - 1), k):
                for i in np.flatnonzero(n_removed).tolist():
                    texts[row + i] = text[off[i]:off[i + 1]].decode()
                    if sizes is not None:
                        lengths[row + i] = len(texts[row + i])
                row += len(n_removed)
            cols = b.columns[:-2]
            cols[at] = pa.array(texts, pa.string())
            if sizes is not None:
                cols[sizes] = pa.array(lengths, cols[sizes].type)
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    joined = _with_ranges(docs, settings)
    return joined.mapInArrow(run, schema)
