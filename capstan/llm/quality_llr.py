"""Quality rules: base counts per document and a hashed n-gram log-likelihood ratio.

Two multinomials over ``2**bits`` buckets are counted: hashed byte n-grams of the
trusted target (documents labelled quality 1) and of the raw corpus (all
documents).  A document's score is the mean over its n-grams of
``log(p_target / p_raw)``, so it does not depend on length; it is kept when the
score reaches ``threshold`` and the base rules hold.  Both models are fixed-size
tables (``2**bits`` numbers), counted in Spark over all documents.

Defined cases: NULL and empty texts have no word and fail the base rule; their
score is 0.  Without any trusted document every score is 0 and only the base
rules decide.  Equal texts get equal results; input columns other than doc_id
and text are not read; NULL doc_ids pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import column, keep_rows
from capstan.llm.words import hash_runs, mix, ngram_hashes, runs, segment_sum, slices, words

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
NGRAM = 4                 # bytes
BITS = 16
THRESHOLD = -0.35         # mean natural-log ratio per n-gram
SMOOTHING = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray          # float32, log(p_target / p_raw) per bucket
    ngram: int = NGRAM
    bits: int = BITS
    threshold: float = THRESHOLD


def _buckets(data: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte n-gram inside one document, and the first n-gram of each document."""
    if n > 8:
        raise ValueError("byte n-grams of at most 8 bytes are packed into one integer")
    size = np.diff(offsets)
    count = np.maximum(size - n + 1, 0)
    first = np.concatenate([[0], np.cumsum(count)])
    m = len(data) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), first
    packed = np.zeros(m, np.uint64)
    for k in range(n):
        packed = (packed << np.uint64(8)) | data[k:k + m]
    bucket = (packed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
    inside = np.ones(m, bool)                     # drop n-grams that reach into the next document
    for k in range(1, n):
        at = offsets[1:-1] - k
        inside[at[(at >= 0) & (at < m)]] = False
    return bucket[inside], first


def ngram_counts(docs: DataFrame, n: int = NGRAM, bits: int = BITS) -> np.ndarray:
    """Bucket counts over every document: summed per task, then by Spark (``2**bits`` rows at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            for _, _, data, off in slices(b.column(0)):
                total += np.bincount(_buckets(data, off, n, bits)[0], minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    summed = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << bits, np.float64)
    for r in summed.collect():                    # bounded by the number of buckets
        out[r["bucket"]] = r["n"]
    return out


def fit(docs: DataFrame, labels: DataFrame, n: int = NGRAM, bits: int = BITS, threshold: float = THRESHOLD) -> Model:
    """Count both multinomials; trusted are the documents with a row of quality 1 in ``labels``."""
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("_trusted")).distinct()
    # one plan at every size of the label table: a broadcast would turn into this shuffle as labels grow
    trusted = docs.select("doc_id", "text").join(good.hint("merge"), F.col("doc_id") == F.col("_trusted"), "left_semi")
    raw, target = ngram_counts(docs, n, bits), ngram_counts(trusted, n, bits)
    if not target.sum():
        return Model(np.zeros(1 << bits, np.float32), n, bits, threshold)
    # the target is smoothed towards the raw multinomial, which has mass wherever a document can look
    p_raw = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * len(raw))
    strength = SMOOTHING * len(raw)
    p_target = (target + strength * p_raw) / (target.sum() + strength)
    return Model(np.log(p_target / p_raw).astype(np.float32), n, bits, threshold)


def repeated_words(h: np.ndarray, first: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Words per document covered by a window of words that occurs twice or more in it."""
    n_docs = len(first) - 1
    gram, at, gfirst = ngram_hashes(h, first, window)
    if not len(gram):
        return np.zeros(n_docs, np.int64)
    doc = np.repeat(np.arange(n_docs), np.diff(gfirst))
    key = mix(gram ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(key), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(h) + 1, np.int64)
    hit = at[order[twice]]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return segment_sum(np.cumsum(edge[:-1]) > 0, first)


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    starts, ends, first = words(data, offsets)
    n_docs = len(offsets) - 1
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])     # code points before each byte
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    lstart, lend, lfirst = runs(data != 10, offsets)
    worded = np.searchsorted(starts, lend) > np.searchsorted(starts, lstart)
    doc = np.repeat(np.arange(n_docs), np.diff(lfirst))[worded]
    key = mix(hash_runs(data, lstart[worded], lend[worded]) ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    _, once = np.unique(key, return_index=True)
    return {
        "n_words": np.diff(first),
        "word_chars": segment_sum(leads[ends] - leads[starts], first),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.bincount(doc, minlength=n_docs) - np.bincount(doc[once], minlength=n_docs),
        "n_repeat_words": repeated_words(hash_runs(data, starts, ends), first),
    }


def judge(text: pa.Array, model: Model) -> dict[str, np.ndarray]:
    """All result columns for a column of texts."""
    parts: dict[str, list] = {}
    for _, _, data, off in slices(text):
        got = base_counts(data, off)
        bucket, first = _buckets(data, off, model.ngram, model.bits)
        count = np.diff(first)
        got["llr"] = segment_sum(model.weights[bucket].astype(np.float64), first) / np.maximum(count, 1)
        got["base_failed"] = (got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > REPEAT_PERCENT * got["n_words"])
        got["kept"] = ~got["base_failed"] & (got["llr"] >= model.threshold)
        for k, v in got.items():
            parts.setdefault(k, []).append(v)
    return {k: np.concatenate(v) for k, v in parts.items()}


RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, llr double")
_ORDER = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"]


def quality_rules(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: counts, ``llr`` and the verdict ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                got = judge(b.column(1), model)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).cast(pa.int64()), *[pa.array(got[k]) for k in _ORDER]], ["doc_id", *_ORDER])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def quality_filter(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are kept, every column unchanged."""
    return keep_rows(docs, lambda b: judge(column(b, "text"), model)["kept"] if b.num_rows else np.zeros(0, bool))
