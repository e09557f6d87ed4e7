"""Ranked lexical search over a length-stratified index.

A document's score for an item is the sum, over the item's terms (repeats included), of
``w * ((10**9 * tf) div (1000 * tf + 12 * m))`` with the term weight ``w`` from the number
of documents that hold it, and the length normaliser ``m`` from the document's number of
terms.  Documents of equal ``m`` form a stratum; inside a stratum the part of the score
that follows ``w`` depends on ``tf`` alone, so impacts are computed once per (stratum, tf).
A stratum's bound for an item is the sum of its terms' highest impacts there; strata are
visited from the highest bound down until the bound is below the item's 20th best score.
All sums are 64-bit integers.

Spark's part: documents are cut into terms once and stored as rows (document, number of
terms, distinct term hashes, frequencies) of the items' vocabulary.  A histogram of the
lengths (at most a few thousand classes) lays out slices of neighbouring strata of about
``postings`` postings; a large stratum gives several slices.  Each slice is one bounded
group that returns its best ``top`` documents per item; a window over those picks the
result.  Items are searched in blocks of about ``block`` terms against the stored index.

Terms are told apart by 64-bit hashes.  Odd cases: a null or empty text has no term; such
documents are not counted and never returned.  Every row is a document of its own, also
when ids repeat; rows without an id rank behind all others of equal score.  Items without
an id or without a term get no rows; of rows with the same item_id the smallest text counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capstan.llm.common import column, stored
from capstan.llm.words import LOWER, hash_runs, runs, slices

_TERM = np.zeros(256, bool)
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True

INDEX = "doc_id bigint, spot int, n bigint, bucket int, terms array<bigint>, tfs array<int>"


@dataclass(frozen=True)
class Settings:
    top: int = 20
    postings: int = 1 << 20      # of a slice, about
    block: int = 1 << 18         # item terms searched at once
    vocabulary: int = 1 << 21    # up to so many distinct item terms filter the index (16 MB); beyond, it holds all terms
    visit: int = 1 << 15         # postings of the strata visited between two looks at the threshold


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term hashes, first term of each text) of a slice of texts."""
    low = LOWER[data]
    starts, ends, first = runs(_TERM[data], offsets)
    return hash_runs(low, starts, ends).view(np.int64), first


def counted(h: np.ndarray, first: np.ndarray, keep: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms per text in hash order: (terms, counts, first entry of each text); only those in ``keep`` if given."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    if keep is not None:
        at = np.minimum(np.searchsorted(keep, h), max(len(keep) - 1, 0))
        known = keep[at] == h if len(keep) else np.zeros(len(h), bool)
        h, doc = h[known], doc[known]
    o = np.lexsort((h, doc))
    h, doc = h[o], doc[o]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[new], np.diff(np.append(new, len(h))), np.searchsorted(doc[new], np.arange(n + 1))


def bucket_of(n: np.ndarray) -> np.ndarray:
    """Length class: the length itself below 1,024, then 64 classes per doubling (never decreasing)."""
    return np.where(n < 1024, n, 1024 + np.floor(64 * np.log2(np.maximum(n, 1) / 1024)).astype(np.int64)).astype(np.int32)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms, counts): the distinct terms of every item and how often each occurs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in slices(b.column("text")):
                terms, counts, first = counted(*term_hashes(data, offsets), None)
                first = pa.array(first, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column("item_id").slice(lo, hi - lo), pa.ListArray.from_arrays(first, pa.array(terms)),
                     pa.ListArray.from_arrays(first, pa.array(counts, pa.int64()))], ["item_id", "terms", "counts"])

    one = (items.where(F.col("item_id").isNotNull()).groupBy(F.col("item_id").cast("bigint").alias("item_id"))
           .agg(F.min(F.col("text").cast("string")).alias("text")))
    return stored(one.mapInArrow(cut, "item_id bigint, terms array<bigint>, counts array<bigint>").where(F.size("terms") > 0), "search-items")


def build_index(docs: DataFrame, keep: np.ndarray | None = None) -> DataFrame:
    """The stored index rows (``INDEX``) of all documents that have a term."""
    shared = docs.sparkSession.sparkContext.broadcast(keep)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot = 0
        for b in batches:
            ids = column(b, "doc_id")
            for lo, hi, data, offsets in slices(column(b, "text")):
                h, start = term_hashes(data, offsets)
                terms, tfs, first = counted(h, start, shared.value)
                n, first = np.diff(start), pa.array(first, pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(np.arange(spot, spot + hi - lo) % (1 << 30), pa.int32()), pa.array(n), pa.array(bucket_of(n)),
                     pa.ListArray.from_arrays(first, pa.array(terms)), pa.ListArray.from_arrays(first, pa.array(tfs, pa.int32()))],
                    ["doc_id", "spot", "n", "bucket", "terms", "tfs"])
                spot += hi - lo
                yield out.filter(pa.array(n > 0))

    return stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, INDEX), "search-index")


def laid_out(index: DataFrame, postings: int) -> DataFrame:
    """The index with a slice number: neighbouring lengths share a slice, a large length class has several."""
    sizes = sorted(tuple(r) for r in index.groupBy("bucket").agg(F.sum(F.size("terms") + F.lit(1))).collect())   # length classes only
    rows, at, load = [], 0, 0
    for bucket, size in sizes:
        if load and load + size > postings:
            at, load = at + 1, 0
        pieces = -(-size // postings)
        rows.append((bucket, at, pieces))
        if pieces > 1:
            at, load = at + pieces, 0
        else:
            load += size
    plan = index.sparkSession.createDataFrame(rows, "bucket int, at int, pieces int")
    # a few thousand length classes at most
    return (index.join(F.broadcast(plan), "bucket")
            .withColumn("slice", (F.col("at") + F.pmod(F.xxhash64("doc_id", "spot"), "pieces")).cast("int"))
            .drop("bucket", "at", "pieces", "spot"))


class Slice:
    """Postings of one slice: by stratum, term and tf, with impacts and bounds."""

    def __init__(self, n: np.ndarray, terms: np.ndarray, tfs: np.ndarray, first: np.ndarray, vocabulary: np.ndarray, docs: int, length: int):
        lengths, which = np.unique(n, return_inverse=True)
        m_of = np.array([75 + (25 * int(x) * docs) // length for x in lengths], np.int64)
        self.m, stratum = np.unique(m_of[which], return_inverse=True)
        doc = np.repeat(np.arange(len(n)), np.diff(first))
        term = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
        known = vocabulary[term] == terms
        doc, term, tf = doc[known], term[known], tfs[known].astype(np.int64)
        s = stratum[doc]
        o = np.lexsort((-tf, s, term))                     # per term its strata; inside, the highest tf first
        self.doc, term, tf, s = doc[o], term[o], tf[o], s[o]
        # impacts once per (stratum, tf)
        wide = int(tf.max()) + 1 if len(tf) else 1
        pair, at = np.unique(s * wide + tf, return_inverse=True)
        ps, pt = pair // wide, pair % wide
        self.impact = ((1_000_000_000 * pt) // (1000 * pt + 12 * self.m[ps]))[at] if len(pair) else np.zeros(0, np.int64)
        new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (s[1:] != s[:-1]))) if len(term) else np.zeros(0, np.int64)
        self.start, self.end = new, np.append(new[1:], len(term)) if len(new) else new
        self.stratum, self.highest = s[new], self.impact[new]
        self.entries = np.searchsorted(term[new], np.arange(len(vocabulary) + 1))
        self.size = len(n)

    def search(self, terms: np.ndarray, weight: np.ndarray, order: np.ndarray, top: int, visit: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the best ``top``; ``order`` is each document's place among equal scores."""
        e = ranges(self.entries[terms], self.entries[terms + 1])
        w = np.repeat(weight, self.entries[terms + 1] - self.entries[terms])
        bound = np.zeros(len(self.m), np.int64)
        np.add.at(bound, self.stratum[e], w * self.highest[e])
        rank = np.empty(len(bound), np.int64)
        by = np.argsort(-bound, kind="stable")
        rank[by] = np.arange(len(by))
        o = np.argsort(rank[self.stratum[e]], kind="stable")
        e, w = e[o], w[o]
        place = rank[self.stratum[e]]
        length = self.end[e] - self.start[e]
        done = np.cumsum(length)
        best, scores, lo = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while lo < len(e):
            if len(best) == top and bound[by[place[lo]]] < scores[-1]:
                break                                         # no later stratum can reach the result
            last = int(np.searchsorted(done, (done[lo - 1] if lo else 0) + visit, "left"))
            hi = int(np.searchsorted(place, place[min(last, len(e) - 1)], "right"))       # whole strata
            p = ranges(self.start[e[lo:hi]], self.end[e[lo:hi]])
            got = np.zeros(self.size, np.int64)
            np.add.at(got, self.doc[p], np.repeat(w[lo:hi], length[lo:hi]) * self.impact[p])
            floor = scores[-1] if len(best) == top else 1
            d = np.flatnonzero(got >= max(floor, 1))
            best, scores = np.concatenate([best, d]), np.concatenate([scores, got[d]])
            pick = np.lexsort((order[best], -scores))[:top]
            best, scores, lo = best[pick], scores[pick], hi
        return best, scores


def ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    n = end - start
    off = np.cumsum(n) - n
    return np.arange(int(n.sum())) + np.repeat(start - off, n)


def search(docs: DataFrame, items: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item."""
    spark = docs.sparkSession
    asked = item_terms(items)
    vocabulary = asked.select(F.explode("terms").alias("t")).distinct()
    keep = None
    size = asked.agg(F.sum(F.size("terms")).alias("n")).first().n or 0
    if not size:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if vocabulary.count() <= s.vocabulary:
        keep = np.sort(np.array([r.t for r in vocabulary.collect()], np.int64))
    index = build_index(docs, keep)
    total = index.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    if not total.docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    sliced = laid_out(index, s.postings)
    blocks = -(-size // s.block)
    found = None
    for k in range(blocks):                                  # the stated items in blocks
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        some = _search_block(index, sliced, part, total.docs, total.length, s)
        if some is not None:
            found = some if found is None else found.unionByName(some)
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= s.top)
            .select("item_id", "rank", "doc_id", "score"))


def _search_block(index: DataFrame, sliced: DataFrame, part: DataFrame, docs: int, length: int, s: Settings) -> DataFrame | None:
    spark = index.sparkSession
    items = [(r.item_id, np.array(r.terms, np.int64), np.array(r.counts, np.int64)) for r in part.collect()]      # s.block terms, about
    if not items:
        return None
    vocabulary = np.unique(np.concatenate([t for _, t, _ in items]))
    known = spark.sparkContext.broadcast(vocabulary)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, df = known.value, np.zeros(len(known.value), np.int64)
        for b in batches:
            t = np.asarray(b.column(0).flatten())
            at = np.minimum(np.searchsorted(v, t), len(v) - 1)
            df += np.bincount(at[v[at] == t], minlength=len(v))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    df = np.zeros(len(vocabulary), np.int64)
    for r in index.select("terms").mapInArrow(frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df                                    # the block's vocabulary only
    weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    ready = []
    for item, terms, counts in items:
        at = np.searchsorted(vocabulary, terms)
        w = weight[at] * counts
        ready.append((item, at[w > 0], w[w > 0]))
    asked = spark.sparkContext.broadcast(ready)

    def best(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        terms, tfs = t.column("terms").combine_chunks(), t.column("tfs").combine_chunks()
        first = np.asarray(terms.offsets).astype(np.int64)
        part = Slice(np.asarray(t.column("n")), np.asarray(terms.flatten()), np.asarray(tfs.flatten()), first - first[0], known.value, docs, length)
        ids = t.column("doc_id").combine_chunks()
        none = np.asarray(ids.is_null())
        order = np.empty(len(ids), np.int64)
        order[np.lexsort((np.asarray(ids.fill_null(0)), none))] = np.arange(len(ids))
        rows = [(i, *part.search(at, w, order, s.top, s.visit)) for i, at, w in asked.value]
        who = np.concatenate([d for _, d, _ in rows] or [np.zeros(0, np.int64)])
        return pa.table({"item_id": np.repeat([i for i, _, _ in rows], [len(d) for _, d, _ in rows]).astype(np.int64),
                         "doc_id": ids.take(pa.array(who)),
                         "score": np.concatenate([x for _, _, x in rows] or [np.zeros(0, np.int64)])})

    return sliced.groupBy("slice").applyInArrow(best, "item_id long, doc_id long, score long")
