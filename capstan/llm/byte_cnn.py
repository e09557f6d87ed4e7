"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, filters of ``2 * step`` bytes slide over the whole document in
steps of ``step`` bytes, chunks of ``chunk`` bytes that overlap by ``overlap`` are
max-pooled, and the mean over all chunks goes through a logistic unit.  Beside
the byte itself, a position has one more input: whether the last ``echo`` bytes
already stood a short way before (so that filters can see runs of one word).

The network is fitted on a bounded sample of labelled rows (``fit_rows``, both
labels alike, chosen by a hash of doc_id; at most ``fit_chunks`` chunks of each,
spread over its text).  Scores use the text alone and cover every byte of it.

Defined cases: NULL and empty texts have no chunk and get the score of a zero
vector; without both labels every score is the share of label 1 (0.5 without any
label); repeated rows score alike; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.words import slices

PAD = 256
LAGS = range(2, 21)           # distances at which an echo is looked for


@dataclass(frozen=True)
class Settings:
    fit_rows: int = 4000
    fit_chunks: int = 4
    chunk: int = 512
    overlap: int = 64
    step: int = 4
    echo: int = 6
    width: int = 7            # numbers per embedded byte (the echo makes one more)
    filters: int = 32
    updates: int = 450        # gradient steps, whatever the size of the sample
    batch: int = 64
    rate: float = 4e-3
    cut: float = 0.7          # predicted 1 from this score on

    @property
    def stride(self) -> int:
        return self.chunk - self.overlap


@dataclass
class Network:
    embed: np.ndarray         # (257, width)
    first: np.ndarray         # (step * (width + 1), filters): the filter's first bytes
    second: np.ndarray        # ... and its last
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    settings: Settings
    constant: float | None = None


def echoes(data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """1 where the last ``length`` bytes equal those at one of ``LAGS`` before, within the document."""
    n = len(data)
    out = np.zeros(n, bool)
    place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    for lag in LAGS:
        if n <= lag + length:
            break
        same = np.zeros(n, bool)
        same[lag:] = data[lag:] == data[:-lag]
        run, have = same, 1
        while have < length:                  # runs of ``length`` equal bytes, by doubling
            step = min(have, length - have)
            longer = np.zeros(n, bool)
            longer[step:] = run[step:] & run[:-step]
            run, have = longer, have + step
        out |= run & (place >= lag + length - 1)
    return out


def _padded(data: np.ndarray, offsets: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents padded to whole strides: (bytes, echoes, first stride of each document)."""
    size = np.diff(offsets)
    blocks = -(-size // s.stride)
    first = np.concatenate([[0], np.cumsum(blocks)])
    out = np.full(int(first[-1]) * s.stride, PAD, np.int16)
    echo = np.zeros(len(out), np.float32)
    at = np.arange(len(data)) + np.repeat(first[:-1] * s.stride - offsets[:-1], size)
    out[at] = data
    echo[at] = echoes(data, offsets, s.echo)
    return out, echo, first


def _inputs(net: Network, symbols: np.ndarray, echo: np.ndarray) -> np.ndarray:
    s = net.settings
    x = np.empty((len(symbols), s.width + 1), np.float32)
    x[:, :-1] = net.embed[symbols]
    x[:, -1] = echo
    return x.reshape(-1, s.step * (s.width + 1))


def scores(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One probability per document of a slice."""
    s, n = net.settings, len(offsets) - 1
    if net.constant is not None:
        return np.full(n, net.constant)
    symbols, echo, first = _padded(data, offsets, s)
    pooled = np.zeros((n, s.filters))
    blocks = len(symbols) // s.stride
    if blocks:
        pad = _inputs(net, np.full(s.step, PAD, np.int16), np.zeros(s.step, np.float32))
        per = s.stride // s.step
        body = np.empty((blocks, s.filters), np.float32)
        lead = np.empty((blocks, s.filters), np.float32)
        last = np.zeros(blocks, bool)
        some = np.diff(first) > 0
        last[first[1:][some] - 1] = True
        ahead = s.overlap // s.step
        for lo in range(0, blocks, 256):
            hi = min(lo + 256, blocks)
            x = _inputs(net, symbols[lo * s.stride:hi * s.stride], echo[lo * s.stride:hi * s.stride])
            tail = _inputs(net, symbols[hi * s.stride:hi * s.stride + s.step], echo[hi * s.stride:hi * s.stride + s.step]) if hi < blocks else pad
            y = np.concatenate([x[1:], tail]) @ net.second
            ends = (np.flatnonzero(last[lo:hi]) + 1) * per - 1
            y[ends] = pad @ net.second                      # a filter does not reach into the next document
            y += x @ net.first
            y = y.reshape(hi - lo, per, s.filters)
            body[lo:hi] = y.max(axis=1)
            lead[lo:hi] = y[:, :ahead].max(axis=1)
        chunk = body
        chunk[:-1] = np.where(last[:-1, None], chunk[:-1], np.maximum(chunk[:-1], lead[1:]))
        chunk = np.maximum(chunk + net.bias, 0).astype(np.float64)
        total = np.concatenate([np.zeros((1, s.filters)), np.cumsum(chunk, axis=0)])
        pooled = (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)[:, None]
    z = pooled @ net.out.astype(np.float64) + net.out_bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(texts: list[bytes], labels: np.ndarray, s: Settings) -> Network:
    """Fit by Adam on the pieces ``texts`` (each piece: whole chunks of one document)."""
    rng = np.random.default_rng(11)
    wide = s.step * (s.width + 1)
    net = Network(rng.normal(0, 0.5, (257, s.width)).astype(np.float32), rng.normal(0, 0.15, (wide, s.filters)).astype(np.float32),
                  rng.normal(0, 0.15, (wide, s.filters)).astype(np.float32), np.zeros(s.filters, np.float32),
                  rng.normal(0, 0.2, s.filters).astype(np.float32), 0.0, s)
    data = []
    for t in texts:
        raw = np.frombuffer(t, np.uint8)
        blocks = max(1, -(-len(raw) // s.stride))
        sym = np.full(blocks * s.stride + s.overlap, PAD, np.int16)
        ech = np.zeros(len(sym), np.float32)
        sym[:len(raw)] = raw
        ech[:len(raw)] = echoes(raw, np.array([0, len(raw)]), s.echo)
        at = (np.arange(blocks) * s.stride)[:, None] + np.arange(s.chunk)
        pick = np.unique(np.linspace(0, blocks - 1, min(blocks, s.fit_chunks)).astype(int))
        data.append((sym[at[pick]], ech[at[pick]]))
    names = ["embed", "first", "second", "bias", "out"]
    m = {k: np.zeros_like(getattr(net, k)) for k in names} | {"out_bias": 0.0}
    v = {k: np.zeros_like(getattr(net, k)) for k in names} | {"out_bias": 0.0}
    t = 0
    # both labels weigh alike, however rare one of them is in the sample
    share = float(labels.mean())
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    while t < s.updates:
        order = rng.permutation(len(data))
        for lo in range(0, len(order), s.batch):
            rows = order[lo:lo + s.batch]
            sym = np.concatenate([data[i][0] for i in rows])
            ech = np.concatenate([data[i][1] for i in rows])
            count = np.array([len(data[i][0]) for i in rows])
            doc = np.repeat(np.arange(len(rows)), count)
            x = _inputs(net, sym.ravel(), ech.ravel()).reshape(len(sym), -1, wide)
            y = x[:, :-1] @ net.first + x[:, 1:] @ net.second
            best = y.argmax(axis=1)                                     # (chunks, filters)
            top = np.take_along_axis(y, best[:, None], axis=1)[:, 0] + net.bias
            act = np.maximum(top, 0)
            pooled = np.zeros((len(rows), s.filters), np.float32)
            np.add.at(pooled, doc, act)
            pooled /= count[:, None]
            p = 1 / (1 + np.exp(-(pooled @ net.out + net.out_bias)))
            d = ((p - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            grad: dict = {"out": pooled.T @ d + 1e-4 * net.out, "out_bias": float(d.sum())}
            g = (d / count)[doc][:, None] * net.out * (top > 0)         # (chunks, filters)
            chunk = np.arange(len(sym))[:, None]
            xa, xb = x[chunk, best], x[chunk, best + 1]                 # (chunks, filters, wide)
            grad["bias"] = g.sum(axis=0)
            grad["first"] = np.einsum("cf,cfw->wf", g, xa)
            grad["second"] = np.einsum("cf,cfw->wf", g, xb)
            steps = sym.reshape(len(sym), -1, s.step)
            ge = np.zeros_like(net.embed)
            for rows_at, kernel in ((best, net.first), (best + 1, net.second)):
                back = (g[:, :, None] * kernel.T[None]).reshape(*g.shape, s.step, s.width + 1)[..., :-1]
                at, back = steps[chunk, rows_at].ravel(), back.reshape(-1, s.width)
                for c in range(s.width):
                    ge[:, c] += np.bincount(at, weights=back[:, c], minlength=257)
            grad["embed"] = ge
            t += 1
            for k in (*names, "out_bias"):
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                step = s.rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
                setattr(net, k, getattr(net, k) - step)
    for k in names:
        setattr(net, k, getattr(net, k).astype(np.float32))
    return net


def held_out(doc_id, modulus: int, value: int):
    """Whether crc32 of doc_id's decimal text leaves ``value``; rows without doc_id are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus)) == value, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Network:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    usable = (labels.filter(F.col("quality").isin(0, 1) & ~held_out("doc_id", 4, 2))
              .groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("quality")))
    draw = F.xxhash64("_id", F.lit("fit"))
    # half of the sample for each label, by the order of a hash
    sample = usable.filter("quality = 0").orderBy(draw).limit(s.fit_rows // 2).union(
        usable.filter("quality = 1").orderBy(draw).limit(s.fit_rows // 2))
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))   # at most fit_rows ids
    bound = s.fit_chunks * s.stride

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                raw = (text or "").encode()
                if len(raw) > bound:                       # pieces spread over the text
                    starts = np.linspace(0, len(raw) - s.stride, s.fit_chunks).astype(int)
                    raw = b"".join(raw[a:a + s.stride] for a in starts)
                out.append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), b.column(2)], ["doc_id", "raw", "quality"])

    # one row per id: of a repeated id the smallest text
    one = picked.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("quality").cast("int").alias("quality"))
    rows = one.mapInArrow(cut, "doc_id long, raw binary, quality int").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["raw"])))
    y = np.array([r["quality"] for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        zero = np.zeros(0, np.float32)
        return Network(zero, zero, zero, zero, zero, 0.0, s, float(y.mean()) if len(y) else 0.5)
    return train([bytes(r["raw"]) for r in rows], y, s)


def classify(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(net)        # some ten thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in slices(b.column(1), 1 << 20):
                p = scores(shared.value, data, off)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(p),
                     pa.array((p >= shared.value.settings.cut).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long"), "text", held_out("doc_id", 4, 2).alias("held_out"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))
