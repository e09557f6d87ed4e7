"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The vocabulary (pieces, scores, kinds) is read from a public model file; the
merges are done here.  A slice of documents is cut into segments that no piece
can span; every distinct segment is a row of one flat symbol array.  In each
round the best-scored pair of every segment is found by a segmented minimum,
all its leftmost non-overlapping occurrences merge at once, and the array is
compacted, until no segment has a pair left.  A piece whose extension scores
better than itself merges one occurrence a round, which keeps the order of a
one-merge-at-a-time queue; a long segment in which a round merges less than a 64th
of the symbols (a run of blanks) is finished by such a queue, so the work stays
near the length of the text.

Segments are identified by 64-bit hashes within a task.  Defined cases: NULL and
empty texts encode to the begin and end ids alone and decode to the empty text;
every other text round-trips (U+2581 decodes to a space, as in the library).
Repeated rows give repeated results; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from capstan.llm.words import hash_runs, slices

SPACE = "▁"                # stands for a space inside pieces
_NONE = np.int32(2**31 - 1)     # rank of a pair that makes no piece
LONG = 1024                     # symbols from which on a word may leave the rounds


@dataclass
class Vocabulary:
    begin: int
    end: int
    byte_ids: np.ndarray         # id of the fallback piece of each byte
    chars: np.ndarray            # sorted code points that are symbols of their own ...
    char_symbols: np.ndarray     # ... and their symbol numbers (piece ids, or beyond the pieces)
    pair_keys: np.ndarray        # sorted left << 32 | right
    pair_ranks: np.ndarray       # rank of the piece that the pair makes
    pair_piece: np.ndarray       # that piece
    one_at_a_time: np.ndarray    # per rank
    piece_bytes: np.ndarray      # decoded bytes of all pieces ...
    piece_offsets: np.ndarray    # ... and where each begins
    solo: np.ndarray             # ASCII bytes that occur in no longer piece
    cut_spaces: bool             # no piece has a space after another character

    @property
    def size(self) -> int:
        return len(self.piece_offsets) - 1

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        """left << 32 | right -> (rank, piece)."""
        return dict(zip(self.pair_keys.tolist(), zip(self.pair_ranks.tolist(), self.pair_piece.tolist(), strict=True), strict=True))


def load(path: str) -> Vocabulary:
    """Read a SentencePiece BPE model with byte fallback (identity normalisation, dummy prefix)."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = pb.ModelProto.FromString(sp.serialized_model_proto())
    norm = proto.normalizer_spec
    if (proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback
            or norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces
            or not norm.escape_whitespaces):
        raise ValueError("a BPE model with byte fallback, identity normalisation and a dummy prefix is needed")
    kind = pb.ModelProto.SentencePiece
    pieces = [(i, p.piece, p.score, p.type) for i, p in enumerate(proto.pieces)]
    if any(t in (kind.USER_DEFINED, kind.UNUSED) for *_, t in pieces):
        raise ValueError("models with user-defined or unused pieces are not covered")
    normal = {s: i for i, s, _, t in pieces if t == kind.NORMAL}
    score = {s: sc for _, s, sc, t in pieces if t == kind.NORMAL}
    byte_ids = np.zeros(256, np.int32)
    for i, s, _, t in pieces:
        if t == kind.BYTE:
            byte_ids[int(s[3:5], 16)] = i
    symbols = dict(normal)
    for ch in sorted({c for s in normal for c in s} - set(normal)):
        symbols[ch] = len(pieces) + len(symbols)
    longer = [s for s in normal if len(s) > 1]
    levels = {sc: r for r, sc in enumerate(sorted({score[s] for s in longer}, reverse=True))}
    rank = {s: levels[score[s]] for s in longer}
    keys, ranks, made = [], [], []
    slow = np.bincount(list(rank.values()), minlength=len(levels)) > 1      # pieces of equal score wait for each other
    for s in longer:
        for k in range(1, len(s)):
            left, right = s[:k], s[k:]
            if left in symbols and right in symbols:
                keys.append(symbols[left] << 32 | symbols[right])
                ranks.append(rank[s])
                made.append(normal[s])
                for part in (left, right):
                    if part in rank and rank[s] <= rank[part]:
                        slow[rank[part]] = True
    keys = np.array(keys, np.int64)
    at = np.argsort(keys)
    singles = sorted((ord(c), n) for c, n in symbols.items() if len(c) == 1)
    decoded = []
    for i, s, _, t in pieces:
        decoded.append(s.replace(SPACE, " ").encode() if t == kind.NORMAL else bytes([int(s[3:5], 16)]) if t == kind.BYTE else b"")
    inside = {c for s in longer for c in s}
    solo = np.zeros(256, bool)
    solo[[b for b in range(128) if b != 32 and chr(b) not in inside]] = True
    return Vocabulary(
        sp.bos_id(), sp.eos_id(), byte_ids,
        np.array([c for c, _ in singles], np.int64), np.array([n for _, n in singles], np.int64),
        keys[at], np.array(ranks, np.int32)[at], np.array(made, np.int64)[at], slow,
        np.frombuffer(b"".join(decoded), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in decoded])]),
        solo, not any(SPACE in s.lstrip(SPACE) for s in longer))


def _pair_ranks(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    key = (left << 32) | right
    at = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
    return np.where((v.pair_keys[at] == key) & (left >= 0) & (right >= 0), v.pair_ranks[at], _NONE).astype(np.int32)


def merge(v: Vocabulary, code: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the characters ``code`` of the words ``word`` (non-decreasing) to symbols.

    Returns (symbols, words) in order; a character without symbol is ``-1 - code point``.
    """
    at = np.minimum(np.searchsorted(v.chars, code), len(v.chars) - 1)
    sym = np.where(v.chars[at] == code, v.char_symbols[at], -1 - code)
    done_sym, done_word = [], []
    rank = np.full(len(sym), _NONE, np.int32)
    if len(sym) > 1:
        rank[:-1] = np.where(word[:-1] == word[1:], _pair_ranks(v, sym[:-1], sym[1:]), _NONE)
    stuck: list[int] = []                             # long words whose last round merged little
    while len(sym):
        if stuck:
            held = np.isin(word, stuck)
            for w in stuck:
                rest = _merge_by_heap(v, sym[word == w], rank[word == w])
                done_sym.append(rest)
                done_word.append(np.full(len(rest), w, word.dtype))
            sym, word, rank, stuck = sym[~held], word[~held], rank[~held], []
            if not len(sym):
                break
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        length = np.diff(np.concatenate([first, [len(sym)]]))
        best = np.minimum.reduceat(rank, first)
        alive = best < _NONE
        if not alive.all():
            keep = np.repeat(alive, length)
            done_sym.append(sym[~keep])
            done_word.append(word[~keep])
            sym, word, rank = sym[keep], word[keep], rank[keep]
            best, length = best[alive], length[alive]
            if not len(sym):
                break
        chosen = np.flatnonzero(rank == np.repeat(best, length))
        # of touching occurrences every other one, counted from the left
        new_run = np.ones(len(chosen), bool)
        new_run[1:] = chosen[1:] != chosen[:-1] + 1
        index = np.arange(len(chosen))
        run = np.maximum.accumulate(np.where(new_run, index, 0))
        take = (index - run) % 2 == 0
        slow = v.one_at_a_time[rank[chosen]]
        if slow.any():
            leftmost = np.ones(len(chosen), bool)
            leftmost[1:] = word[chosen[1:]] != word[chosen[:-1]]
            take &= ~slow | leftmost
        chosen = chosen[take]
        if length.max() > LONG:
            first = np.cumsum(length) - length
            merged = np.diff(np.append(np.searchsorted(chosen, first), len(chosen)))
            stuck = word[first[(length > LONG) & (merged * 64 < length)]].tolist()
        sym[chosen] = v.pair_piece[np.searchsorted(v.pair_keys, sym[chosen] << 32 | sym[chosen + 1])]
        gone = np.zeros(len(sym), bool)
        gone[chosen + 1] = True
        stale = np.zeros(len(sym), bool)
        stale[chosen] = True
        stale[chosen[chosen > 0] - 1] = True          # the pair that now ends in the merged symbol
        two = chosen[chosen > 1] - 2                  # ... also when the symbol between them has gone
        stale[two[gone[two + 1]]] = True
        keep = ~gone
        sym, word, rank, stale = sym[keep], word[keep], rank[keep], stale[keep]
        p = np.flatnonzero(stale)
        rank[p] = _NONE
        p = p[p < len(sym) - 1]
        p = p[word[p] == word[p + 1]]
        rank[p] = _pair_ranks(v, sym[p], sym[p + 1])
    if not done_sym:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


def _merge_by_heap(v: Vocabulary, sym: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The rest of one long word's merges, smallest (rank, place) first, over linked symbols: n log n steps for n symbols.

    For words whose occurrences must be merged one at a time (a run of blanks or of one
    letter), where every round over the flat arrays would merge next to nothing.
    """
    n, pairs = len(sym), v.pairs
    s, r = sym.tolist(), rank.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    r[-1] = _NONE
    heap = [q << 40 | p for p, q in enumerate(r) if q < _NONE]
    heapq.heapify(heap)
    mask, none = (1 << 40) - 1, (_NONE, -1)
    while heap:
        top = heapq.heappop(heap)
        p = top & mask
        if r[p] != top >> 40:
            continue                                  # the pair has changed since
        q = after[p]
        s[p] = pairs[s[p] << 32 | s[q]][1]
        r[q] = -1                                     # gone
        after[p] = z = after[q]
        r[p] = _NONE
        if z < n:
            before[z] = p
            r[p] = new = pairs.get(s[p] << 32 | s[z], none)[0] if s[z] >= 0 else _NONE
            if new < _NONE:
                heapq.heappush(heap, new << 40 | p)
        a = before[p]
        if a >= 0:
            r[a] = new = pairs.get(s[a] << 32 | s[p], none)[0] if s[a] >= 0 else _NONE
            if new < _NONE:
                heapq.heappush(heap, new << 40 | a)
    return np.array([s[p] for p in range(n) if r[p] >= 0], sym.dtype)


def _to_ids(v: Vocabulary, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols outside the vocabulary become the ids of their UTF-8 bytes."""
    odd = np.flatnonzero((sym < 0) | (sym >= v.size))
    if not len(odd):
        return sym.astype(np.int32), word
    beyond = {int(n): int(c) for c, n in zip(v.chars, v.char_symbols) if n >= v.size}
    raw = [chr(-1 - int(s) if s < 0 else beyond[int(s)]).encode() for s in sym[odd]]
    count = np.ones(len(sym), np.int64)
    count[odd] = [len(r) for r in raw]
    out = np.repeat(sym, count)
    out[np.repeat(np.isin(np.arange(len(sym)), odd), count)] = v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out.astype(np.int32), np.repeat(word, count)


class Encoder:
    """Encodes slices of documents; distinct segments are merged once and remembered within the task."""

    MEMORY = 1 << 20             # remembered segments; beyond it the memory starts anew

    def __init__(self, v: Vocabulary):
        self.v = v
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.first = [0]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        text = b"".join(data[s:e].tobytes() + b"\n" for s, e in zip(starts.tolist(), ends.tolist())).decode()
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        # a separator follows every segment; a segment may itself hold line feeds
        raw = np.frombuffer(text.encode(), np.uint8)
        size = ends - starts
        leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        edge = np.concatenate([[0], np.cumsum(size + 1)])
        n_chars = leads[edge[1:]] - leads[edge[:-1]]
        word = np.repeat(np.arange(len(keys)), n_chars)
        keep = np.ones(len(code), bool)
        keep[np.cumsum(n_chars) - 1] = False
        code, word = code[keep], word[keep]
        code[code == 32] = ord(SPACE)
        ids, word = _to_ids(self.v, *merge(self.v, code, word))
        counts = np.bincount(word, minlength=len(keys))
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need, 2 * len(self.ids)) - len(self.ids), np.int32)])
        self.ids[self.used:need] = ids
        base = len(self.known)
        self.first += (self.used + np.cumsum(counts)).tolist()
        self.used = need
        self.known.update(zip(keys.tolist(), range(base, base + len(keys))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents with begin and end ids, first id of each document)."""
        v, n = self.v, len(offsets) - 1
        # a dummy space before every non-empty document
        size = np.diff(offsets)
        some = size > 0
        off = np.concatenate([[0], np.cumsum(size + some)])
        padded = np.full(int(off[-1]), 32, np.uint8)
        body = np.ones(len(padded), bool)
        body[off[:-1][some]] = False
        padded[body] = data
        starts = np.zeros(len(padded), bool)
        if len(padded):
            before = np.concatenate([[0], padded[:-1]])
            if v.cut_spaces:
                starts |= (padded == 32) & (before != 32)
            starts |= v.solo[padded] | v.solo[before]
            starts[off[:-1][some]] = True
        starts = np.flatnonzero(starts)
        ends = np.concatenate([starts[1:], [len(padded)]])[:len(starts)]
        keys, where, inverse = np.unique(hash_runs(padded, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > self.MEMORY:
            self._forget()
        new = np.array([k not in self.known for k in keys.tolist()], bool)
        if new.any():
            at = where[new]
            self._learn(padded, starts[at], ends[at], keys[new])
        slot = np.array([self.known[k] for k in keys.tolist()], np.int64)[inverse]
        first = np.array(self.first, np.int64)
        begin, count = first[slot], first[slot + 1] - first[slot]
        segs = np.searchsorted(starts, off)                       # first segment of each document
        total = np.concatenate([[0], np.cumsum(count)])
        n_ids = total[segs[1:]] - total[segs[:-1]]
        out_first = np.concatenate([[0], np.cumsum(n_ids + 2)])
        out = np.empty(int(out_first[-1]), np.int32)
        out[out_first[:-1]] = v.begin
        out[out_first[1:] - 1] = v.end
        body = np.ones(len(out), bool)
        body[out_first[:-1]] = False
        body[out_first[1:] - 1] = False
        flat = np.arange(int(total[-1]), dtype=np.int64) + np.repeat(begin - total[:-1], count)
        out[body] = self.ids[flat]
        return out, out_first


def decode(v: Vocabulary, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all documents, offsets): pieces joined, control ids dropped, the dummy space taken off."""
    size = v.piece_offsets[ids + 1] - v.piece_offsets[ids]
    edge = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(int(edge[-1]), dtype=np.int64) + np.repeat(v.piece_offsets[ids] - edge[:-1], size)
    raw = v.piece_bytes[index]
    off = edge[first]
    lead = off[:-1][(off[1:] > off[:-1])]
    lead = lead[raw[lead] == 32]
    keep = np.ones(len(raw), bool)
    keep[lead] = False
    gone = np.searchsorted(lead, off)
    return raw[keep], off - gone


def _plain(text: pa.Array) -> pa.Array:
    return pc.replace_substring(text, SPACE, " ") if pc.any(pc.match_substring(text, SPACE)).as_py() else text


def token_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model_path))     # bounded by the model's vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(shared.value)
        for b in batches:
            ids_col = b.column(0).cast(pa.int64())
            for lo, hi, data, off in slices(_plain(b.column(1))):
                ids, first = enc.encode(data, off)
                text, toff = decode(shared.value, ids, first)
                raw, plain = ids.astype("<u4").tobytes(), text.tobytes()
                sha = lambda buf, at, w: [hashlib.sha256(buf[w * p:w * q]).hexdigest() for p, q in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [ids_col.slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(sha(raw, first.tolist(), 4)),
                     pa.array(sha(plain, toff.tolist(), 1))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array<int>, text): the ids of every document and what they decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(shared.value)
        for b in batches:
            ids_col = b.column(0).cast(pa.int64())
            for lo, hi, data, off in slices(_plain(b.column(1))):
                ids, first = enc.encode(data, off)
                text, toff = decode(shared.value, ids, first)
                lists = pa.LargeListArray.from_arrays(pa.array(first), pa.array(ids)).cast(pa.list_(pa.int32()))
                texts = pa.LargeStringArray.from_buffers(
                    hi - lo, pa.py_buffer(toff.astype(np.int64).tobytes()), pa.py_buffer(text.tobytes())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([ids_col.slice(lo, hi - lo), lists, texts], ["doc_id", "ids", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, text string")
