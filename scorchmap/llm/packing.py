"""Vector bin packing of tokenized documents into training sequences.

A sequence has three limits at once: tokens, segments (pieces) and loss-bearing tokens. Pieces are placed by the
dot-product heuristic: into the open sequence goes the waiting piece that fits and whose demand vector has the largest dot
product with what remains of the limits. Pieces of equal demands are one kind, of which several go in at once, so that the time
follows the kinds and sequences, not the number of short documents. When none fits, the best one is cut to size. What is left
of a block at last is laid out in sequences whose lengths are powers of two, which need no padding.

Each task packs its own partition, block by block, so nothing is shuffled and memory is bounded by a block and the longest
document. Sequence ids hold the partition in their upper bits; a rerun of a partition gives the same pieces. Null text
counts as empty: just the end id. Repeated rows are packed each on its own; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .encoding import append_id, as_batch, encoder
from .textops import by_bytes, text_bytes

_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loss_tokens", pa.int64()), ("ids", pa.binary())])
_DDL = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary"


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 512
    loss_tokens: int = 2048


def loss_in(start: np.ndarray, length: np.ndarray, loss_from: np.ndarray) -> np.ndarray:
    """Tokens of start .. start + length that are at loss_from or beyond."""
    return np.maximum(start + length - np.maximum(start, loss_from), 0)


def _longest(start: int, loss_from: int, tokens: int, loss: int) -> int:
    """The longest piece from start with at most so many tokens and loss-bearing tokens."""
    return min(tokens, max(loss_from - start, 0) + loss)


class _Waiting:
    """Pieces that wait, by kind: those of equal size and loss-bearing tokens, which come last in a piece, are alike for every limit."""

    def __init__(self, doc: np.ndarray, at: np.ndarray, size: np.ndarray, loss: np.ndarray):
        order = np.lexsort((-doc, loss, size))
        kinds, first, self.count = np.unique(np.stack([size[order], loss[order]], 1), axis=0, return_index=True, return_counts=True)
        self.size, self.loss = kinds.T.copy() if len(kinds) else (np.zeros(0, np.int64),) * 2
        places = list(zip(doc[order].tolist(), at[order].tolist(), strict=True))
        self.pieces = [places[a : a + n] for a, n in zip(first.tolist(), self.count.tolist(), strict=True)]
        self.kind = {k: i for i, k in enumerate(zip(self.size.tolist(), self.loss.tolist(), strict=True))}
        self.left = len(doc)

    def take(self, k: int, n: int) -> list[tuple[int, int]]:
        out = self.pieces[k][-n:][::-1]
        del self.pieces[k][-n:]
        self.count[k] -= n
        self.left -= n
        return out

    def put(self, place: tuple[int, int], size: int, loss: int) -> None:
        k = self.kind.setdefault((size, loss), len(self.pieces))
        if k == len(self.pieces):
            self.size, self.loss, self.count = np.append(self.size, size), np.append(self.loss, loss), np.append(self.count, 0)
            self.pieces.append([])
        self.pieces[k].append(place)
        self.count[k] += 1
        self.left += 1


def pack_block(lengths: np.ndarray, loss_from: np.ndarray, limits: Limits) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); lengths must be positive. Each token of each document is in one piece."""
    done: list[list[tuple[int, int, int]]] = []
    whole = _longest(0, 0, limits.tokens, limits.loss_tokens)
    start = np.zeros(len(lengths), np.int64)
    rests: list[list[tuple[int, int, int]]] = []
    for d in np.flatnonzero(lengths >= whole).tolist():
        at, size = 0, int(lengths[d])
        while size - at >= (n := _longest(at, int(loss_from[d]), limits.tokens, limits.loss_tokens)):
            (done if n == limits.tokens else rests).append([(d, at, n)])
            at += n
        start[d] = at
    doc = np.flatnonzero(lengths - start > 0)
    size = (lengths - start)[doc]
    waiting = _Waiting(doc, start[doc], size, loss_in(start[doc], size, loss_from[doc]))
    while waiting.left:
        tokens, segments, lossy, bin_ = limits.tokens, limits.segments, limits.loss_tokens, []
        while waiting.left and tokens and segments:
            value = waiting.size * (tokens / limits.tokens**2) + segments / limits.segments**2 + waiting.loss * (lossy / limits.loss_tokens**2)
            here = waiting.count > 0
            fits = here & (waiting.size <= tokens) & (waiting.loss <= lossy)
            if fits.any():
                k = int(np.argmax(np.where(fits, value, -1.0)))
                n, loss = int(waiting.size[k]), int(waiting.loss[k])
                # of equal pieces, half of what fits goes in before the products are taken again
                most = min(int(waiting.count[k]), segments, tokens // n, lossy // loss if loss else segments)
                pieces = waiting.take(k, max(1, most // 2))
                bin_ += [(d, at, n) for d, at in pieces]
                tokens, segments, lossy = tokens - n * len(pieces), segments - len(pieces), lossy - loss * len(pieces)
                continue
            k = int(np.argmax(np.where(here, value, -1.0)))
            n, loss = int(waiting.size[k]), int(waiting.loss[k])
            cut = min(n, tokens, n - loss + lossy)
            if cut <= 0:
                break
            got = max(0, cut - (n - loss))
            (d, at), *_ = waiting.take(k, 1)
            bin_.append((d, at, cut))
            tokens, segments, lossy = tokens - cut, segments - 1, lossy - got
            waiting.put((d, at + cut), n - cut, loss - got)
        if tokens:
            rests.append(bin_)
        else:
            done.append(bin_)
    for bin_ in rests:
        done += powers_of_two(bin_)
    return done


def powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The same tokens as sequences of falling powers of two; a part of a sequence meets every limit that the whole meets."""
    total = sum(n for _, _, n in pieces)
    todo, out = pieces[::-1], []
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        if room:
            out.append([])
        while room:
            d, at, n = todo.pop()
            take = min(n, room)
            out[-1].append((d, at, take))
            if take < n:
                todo.append((d, at + take, n - take))
            room -= take
    return out


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, limits: Limits = Limits(), unit: str = "drop", loss_from: str | None = None, block_tokens: int = 1 << 21) -> DataFrame:
    """One row for each piece: its document, place in it, sequence, offset there, loss-bearing tokens and ids (little-endian unsigned 32-bit).

    loss_from: a column with the first token that bears loss (else 0).
    """

    def emit(task: int, number: int, keys: list, parts: list, marks: list) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([i for i, _ in parts])
        lengths = np.concatenate([np.diff(f) for _, f in parts])
        first = np.cumsum(lengths) - lengths
        mark = np.concatenate(marks)
        key = pa.concat_arrays(keys)
        sequences = pack_block(lengths, mark, limits)
        each = np.array([len(s) for s in sequences])
        d, s, n = np.array([p for q in sequences for p in q], np.int64).T
        sequence = np.repeat(np.arange(len(sequences)), each)
        before = np.cumsum(n) - n
        offset = before - np.repeat(before[np.cumsum(each) - each], each)
        flat = ids.astype("<u4")
        for i in range(0, len(d), 4096):
            k = slice(i, i + 4096)
            data = [flat[a:b].tobytes() for a, b in zip((first[d[k]] + s[k]).tolist(), (first[d[k]] + s[k] + n[k]).tolist(), strict=True)]
            yield as_batch({"doc_id": key.take(pa.array(d[k])), "start": s[k], "length": n[k], "doc_tokens": lengths[d[k]], "sequence_id": (task << 40) + number + sequence[k], "offset": offset[k], "loss_tokens": loss_in(s[k], n[k], mark[d[k]]), "ids": data}, _OUT)
        return len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held = TaskContext.get().partitionId(), 0, 0
        keys, parts, marks = [], [], []
        for batch in by_bytes(batches):
            ids, first = append_id(*encoder(vocabulary, unit).encode(*text_bytes(batch.column(1))), end_id)
            keys.append(batch.column(0))
            parts.append((ids, first))
            marks.append(np.zeros(batch.num_rows, np.int64) if loss_from is None else batch.column(2).cast(pa.int64()).fill_null(0).to_numpy())
            held += len(ids)
            if held >= block_tokens:
                number += yield from emit(task, number, keys, parts, marks)
                keys, parts, marks, held = [], [], [], 0
        if keys:
            yield from emit(task, number, keys, parts, marks)

    return docs.select("doc_id", "text", *([loss_from] if loss_from else [])).mapInArrow(run, _DDL)
