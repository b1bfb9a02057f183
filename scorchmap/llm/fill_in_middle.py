"""Fill-in-the-middle: texts are cut at two token boundaries and written with the middle last.

The boundaries of a batch of texts (where a unit, a run of A-Z and a-z or any other single character, ends) are kept in a set of
byte positions of the kind of a Roaring bitmap: each 65,536 positions have a container, which is a sorted array, a bitmap or a list
of runs, whichever is smallest, and containers carry the number of boundaries before them. The k-th boundary of a text is a rank in
that set: its container is found by search among those numbers, and a select within the container gives the position, for all cuts of
a batch at once.

A text is written in one of three forms. plain: as it is; psm: ``<P>``prefix``<S>``suffix``<M>``middle; spm: ``<S>``suffix``<P>``prefix``<M>``middle.
Which one, and where it is cut, follows from a hash of the seed and the doc_id alone, so a row gives the same result wherever it is
computed. Markers cannot overlap each other, and texts that hold one stay plain, so restore() gives every text back.

A null or empty text is plain and empty, of 0 units. A null doc_id counts as an empty id in the hash. Rows of one doc_id are cut by
the same hashes, each on its own text. An empty table gives no rows. Further columns of the input are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import as_batch
from .textops import by_bytes, ranges, text_bytes

_PLAIN, _PSM, _SPM = 0, 1, 2
_FORMS = np.array(["plain", "psm", "spm"], object)
#: Marker letters in the order in which a form has them.
_MARKERS = (b"<P>", b"<S>", b"<M>")
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Positions of a container; sizes of an array and of a run in bytes, of a bitmap of them all.
_SPAN, _ENTRY, _RUN, _BITMAP = 1 << 16, 2, 4, 1 << 13


@dataclass
class _Array:
    low: np.ndarray  # sorted

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.low[k].astype(np.int64)


@dataclass
class _Runs:
    start: np.ndarray
    before: np.ndarray  # entries in the runs before

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, k, "right") - 1
        return self.start[run].astype(np.int64) + k - self.before[run]


@dataclass
class _Bitmap:
    words: np.ndarray
    before: np.ndarray  # entries in the words before

    def select(self, k: np.ndarray) -> np.ndarray:
        """The word is found by its cumulative cardinality, the bit by halving: the lower half is left behind if it has too few bits."""
        word = np.searchsorted(self.before, k, "right") - 1
        left, bits, at = k - self.before[word], self.words[word], np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            low = bits & np.uint64((1 << half) - 1)
            n = np.bitwise_count(low).astype(np.int64)
            up = left >= n
            left, at, bits = np.where(up, left - n, left), np.where(up, at + half, at), np.where(up, bits >> np.uint64(half), low)
        return word * 64 + at


def _container(low: np.ndarray) -> _Array | _Runs | _Bitmap:
    """The smallest container for sorted, different positions below _SPAN."""
    heads = np.flatnonzero(np.concatenate([[True], np.diff(low) != 1]))
    if _RUN * len(heads) < min(_ENTRY * len(low), _BITMAP):
        return _Runs(low[heads].astype(np.uint16), heads)
    if _ENTRY * len(low) <= _BITMAP:
        return _Array(low.astype(np.uint16))
    bits = np.zeros(_SPAN, np.uint8)
    bits[low] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    n = np.bitwise_count(words).astype(np.int64)
    return _Bitmap(words, np.cumsum(n) - n)


class BoundarySet:
    """A set of positions with select by rank."""

    def __init__(self, positions: np.ndarray):
        """positions: sorted and different."""
        self.size = len(positions)
        high = positions >> 16
        first = np.flatnonzero(np.concatenate([[True], high[1:] != high[:-1]])) if self.size else np.zeros(0, np.int64)
        self.high, self.before = high[first], first  # entries in the containers before
        ends = [*first[1:].tolist(), self.size] if self.size else []
        self.containers = [_container(positions[a:b] & (_SPAN - 1)) for a, b in zip(first.tolist(), ends, strict=True)]

    def select(self, rank: np.ndarray) -> np.ndarray:
        """The positions of these ranks (from 0)."""
        at = np.searchsorted(self.before, rank, "right") - 1
        out = np.zeros(len(rank), np.int64)
        for c in np.unique(at).tolist():
            some = np.flatnonzero(at == c)
            out[some] = (int(self.high[c]) << 16) + self.containers[c].select(rank[some] - self.before[c])
        return out


def unit_ends(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte positions at which a unit ends: after each character but where two letters of one text follow each other."""
    if not len(buf):
        return np.zeros(0, np.int64)
    letter = _LETTER[buf]
    ends = np.zeros(len(buf) + 1, bool)
    ends[1:-1] = ((buf[1:] & 0xC0) != 0x80) & ~(letter[1:] & letter[:-1])
    ends[at] = True
    ends[0] = False
    return np.flatnonzero(ends)


def _marked(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each text holds a marker."""
    found = np.flatnonzero((buf[:-2] == 0x3C) & (buf[2:] == 0x3E) & ((buf[1:-1] == 0x50) | (buf[1:-1] == 0x53) | (buf[1:-1] == 0x4D)))
    doc = np.searchsorted(at, found, "right") - 1
    out = np.zeros(len(at) - 1, bool)
    out[doc[found + 3 <= at[doc + 1]]] = True
    return out


@dataclass(frozen=True)
class Options:
    """seed of the hash; percent of texts that are cut, and percent of those that are written suffix first."""

    seed: int = 1
    percent: int = 90
    spm_percent: int = 20


def _hashes(ids: list, seed: int) -> np.ndarray:
    """Four numbers of 32 bits for each id."""
    said = b"".join(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).digest()[:16] for k in ids)
    return np.frombuffer(said, ">u4").reshape(-1, 4).astype(np.int64)


def transform(ids: list, column: pa.Array, options: Options = Options()) -> dict:
    """n, form, prefix_chars and middle_chars (null where plain) and output of each text."""
    buf, at = text_bytes(column)
    ends = unit_ends(buf, at)
    first = np.searchsorted(ends, at, "right")  # ends up to where each text begins
    n = np.diff(first)
    h = _hashes(ids, options.seed)
    plain = (n == 0) | (h[:, 2] % 100 >= options.percent) | _marked(buf, at)
    form = np.where(plain, _PLAIN, np.where(h[:, 3] % 100 < options.spm_percent, _SPM, _PSM))
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    # the k-th unit of a text ends at its k-th boundary; before all units is where the text begins
    cut, ask = np.repeat(at[:-1, None], 2, axis=1), (cuts > 0) & ~plain[:, None]
    cut[ask] = BoundarySet(ends).select((first[:-1, None] + cuts - 1)[ask])
    edges = np.stack([at[:-1], cut[:, 0], cut[:, 1], at[1:]], 1)
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[edges]
    size = np.diff(chars, axis=1)
    out, ends_out = _written(buf, edges, form)
    offsets = pa.array(np.concatenate([[0], ends_out]), pa.int64()).buffers()[1]
    hidden = pa.array(plain)
    none = pa.scalar(None, pa.int64())
    return {
        "n": n,
        "form": _FORMS[form],
        "prefix_chars": pc.if_else(hidden, none, pa.array(size[:, 0])),
        "middle_chars": pc.if_else(hidden, none, pa.array(size[:, 1])),
        "output": pa.LargeStringArray.from_buffers(len(n), offsets, pa.py_buffer(out)).cast(pa.string()),
    }


def _written(buf: np.ndarray, edges: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All outputs in a row, and where each ends. Segments are copied by their offsets into one buffer.

    A text is six segments, a marker and a part three times; they come from its bytes with the markers behind them.
    """
    source = np.concatenate([buf, np.frombuffer(b"".join(_MARKERS), np.uint8)])
    start, length = edges[:, :3], np.diff(edges, axis=1)  # prefix, middle, suffix
    p, m, s = 0, 1, 2
    order = np.array([[p, m, s], [p, s, m], [s, p, m]])[form]
    marker = np.array([[0, 0, 0], [0, 1, 2], [1, 0, 2]])[form]
    row = np.arange(len(form))[:, None]
    begins = np.stack([len(buf) + 3 * marker, start[row, order]], 2).reshape(len(form), 6)
    lengths = np.stack([np.where(form[:, None] == _PLAIN, 0, np.full_like(marker, 3)), length[row, order]], 2).reshape(len(form), 6)
    return source[ranges(begins.ravel(), lengths.ravel())], np.cumsum(lengths.sum(axis=1))


_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


def fill_in_middle(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output for each row of docs(doc_id, text). No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            yield as_batch({"doc_id": batch.column(0), **transform(batch.column(0).to_pylist(), batch.column(1), options)}, _OUT)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: str = "output", form: str = "form"):
    """A column: the text that an output was made of. Parts hold no marker, so the first one of each kind ends a part."""

    def parts(second: str):
        body = F.substring(output, 4, 2**31 - 1)
        head = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(head) + 4)
        tail = F.substring_index(rest, "<M>", 1)
        return head, tail, F.substr(rest, F.length(tail) + 4)

    prefix, suffix, middle = parts("<S>")
    suffix_, prefix_, middle_ = parts("<P>")
    return F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix)).when(F.col(form) == "spm", F.concat(prefix_, middle_, suffix_)).otherwise(F.col(output))
