"""Vectorised word handling shared by the text operators.

Everything works on one Arrow string column at a time, seen as a UTF-8 byte buffer and document offsets, so that no
Python object is made per word. Null texts count as empty ones.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words that are separated by ASCII white space.
PLAIN_WORD = ~_SPACE
#: Bytes of words made of ASCII letters, digits and all non-ASCII characters.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


_WORD_BASE = 0xD6E8FEB86659FD93
_powers: dict[int, np.ndarray] = {}
_BLOCK_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Longer spans are hashed one by one.
_LONG_SPAN = 256


def _pow(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if len(have) <= CHUNK_BYTES:  # else a worker would keep what one very long text needs
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and len(column) + 1 offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset :]
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, at - at[0]


_resident: dict[str, tuple[object, object]] = {}


def resident(kind: str, key: object, make: Callable[[], object]) -> object:
    """What a worker keeps between tasks: the last thing made, one of any kind."""
    if _resident.get(kind, (None,))[0] != key:
        _resident.clear()
        _resident[kind] = (key, make())
    return _resident[kind][1]


def give_back() -> None:
    """Returns free memory of this process to the system; workers live as long as their executor, whatever stage they serve."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def by_bytes(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each holds about limit bytes of text, or one document that is longer. Memory is given back at both ends."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(batch.schema.get_field_index(text)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j
    give_back()


def word_spans(buf: np.ndarray, at: np.ndarray, member: np.ndarray = PLAIN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each document the index of its first word (one more entry at the end)."""
    inside = member[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = at[1:-1]
    cut = cut[(cut > 0) & (cut < len(buf))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span; other seeds give independent hashes.

    A span is read in blocks of eight bytes, each of which is mixed into all bits before the next one: there are no families of
    spans that collide by how they are built, and spans of at most seven bytes never collide with each other.
    """
    size = ends - starts
    blocks = np.zeros((len(buf) + 7) // 8 * 8 + 16, np.uint8)
    blocks[: len(buf)] = buf
    blocks = blocks.view("<u8")

    def block(at: np.ndarray, n: np.ndarray) -> np.ndarray:
        k, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        return (blocks[k] >> shift | blocks[k + 1] << (_U(63) - shift) << _U(1)) & _BLOCK_MASK[np.minimum(n, 8)]

    own = _U(_SEEDS[seed])
    out = block(starts, size)
    short = size < 8
    out[short] |= size[short].astype(np.uint64) << _U(56)
    out = mix(out ^ own)
    out[~short] = mix(out[~short] + size[~short].astype(np.uint64) * own)
    left = np.flatnonzero((size > 8) & (size <= _LONG_SPAN))
    done = 8
    while len(left):
        out[left] = mix((out[left] ^ block(starts[left] + done, size[left] - done)) + own)
        done += 8
        left = left[size[left] > done]
    for k in np.flatnonzero(size > _LONG_SPAN).tolist():
        digest = hashlib.blake2b(buf[starts[k] : ends[k]].tobytes(), digest_size=8, key=bytes([seed])).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive values (n < 1024); entry i is for words[i:i+n]."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words)
    if n <= 6:
        out = words[: size - n + 1].copy()
        for k in range(1, n):
            out *= _U(_WORD_BASE)
            out += words[k : size - n + 1 + k]
        return mix(out)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(words * _pow(_WORD_BASE, size), out=sums[1:], dtype=np.uint64)
    return mix((sums[n:] - sums[:-n]) * _pow(pow(_WORD_BASE, -1, 1 << 64), size - n + 1))


def gram_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Indices of the words at which a run of n words of the same document starts."""
    total = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    return np.flatnonzero(left >= n)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of start, start + 1, .. for each range, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.int64).view(np.uint64)
