"""Exact batch tokenization that encodes each distinct unit of text once per worker.

A unit is a stretch of text that the tokenizer's pre-tokenizer never joins with its neighbours, so the ids of a text are
the ids of its units in a row. Long texts are cut at the same safe boundaries, whatever their length.

* ``lead``: for byte-level tokenizers that glue a space to the word after it: white space and the word that follows.
  A cut is made before ASCII white space only, and never after a non-ASCII white space character, with which it forms one run.
* ``space``: for tokenizers of which no token has a space after another character: spaces and what follows them up to the next one.
* ``drop``: for tokenizers that drop white space: the words between ASCII white space; those that also fold case get
  ASCII letters folded beforehand.

The pre-tokenizers of ``lead`` and ``drop`` part letters from what follows them, so a cut is also made between an ASCII letter and an ASCII
character that is no letter; the bar is left out, as it ends the letters of special strings.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np
import pyarrow as pa

from .textops import PLAIN_WORD, hash_spans, lower_ascii, ranges, resident, word_spans

#: Bytes for units that a worker remembers, unless its encoder has another room; beyond this it starts afresh.
UNIT_BYTES = 12 << 20
_ENCODE_AT_ONCE = 4096

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PARTED = np.zeros(256, bool)
_PARTED[0x21:0x7F] = ~_LETTER[0x21:0x7F]
_PARTED[ord("|")] = False
#: Units of these letters only are one pre-token; the library's model takes them as they are.
_PLAIN = {"lead": re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+"), "drop": re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")}


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabets show a printable Latin-1 byte as itself and the others, in order, from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}


_BYTE_LETTERS = {bytes([b]).decode("latin-1"): c for b, c in _byte_letters().items()}
_BYTE_LETTERS = str.maketrans(_BYTE_LETTERS)


def _after_wide_space(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position is a non-ASCII white space character (fixed values: their UTF-8 forms)."""
    a, b, c = (buf[np.maximum(at - k, 0)] * (at >= k) for k in (3, 2, 1))
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    general = (a == 0xE2) & (((b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    return two | general | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))


def units(buf: np.ndarray, at: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the units, and each document's first unit (one more entry at the end)."""
    if kind == "space":
        first = np.zeros(len(buf) + 1, bool)
        first[1:-1] = (buf[1:] == 0x20) & (buf[:-1] != 0x20)
        first[at] = True
        first[-1] = False
        starts = np.flatnonzero(first)
        return starts, np.append(starts[1:], len(buf)) if len(starts) else starts, np.searchsorted(starts, at)
    parted = np.flatnonzero(_LETTER[buf[:-1]] & _PARTED[buf[1:]]) + 1
    if kind == "drop":
        starts, ends, _ = word_spans(buf, at)
        inner = np.zeros(len(buf) + 1, bool)
        inner[parted] = True
        inner[starts] = False
        inner = np.flatnonzero(inner)
        starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
        return starts, ends, np.searchsorted(starts, at)
    space = ~PLAIN_WORD[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[:-1] = space
    first[1:-1] &= ~space[:-1]
    cuts = np.flatnonzero(first)
    first[cuts[_after_wide_space(buf, cuts)]] = False
    first[parted] = True
    first[at] = True
    first[-1] = False
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(buf)) if len(starts) else starts, np.searchsorted(starts, at)


def _texts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    data = buf.tobytes()
    return [data[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


class UnitEncoder:
    """Encodes with the tokenizers library; special strings inside texts are handled as is its default, or are plain text if literal."""

    def __init__(self, path: str, kind: str, literal: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = literal
        self.kind, self.room = kind, UNIT_BYTES
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = None if any(_PLAIN[kind].search(t) and "|" not in t for t in added) else _PLAIN[kind]
        self._forget()

    def _forget(self) -> None:
        self.keys, self.seconds = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _learn(self, keys: np.ndarray, seconds: np.ndarray, texts: list[str]) -> None:
        """keys: sorted and new; seconds: a second hash of each."""
        each: list[list[int]] = [[]] * len(keys)
        rest = []
        for k, text in enumerate(texts):
            if self.plain and self.plain.fullmatch(text):
                each[k] = self._one(text)
            else:
                rest.append(k)
        for i in range(0, len(rest), _ENCODE_AT_ONCE):
            some = rest[i : i + _ENCODE_AT_ONCE]
            for k, ids in zip(some, self._library([texts[k] for k in some]), strict=True):
                each[k] = ids
        lengths = np.fromiter(map(len, each), np.int32, len(each))
        new = np.fromiter((x for ids in each for x in ids), np.uint32, int(lengths.sum()))
        begin = self._append(new)
        place = np.searchsorted(self.keys, keys)
        self.keys, self.seconds = np.insert(self.keys, place, keys), np.insert(self.seconds, place, seconds)
        self.starts = np.insert(self.starts, place, begin + np.cumsum(lengths, dtype=np.int64) - lengths)
        self.lengths = np.insert(self.lengths, place, lengths)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _one(self, letters: str) -> list[int]:
        if self.kind == "drop":
            letters = unicodedata.normalize("NFC", letters).lower()
        return [t.id for t in self.tokenizer.model.tokenize(letters.encode().decode("latin-1").translate(_BYTE_LETTERS))]

    def _units(self, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if self.kind == "drop" and b"<|" not in buf.tobytes():
            buf = lower_ascii(buf)
        return buf, *units(buf, at, self.kind)

    def _look_up(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ids holds those of each unit: starts, lengths. Units are told apart by 128 bits.

        Units with one first hash and different second ones are encoded each on its own and not remembered.
        """
        hashes, checks = hash_spans(buf, starts, ends), hash_spans(buf, starts, ends, seed=1)
        keys, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) * 28 + self.used * 4 > self.room:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        if not known.all():
            new = one[~known]
            self._learn(keys[~known], checks[new], _texts(buf, starts[new], ends[new]))
            place = np.searchsorted(self.keys, keys)
        place = place[back]
        at, lengths = self.starts[place], self.lengths[place].astype(np.int64)
        for k in np.flatnonzero(self.seconds[place] != checks).tolist():
            ids = self._library(_texts(buf, starts[[k]], ends[[k]]))[0]
            at[k], lengths[k] = self._append(np.array(ids, np.uint32)), len(ids)
        return at, lengths

    def _append(self, ids: np.ndarray) -> int:
        """Where the ids begin."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def counts(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Tokens of each document."""
        buf, starts, ends, first = self._units(buf, at)
        if not len(starts):
            return np.zeros(len(at) - 1, np.int64)
        _, lengths = self._look_up(buf, starts, ends)
        total = np.concatenate([[0], np.cumsum(lengths)])
        return total[first[1:]] - total[first[:-1]]

    def encode(self, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and each document's first id (one more entry at the end)."""
        buf, starts, ends, first = self._units(buf, at)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        at, lengths = self._look_up(buf, starts, ends)
        total = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[ranges(at, lengths)], total[first]


class PieceEncoder(UnitEncoder):
    """Encodes texts that have a space in front with the sentencepiece library, which puts one there itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        pieces = map(self.processor.id_to_piece, range(self.processor.vocab_size()))
        if any(re.search("[^\u2581]\u2581", p) for p in pieces):
            raise ValueError(f"{path}: a piece goes on after a space, so that texts have no units")
        self.kind, self.plain, self.room = "space", None, UNIT_BYTES
        self._forget()

    def _library(self, texts: list[str]) -> list[list[int]]:
        # nothing is put in front of an empty text: a single space at the end of a text stands for itself
        alone = [self.processor.piece_to_id("\u2581")]
        return [ids if ids else alone for ids in self.processor.encode([t[1:] for t in texts], num_threads=1)]


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores


def encoder(path: str, kind: str) -> UnitEncoder:
    """The worker's encoder for a vocabulary file; it outlives tasks."""
    return resident("encoder", (path, kind), lambda: UnitEncoder(path, kind))


def append_id(ids: np.ndarray, first: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with end_id after each document."""
    lengths = np.diff(first)
    out = np.full(len(ids) + len(lengths), end_id, np.uint32)
    new = first + np.arange(len(first))
    out[ranges(new[:-1], lengths)] = ids
    return out, new


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    made = [x.cast(f.type) if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(made, schema=schema)
