"""Benchmark decontamination with a generalised suffix automaton over the words of test items.

Words are runs of letters, digits and non-ASCII characters after A-Z is folded. A window is ``window`` consecutive words of
an item; an item with fewer words (but some) is one window. Document words are streamed through the automaton, which tracks
the length of the longest suffix read so far that occurs in any item; where that length reaches a window's, the words of the
window are hit. Stretches without two neighbouring words that also are neighbours in an item cannot match and are skipped.

Items travel as broadcasts of at most MAX_ITEM_BYTES of text; larger sets are dealt over several automata, and documents
pass through one after the other with their marks written in between. Null texts and items have no words; equal item ids
count once; an item without an id hits words like any other, but is not among a document's items. Repeated rows are judged
each on its own; empty tables give no rows or no hits.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize
from .encoding import as_batch
from .textops import ALNUM_WORD, by_bytes, gram_starts, hash_spans, lower_ascii, ngram_hashes, resident, text_bytes, word_spans

MAX_ITEM_BYTES = 16 << 20

_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()), ("items", pa.list_(pa.string())), ("contaminated", pa.bool_())])


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buf, at = text_bytes(column)
    starts, ends, first = word_spans(buf, at, ALNUM_WORD)
    return hash_spans(lower_ascii(buf), starts, ends), first, starts, ends, at


class SuffixAutomaton:
    """States of all substrings of several word sequences.

    Nearly every state has one move, which is kept in arrays; further ones are in a dict of the state: 70 to 230 bytes a word.
    """

    def __init__(self) -> None:
        self.word, self.to = array("Q", [0]), array("q", [-1])
        self.more: dict[int, dict[int, int]] = {}
        self.link, self.length = array("q", [-1]), array("q", [0])

    def step(self, state: int, w: int) -> int:
        """The state after w, or -1."""
        if self.word[state] == w:
            return self.to[state]
        more = self.more.get(state)
        return more.get(w, -1) if more else -1

    def _move(self, state: int, w: int, to: int) -> None:
        if self.to[state] < 0 or self.word[state] == w:
            self.word[state], self.to[state] = w, to
        else:
            self.more.setdefault(state, {})[w] = to

    def _state(self, length: int, link: int, like: int | None = None) -> int:
        new = len(self.to)
        self.word.append(0 if like is None else self.word[like])
        self.to.append(-1 if like is None else self.to[like])
        if like in self.more:
            self.more[new] = dict(self.more[like])
        self.length.append(length)
        self.link.append(link)
        return new

    def add(self, words: list[int]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _split(self, p: int, w: int, q: int) -> int:
        """The state for the longest suffix of p followed by w, taken out of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(self.length[p] + 1, self.link[q], like=q)
        self.link[q] = twin
        while p >= 0 and self.step(p, w) == q:
            self._move(p, w, twin)
            p = self.link[p]
        return twin

    def _extend(self, last: int, w: int) -> int:
        to = self.step(last, w)
        if to >= 0:
            return self._split(last, w, to)
        new, p = self._state(self.length[last] + 1, 0), last
        while p >= 0 and (to := self.step(p, w)) < 0:
            self._move(p, w, new)
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, to)
        return new

    def matching_lengths(self, words: list[int]) -> list[int]:
        """For each word, the length of the longest substring of the sequences that ends there."""
        out, state, n = [], 0, 0
        step, link, length = self.step, self.link, self.length
        for w in words:
            while (to := step(state, w)) < 0 and state:
                state = link[state]
                n = length[state]
            if to >= 0:
                state, n = to, n + 1
            out.append(n)
        return out


class Index:
    """The automaton of some items, with the items of each window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.ids = [i for i, _ in items]
        words, first, *_ = _words(pa.array([t for _, t in items], pa.string()))
        size = np.diff(first)
        self.automaton = SuffixAutomaton()
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            self.automaton.add(words[a:b].tolist())
        self.windows = {}
        for n in sorted({min(int(s), window) for s in size if s}):
            at = gram_starts(first, n)
            item = np.searchsorted(first, at, "right") - 1
            keep = size[item] >= window if n == window else size[item] == n
            hashes, item = ngram_hashes(words, n)[at[keep]], item[keep]
            order = np.lexsort((item, hashes))
            known, begin = np.unique(hashes[order], return_index=True)
            self.windows[n] = (known, np.append(begin, len(order)), item[order].astype(np.int32))
        pairs = np.unique(ngram_hashes(words, 2)[gram_starts(first, 2)])
        self.pairs, self.maybe = pairs, np.zeros(1 << 20, bool)
        self.maybe[pairs & np.uint64(len(self.maybe) - 1)] = True

    def _pair_mask(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each word, whether it and the next one of its document are neighbours in an item."""
        out = np.zeros(len(words), bool)
        at = gram_starts(first, 2)
        hashes = ngram_hashes(words, 2)[at]
        some = np.flatnonzero(self.maybe[hashes & np.uint64(len(self.maybe) - 1)])
        out[at[some]] = np.isin(hashes[some], self.pairs)
        return out

    def scan(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        """Which words are hit, the matching length at each word (0 where it cannot reach a window) and each document's items."""
        n = len(words)
        reach, hit = np.zeros(n, np.int64), np.zeros(n + 1, np.int64)
        items: list[set[str]] = [set() for _ in first[1:]]
        least = min((k for k in self.windows if k > 1), default=0)
        if least and n:
            edge = np.diff(np.concatenate([[False], self._pair_mask(words, first), [False]]).astype(np.int8))
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
            for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                if b - a >= least:
                    reach[a:b] = self.automaton.matching_lengths(words[a:b].tolist())
        for k, (known, begin, item) in self.windows.items():
            if n < k:
                continue
            at = gram_starts(first, k) if k == 1 else np.flatnonzero(reach >= k) - k + 1
            grams = ngram_hashes(words, k)[at]
            slot = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            found = known[slot] == grams
            at, slot = at[found], slot[found]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + k, -1)
            for d, g in set(zip((np.searchsorted(first, at, "right") - 1).tolist(), slot.tolist(), strict=True)):
                items[d].update(self.ids[i] for i in item[begin[g] : begin[g + 1]].tolist())
        return np.cumsum(hit[:-1]) > 0, reach, items


def _shards(items: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // (MAX_ITEM_BYTES // 2)) or 1
    return [rows] if n == 1 else [rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) for k in range(n)]


def _marked(docs: DataFrame, items: DataFrame, window: int, item_id: str, item_text: str, text: str) -> DataFrame:
    """docs with columns 0, 1, .. renamed to c0, c1, .., and hits (a byte for each word), longest, items."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    k_text = docs.columns.index(text)
    schema = T.StructType([*plain.schema, T.StructField("hits", T.BinaryType()), T.StructField("longest", T.LongType()), T.StructField("items", T.ArrayType(T.StringType()))])
    sc = docs.sparkSession.sparkContext
    shards = _shards(items, item_id, item_text)
    for turn, shard in enumerate(shards):
        key = uuid.uuid4().hex
        sent = sc.broadcast([(r.id, r.text) for r in shard.collect()])  # at most MAX_ITEM_BYTES, see _shards

        def run(batches: Iterator[pa.RecordBatch], sent=sent, key=key, turn=turn) -> Iterator[pa.RecordBatch]:
            index = resident("items", key, lambda: Index(sent.value, window))
            for batch in by_bytes(batches, f"c{k_text}"):
                words, first, *_ = _words(batch.column(k_text))
                hit, reach, found = index.scan(words, first)
                longest = np.array([reach[a:b].max(initial=0) for a, b in zip(first[:-1], first[1:], strict=True)], np.int64)
                if turn:
                    before = batch.column(len(batch.columns) - 3).to_pylist()
                    hit = hit | np.frombuffer(b"".join(before), bool)
                    longest = np.maximum(longest, batch.column(len(batch.columns) - 2).to_numpy())
                    found = [a | set(b) for a, b in zip(found, batch.column(len(batch.columns) - 1).to_pylist(), strict=True)]
                cut = first.tolist()
                own = [pa.array([hit[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()), pa.array(longest), pa.array([sorted(s - {None}) for s in found], pa.list_(pa.string()))]
                kept = [batch.column(i) for i in range(batch.num_columns - 3 * bool(turn))]
                yield pa.RecordBatch.from_arrays(kept + own, [f.name for f in schema])

        plain = plain.mapInArrow(run, schema)
        if turn + 1 < len(shards):
            plain = materialize(plain, "decontaminate")
    return plain


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 13, coverage: float = 0.05, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, longest (matching length), items (sorted as strings), contaminated for docs(doc_id, text).

    A document is contaminated if it has hits and at least that share of its words is hit.
    """
    marked = _marked(docs.select("doc_id", "text"), items, window, item_id, item_text, "text")
    lines = marked.select("c0", "hits", "longest", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [np.frombuffer(x, np.uint8) for x in batch.column(1).to_pylist()]
            n_words, n_hit = np.array([len(x) for x in hits]), np.array([int(x.sum()) for x in hits])
            yield as_batch({"doc_id": batch.column(0), "n_words": n_words, "n_hit": n_hit, "longest": batch.column(2), "items": batch.column(3), "contaminated": _over(n_hit, n_words, coverage)}, _FOUND)

    return lines.mapInArrow(run, "doc_id long, n_words long, n_hit long, longest long, items array<string>, contaminated boolean")


def _over(n_hit: np.ndarray, n_words: np.ndarray, coverage: float) -> np.ndarray:
    share = Fraction(str(coverage))
    return (n_hit > 0) & (n_hit * share.denominator >= n_words * share.numerator)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, coverage: float = 0.05, span: int | None = None, item_id: str = "item_id", item_text: str = "text", text: str = "text") -> DataFrame:
    """The same columns without contaminated documents; from the others, hit spans of more than span words are cut out (None: none).

    Documents without such spans keep their text as it is.
    """
    marked = _marked(docs, items, window, item_id, item_text, text)
    k_text = docs.columns.index(text)
    names = [f"c{k}" for k in range(len(docs.columns))]
    schema = T.StructType([marked.schema[n] for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [np.frombuffer(x, np.uint8) for x in batch.column(len(names)).to_pylist()]
            n_hit = np.array([int(x.sum()) for x in hits])
            keep = ~_over(n_hit, np.array([len(x) for x in hits]), coverage)
            columns = [batch.column(i) for i in range(len(names))]
            if span is not None and (keep & (n_hit > span)).any():
                columns[k_text] = pa.array([_cut(t, h, span) if k and n > span else t for t, h, k, n in zip(columns[k_text].to_pylist(), hits, keep, n_hit, strict=True)], columns[k_text].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    return marked.mapInArrow(run, schema).toDF(*docs.columns)


def _cut(text: str, hit: np.ndarray, span: int) -> str:
    buf, at = text_bytes(pa.array([text]))
    starts, ends, _ = word_spans(buf, at, ALNUM_WORD)
    edge = np.diff(np.concatenate([[0], hit, [0]]).astype(np.int8))
    out, last, data = [], 0, buf.tobytes()
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        if b - a > span:
            out.append(data[last : starts[a]])
            last = ends[b - 1]
    return b"".join([*out, data[last:]]).decode()
