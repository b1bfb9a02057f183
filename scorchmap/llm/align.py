"""Which tokens of one tokenizer cover the same bytes as which tokens of another one.

A document is encoded by A (a byte-level BPE of the tokenizers library, special strings as plain text) with a space in front, and by
B (a sentencepiece model, which puts one there itself). Both say how many bytes of the text each token stands for. Byte offsets at
which tokens of both end are shared cuts; what lies between two of them next to each other is a group.

Groups are found by divide and conquer, for all documents of a batch level by level: an interval between two shared cuts is split at
a shared cut near its middle, which is looked for from A's middle token outwards by bisecting B's ends; both halves are then treated
in the same way. An interval that has no cut inside, or only one token of A or of B, is a leaf: a group.

A's and B's tokens whose byte ranges overlap are linked. For each pair of ids, the number of documents of the whole table that hold it
linked is counted; a link is best if that count is the greatest that its A id has with any B id.

A text that is null or empty, or that a tokenizer does not give back byte by byte (normalised characters), has no tokens: zeros
and no groups. Each row is a document, repeated rows too; a null doc_id is kept. An empty table gives no rows; further columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, release
from .encoding import _BYTE_LETTERS, PieceEncoder, UnitEncoder, as_batch
from .textops import by_bytes, give_back, ranges, resident, text_bytes

#: Pairs of ids, those of most documents first, whose counts are sent to all tasks (16 bytes each); others are joined by shuffling.
MAX_PAIRS = 1 << 21
#: Text in a batch: what is made of it stays in the caches of a core.
BATCH_BYTES = 1 << 18
#: For the units of each of both encoders that a worker remembers.
UNIT_BYTES = 64 << 20
#: Counts that a task adds up before they are shuffled.
_HELD = 1 << 20


@dataclass
class Spelling:
    """The bytes of each token of a vocabulary, and its id in decimal digits."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Spelling:
        length = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(length) - length, length)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.start[ids], self.length[ids])]


class Aligner:
    """Both encoders of a worker, and what their tokens stand for."""

    def __init__(self, a: str, b: str):
        self.a, self.b = UnitEncoder(a, "lead", literal=True), PieceEncoder(b)
        self.a.room = self.b.room = UNIT_BYTES
        byte = {c: k.encode("latin-1") for k, c in ((chr(k), v) for k, v in _BYTE_LETTERS.items())}
        size = self.a.tokenizer.get_vocab_size()
        said = [self.a.tokenizer.id_to_token(k) or "" for k in range(size)]
        self.a_bytes = Spelling.of([b"".join(byte.get(c, c.encode()) for c in t) for t in said])
        sp = self.b.processor
        self.b_bytes = Spelling.of([bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode() for k in range(sp.vocab_size())])
        self.digits = Spelling.of([str(k).encode() for k in range(max(size, sp.vocab_size()))])

    def tokens(self, column: pa.Array) -> Tokens:
        buf, at = text_bytes(column)
        some = np.flatnonzero(np.diff(at))
        spaced = np.full(len(buf) + len(some), 0x20, np.uint8)
        begin = np.cumsum(np.diff(at)[some]) - np.diff(at)[some] + np.arange(len(some))
        spaced[ranges(begin + 1, np.diff(at)[some])] = buf
        begin = np.append(begin, len(spaced))
        whole, sides = np.ones(len(some), bool), []
        for encoder, spelling in ((self.a, self.a_bytes), (self.b, self.b_bytes)):
            ids, first = encoder.encode(spaced, begin)
            whole &= _gives_back(spaced, begin, ids, first, spelling)
            sides.append((ids, first, spelling))
        kept = np.flatnonzero(whole)
        sizes, out = np.diff(begin)[kept], []
        offset = np.cumsum(sizes) - sizes  # of each kept text, one after the other
        for ids, first, spelling in sides:
            n = np.diff(first)[kept]
            ids = ids[ranges(first[kept], n)].astype(np.int64)
            out += [ids, np.cumsum(spelling.length[ids]), np.concatenate([[0], np.cumsum(n)])]
        return Tokens(len(column), some[kept], offset, *out)


def _gives_back(buf: np.ndarray, at: np.ndarray, ids: np.ndarray, first: np.ndarray, spelling: Spelling) -> np.ndarray:
    """Whether the tokens of each text, joined, are its bytes."""
    ends = np.concatenate([[0], np.cumsum(spelling.length[ids])])[first]
    same = np.diff(ends) == np.diff(at)
    fit = np.flatnonzero(same)
    size = np.diff(at)[fit]
    differ = spelling.joined(ids)[ranges(ends[fit], size)] != buf[ranges(at[fit], size)]
    wrong = np.concatenate([[0], np.cumsum(differ)])[np.concatenate([[0], np.cumsum(size)])]
    same[fit] = np.diff(wrong) == 0
    return same


@dataclass
class Tokens:
    """Both tokenizations of the texts of a batch that have tokens: ids, byte ends and each text's first token (one more entry at the end)."""

    rows: int
    doc: np.ndarray  # the row of each text
    offset: np.ndarray
    a: np.ndarray
    a_ends: np.ndarray
    a_first: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    b_first: np.ndarray

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The first tokens of A and of B of each group, in order."""
        a0, a1, b0, b1 = self.a_first[:-1], self.a_first[1:], self.b_first[:-1], self.b_first[1:]
        leaves = []
        while len(a0):
            cut_a, cut_b = self._cut(a0, a1, b0, b1)
            leaf = cut_a < 0
            leaves.append((a0[leaf], b0[leaf]))
            a0, a1, b0, b1, i, j = (x[~leaf] for x in (a0, a1, b0, b1, cut_a, cut_b))
            a0, a1, b0, b1 = (np.concatenate(x) for x in ((a0, i), (i, a1), (b0, j), (j, b1)))
        to = np.full(len(self.a), -1)
        for a, b in leaves:
            to[a] = b
        a = np.flatnonzero(to >= 0)
        return a, to[a]

    def _cut(self, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each interval, the tokens of A and B that follow its shared cut nearest to the middle (-1: it has none inside)."""
        cut_a, cut_b = np.full(len(a0), -1), np.full(len(a0), -1)
        open_ = np.flatnonzero((a1 - a0 > 1) & (b1 - b0 > 1))
        middle = (a0 + a1 - 2) >> 1
        place, hit = self._shared(middle[open_])
        cut_a[open_[hit]], cut_b[open_[hit]] = middle[open_[hit]] + 1, place[hit] + 1
        open_, near, far = open_[~hit], 1, 4  # tokens from near to less than far away from the middle are looked at
        while True:
            open_ = open_[np.maximum(middle[open_] - a0[open_], a1[open_] - 2 - middle[open_]) >= near]
            if not len(open_):
                return cut_a, cut_b
            m, best = middle[open_], np.full(len(open_), far)
            for low, high in ((np.maximum(m - far + 1, a0[open_]), m - near), (m + near, np.minimum(m + far - 1, a1[open_] - 2))):
                n = np.maximum(high - low + 1, 0)
                token, own = ranges(low, n), np.repeat(np.arange(len(open_)), n)
                place, hit = self._shared(token)
                token, place, own = token[hit], place[hit], own[hit]
                away = np.abs(token - m[own])
                order = np.argsort(-away, kind="stable")  # of several cuts of an interval the nearest is written last
                order = order[away[order] < best[own[order]]]
                token, place, own = token[order], place[order], own[order]
                cut_a[open_[own]], cut_b[open_[own]], best[own] = token + 1, place + 1, away[order]
            open_, near, far = open_[best == far], far, 4 * far

    def _shared(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For tokens of A, the token of B that a bisection of B's ends comes to, and whether both end together."""
        place = np.minimum(np.searchsorted(self.b_ends, self.a_ends[token]), max(0, len(self.b_ends) - 1))
        return place, self.b_ends[place] == self.a_ends[token]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked tokens of A and of B, and each text's first link. Between two ends next to each other lies one pair of tokens."""
        size = int(self.a_ends[-1]) if len(self.a_ends) else 0
        marks = np.zeros((2, size + 1), bool)
        marks[0, self.a_ends], marks[1, self.b_ends] = True, True
        ends = np.flatnonzero(marks[0] | marks[1])
        a, b = (np.cumsum(m)[ends] - m[ends] for m in marks)  # tokens that end before
        return a, b, np.searchsorted(ends, np.append(self.offset, size), "right")

    def written(self, a0: np.ndarray, b0: np.ndarray, digits: Spelling) -> list[str]:
        """The groups of each row: ids of A, a bar, ids of B, with commas between ids and semicolons between groups."""
        texts = [""] * self.rows
        if not len(a0):
            return texts
        na, nb = np.diff(np.append(a0, len(self.a))), np.diff(np.append(b0, len(self.b)))
        both = np.concatenate([self.a, self.b])
        size = np.stack([na, nb], 1).ravel()
        ids = both[ranges(np.stack([a0, len(self.a) + b0], 1).ravel(), size)]
        length = digits.length[ids]
        ends = np.cumsum(length + 1)
        out = np.full(int(ends[-1]), ord(","), np.uint8)
        out[ranges(ends - 1 - length, length)] = digits.joined(ids)
        closes = ends[np.cumsum(size) - 1] - 1
        out[closes[0::2]], out[closes[1::2]] = ord("|"), ord(";")
        data = out.tobytes()
        cut = np.append(ends, 0)[(self.a_first + self.b_first)[1:] - 1]
        for k, begin, end in zip(self.doc.tolist(), [0, *cut[:-1].tolist()], cut.tolist(), strict=True):
            texts[k] = data[begin : end - 1].decode()
        return texts


def aligner(a: str, b: str) -> Aligner:
    """The worker's encoders; they outlive tasks."""
    return resident("aligner", (a, b), lambda: Aligner(a, b))


def _pairs(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of linked ids (A's times 2^32 plus B's) and each text's first one."""
    a, b, first = tokens.links()
    return tokens.a[a] << 32 | tokens.b[b], first


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different values, and how often each is there."""
    x = np.sort(x)
    new = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[new], np.diff(np.append(new, len(x)))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pair, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    return pair[new], np.add.reduceat(n, new) if len(pair) else n


def pair_counts(docs: DataFrame, a: str, b: str) -> DataFrame:
    """pair, n: in how many documents each pair of ids is linked."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            pair, first = _pairs(aligner(a, b).tokens(batch.column(0)))
            # the pairs of the batch by their places among its different ones, so that a document and a pair make one number
            some = _counted(pair)[0]
            key = np.repeat(np.arange(len(first) - 1) * len(some), np.diff(first)) + np.searchsorted(some, pair)
            place, n = _counted(_counted(key)[0] % max(1, len(some)))
            held.append((some[place], n))
            if sum(len(p) for p, _ in held) >= _HELD:
                held = [_added(held)]
                if len(held[0][0]) >= _HELD // 2:
                    yield as_batch(dict(zip(("pair", "n"), held.pop(), strict=True)), schema)
        if held:
            yield as_batch(dict(zip(("pair", "n"), _added(held), strict=True)), schema)
        del held
        give_back()

    return docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


_OUT = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum and groups (see Tokens.written()) of each row of docs(doc_id, text).

    a: a tokenizers .json file; b: a sentencepiece .model file, both readable on every worker. Texts are encoded twice, once to count
    pairs; only counts are shuffled.
    """
    counts = materialize(pair_counts(docs, a, b), "pair-counts")
    some = counts.orderBy(F.desc("n"), "pair").limit(MAX_PAIRS).toArrow()  # at most 16 bytes times MAX_PAIRS
    pair, n = (some.column(k).to_numpy() for k in range(2))
    order = np.argsort(pair)
    a_id = F.shiftright("pair", 32)
    best = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("n")).toArrow()  # at most A's vocabulary
    most = np.zeros(int(max(best.column(0).to_pylist(), default=0)) + 1, np.int64)
    most[best.column(0).to_numpy()] = best.column(1).to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast((pair[order], n[order], most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, number, most = sent.value
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            own = aligner(a, b)
            tokens = own.tokens(batch.column(1))
            a0, b0 = tokens.groups()
            pair, first = _pairs(tokens)
            place = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
            known = keys[place] == pair if len(keys) else np.zeros(len(pair), bool)
            count = np.where(known, number[place] if len(keys) else 0, 0)
            is_best = known & (count == most[pair >> 32]) if len(pair) else known

            def per_row(x: np.ndarray, cut: np.ndarray) -> np.ndarray:
                out = np.zeros(batch.num_rows, np.int64)
                out[tokens.doc] = np.diff(np.concatenate([[0], np.cumsum(x)])[cut])
                return out

            group_first = np.searchsorted(a0, tokens.a_first)
            ones = np.ones(max(len(tokens.a), len(pair), len(tokens.b)), np.int64)
            pairs, times = [[]] * batch.num_rows, [[]] * batch.num_rows
            if not known.all():
                for k, x, y in zip(tokens.doc.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                    pairs[k], times[k] = np.unique(pair[x:y][~known[x:y]], return_counts=True)
            yield as_batch(
                {
                    "doc_id": batch.column(0),
                    "n_a": per_row(ones[: len(tokens.a)], tokens.a_first),
                    "n_b": per_row(ones[: len(tokens.b)], tokens.b_first),
                    "n_groups": per_row(ones[: len(a0)], group_first),
                    "n_links": per_row(ones[: len(pair)], first),
                    "n_best": per_row(is_best, first),
                    "count_sum": per_row(count, first),
                    "groups": tokens.written(a0, b0, own.digits),
                    "pairs": pairs,
                    "times": times,
                },
                _OUT,
            )

    names = [f.name for f in _OUT if f.name not in ("pairs", "times")]
    schema = ", ".join(f"{n} {'string' if n == 'groups' else 'long'}" for n in names) + ", pairs array<long>, times array<long>"
    out = docs.select("doc_id", "text").mapInArrow(run, schema)
    if len(pair) < MAX_PAIRS or counts.count() <= len(pair):
        release(counts)
        return out.select(*names)
    # pairs of fewer documents than any that were sent
    out = materialize(out.withColumn("row", F.monotonically_increasing_id()), "aligned")
    rest = out.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    of_a = F.broadcast(counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most")))
    found = rest.join(counts, "pair").join(of_a, F.shiftright("pair", 32) == F.col("a"))
    more = found.groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("b"), F.sum(F.col("n") * F.col("times")).alias("c"))
    added = {"n_best": F.col("n_best") + F.coalesce("b", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("c", F.lit(0))}
    return out.join(more, "row", "left").withColumns(added).select(*names)
