"""Toxicity by the nearest labelled examples: exact TF-IDF cosine search in a block-max inverted index.

The model is fitted on at most EXAMPLES_A_CLASS labelled documents of each class (those with the least hash of the doc_id);
each weighs as many of its class as the sample leaves out, in votes and in the isotonic fit, but is one neighbour. Terms are all
lower-case words of all examples. A vector has (1 + log tf) * idf for each term, times up to 1 + STRENGTH for terms whose share among
toxic examples differs from that among the others, by how sure that is (chi-square); it is brought to length one. Words that
no example has count in the length of a scored text, so cosines are those of whole texts: 1 for a copy of an example.

Equal vectors are one entry of the index. A term has a posting list of the entries that hold it with their weights; entries are dealt
into blocks of alike vectors, and a term knows its greatest weight in each block that it is in, so that the sum of query weight times
greatest weight bounds the cosine with any entry of a block. Blocks whose bound cannot beat the k-th best so far are passed over: the
search is exact. Posting lists of terms that a sixteenth of the entries hold are kept as columns of a matrix, the others as lists.

The cosine-weighted vote of the neighbours is made a probability by an isotonic fit to the votes that examples get from the
others. A document that shares no word with any example (an empty or null text too) gets the share of toxic ones among examples
without words, drawn towards the share among all.

Repeated rows are scored each on its own, and are one example; of several labels of a document the greatest counts. With no labels
of a class every score is that share; an empty table gives no rows. A document with a null doc_id is never an example, nor held
out. Further columns are ignored by score() and kept by reject_toxic().
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize
from .encoding import as_batch
from .textops import ALNUM_WORD, by_bytes, give_back, hash_spans, lower_ascii, ranges, signed, text_bytes, unsigned, word_spans

EXAMPLES_A_CLASS = 4_000
NEIGHBOURS = 15
_BLOCK = 64
#: How much more telling words weigh at most, the chi-square at which they get half of it, and the ratio of shares (in bits) that gets all.
STRENGTH, _SURE, _BITS = 8.0, 25.0, 5.0
#: Terms that so many of all entries hold are columns of a matrix.
_HEAD = 1 / 16
#: Texts that are searched for at once; blocks after which bounds are compared with what has been found anew.
_QUERIES, _BLOCKS = 64, 16
#: Bytes of text in a batch.
_BATCH_BYTES = 1 << 18
#: Cosines that are so close count as equal.
_TIED = 1e-9
#: Weight of the prior in a vote, in neighbours of cosine 1/2.
_PRIOR = 0.25


def held_out(doc_id: str = "doc_id", folds: int = 5):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def _term_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term hash and count of each different word of each document."""
    buf, at = text_bytes(column)
    starts, ends, first = word_spans(buf, at, ALNUM_WORD)
    words = hash_spans(lower_ascii(buf), starts, ends)
    doc = np.repeat(np.arange(len(column)), np.diff(first))
    order = np.lexsort((words, doc))
    words, doc = words[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])])) if len(words) else order
    return doc[new], words[new], np.diff(np.append(new, len(words)))


@dataclass
class Vectors:
    """Rows of term numbers and weights, one after the other; first: where each row begins, and the end of the last one."""

    terms: np.ndarray
    weights: np.ndarray
    first: np.ndarray

    def row(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        return self.terms[self.first[k] : self.first[k + 1]], self.weights[self.first[k] : self.first[k + 1]]

    def some(self, rows: np.ndarray) -> Vectors:
        n = np.diff(self.first)[rows]
        at = ranges(self.first[rows], n)
        return Vectors(self.terms[at], self.weights[at], np.concatenate([[0], np.cumsum(n)]))


def _told_apart(ones: np.ndarray, zeros: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """1 for terms that both classes of examples hold alike, up to 1 + STRENGTH for those that surely tell them apart."""
    p, q, both = ones / n1, zeros / n0, (ones + zeros) / (n1 + n0)
    chi2 = (p - q) ** 2 / (both * (1 - both) + 1e-12) * (n1 * n0 / (n1 + n0))
    bits = np.abs(np.log2((ones + 0.5) / (n1 + 0.5)) - np.log2((zeros + 0.5) / (n0 + 0.5)))
    return 1 + STRENGTH * chi2 / (chi2 + _SURE) * np.minimum(bits, _BITS) / _BITS


@dataclass
class Index:
    """Block-max posting lists of the entries; numbers of entries and places take 32 bits."""

    entries: Vectors  # only where the index is made: no search reads them, and they are not sent to tasks
    size: int  # of the vocabulary

    def __getstate__(self) -> dict:
        return {k: x for k, x in self.__dict__.items() if k != "entries"}

    def __post_init__(self) -> None:
        v, n = self.entries, len(self.entries.first) - 1
        self.n, self.blocks = n, -(-n // _BLOCK)
        entry = np.repeat(np.arange(n, dtype=np.int32), np.diff(v.first))
        held = np.bincount(v.terms, minlength=self.size)
        head = np.flatnonzero(held > max(_HEAD * n, 1))
        self.column = np.full(self.size, -1, np.int32)
        self.column[head] = np.arange(len(head))
        common = self.column[v.terms] >= 0
        self.head = np.zeros((self.blocks * _BLOCK, len(head)))
        self.head[entry[common], self.column[v.terms[common]]] = v.weights[common]
        self.head_peaks = self.head.reshape(self.blocks, _BLOCK, len(head)).max(axis=1) if n else np.zeros((0, len(head)))
        order = np.flatnonzero(~common)
        order = order[np.argsort(v.terms[order], kind="stable")]  # by term, then entry
        term, self.entry, self.weight = v.terms[order], entry[order], v.weights[order]
        del common, entry, order
        places = np.arange(self.size + 1, dtype=term.dtype)
        self.first = np.searchsorted(term, places).astype(np.int32)
        block = self.entry // _BLOCK
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        new = np.flatnonzero(new)
        self.peak_block, self.peak = block[new], np.maximum.reduceat(self.weight, new) if len(new) else self.weight
        self.peak_first = np.searchsorted(term[new], places).astype(np.int32)

    def _spread(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, first: np.ndarray, to: np.ndarray, value: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        """Sums of query weight times value over the lists of all terms, by query and what the lists lead to."""
        n = first[term + 1] - first[term]
        at = ranges(first[term], n)
        return np.bincount(np.repeat(doc, n) * shape[1] + to[at], np.repeat(weight, n) * value[at], shape[0] * shape[1]).reshape(shape)

    def search(self, queries: Vectors, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Cosines of all queries with all entries, exact for those that are among the k nearest or as near (else they may be -1), and the
        cosine of the k-th nearest entry of each.
        """
        n = len(queries.first) - 1
        doc, cosines = np.repeat(np.arange(n), np.diff(queries.first)), np.full((n, self.blocks * _BLOCK), -1.0)
        common = self.column[queries.terms] >= 0
        wide = np.zeros((n, self.head.shape[1]))
        wide[doc[common], self.column[queries.terms[common]]] = queries.weights[common]
        rare = (doc[~common], queries.terms[~common], queries.weights[~common])
        tail = self._spread(*rare, self.first, self.entry, self.weight, (n, self.blocks * _BLOCK))
        bound = wide @ self.head_peaks.T + self._spread(*rare, self.peak_first, self.peak_block, self.peak, (n, self.blocks)) + _TIED
        least = np.full(n, -1.0)

        def look(rows: np.ndarray, b: int) -> None:
            own = slice(b * _BLOCK, (b + 1) * _BLOCK)
            cosines[rows, own] = wide[rows] @ self.head[own].T + tail[rows, own]
            cosines[rows, self.n :] = -1
            bound[rows, b] = -2

        def kth() -> None:
            if self.n > k:
                least[:] = np.partition(cosines[:, : self.n], self.n - k, axis=1)[:, self.n - k]

        best = bound.argmax(axis=1)
        for b in np.unique(best).tolist():
            look(np.flatnonzero(best == b), b)
        kth()
        for done, b in enumerate(np.argsort(-bound.max(axis=0), kind="stable").tolist()):
            rows = np.flatnonzero(bound[:, b] >= least - _TIED)
            if len(rows):
                look(rows, b)
            if done % _BLOCKS == _BLOCKS - 1:
                kth()
        kth()
        return cosines[:, : self.n], least


@dataclass
class Model:
    terms: np.ndarray
    weight: np.ndarray
    unknown: float  # weight of a word that no example has
    prior: float
    index: Index | None
    keys: np.ndarray
    ones: np.ndarray
    alls: np.ndarray
    heads: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def vectors(self, column: pa.Array) -> Vectors:
        """Known terms and weights of each document, of a vector of length one with its unknown ones."""
        doc, term, count = _term_counts(column)
        place = np.minimum(np.searchsorted(self.terms, term), max(0, len(self.terms) - 1))
        known = self.terms[place] == term if len(self.terms) else np.zeros(len(term), bool)
        weight = (1 + np.log(count)) * np.where(known, self.weight[place] if len(self.terms) else 0.0, self.unknown)
        length = np.sqrt(np.bincount(doc, weight * weight, len(column)))
        return Vectors(place[known].astype(np.int32), (weight / length[doc])[known], np.searchsorted(doc[known], np.arange(len(column) + 1)))

    def votes(self, queries: Vectors, skip: np.ndarray | None = None, toxic: np.ndarray | None = None, mass: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vote, the best entry (-1: none shares a word) and its cosine of each query. skip: the queries are these entries, of which
        queries has the vectors, and one example of each is left out.
        """
        n = len(queries.first) - 1 if skip is None else len(skip)
        value, entry, cosine = np.full(n, self.prior), np.full(n, -1), np.zeros(n)
        step = _QUERIES if skip is None else _QUERIES // 4  # less room in the driver
        for a in range(0, n if self.index else 0, step):
            rows = np.arange(a, min(n, a + step))
            near, least = self.index.search(queries.some(rows if skip is None else skip[rows]), NEIGHBOURS + (skip is not None))
            for k, own, low in zip(rows.tolist(), near, least.tolist(), strict=True):
                found = np.flatnonzero(own >= max(low - _TIED, 1e-12))
                if not len(found):
                    continue
                c = own[found]
                order = np.lexsort((self.keys[found], -np.round(c / _TIED)))
                found, c = found[order], c[order]
                left = self.heads[found] - (found == skip[k] if skip is not None else 0)
                enough = np.searchsorted(np.cumsum(left), NEIGHBOURS)
                if enough < len(found):
                    some = c >= c[enough] - _TIED
                    found, c, left = found[some], c[some], left[some]
                ones, alls = self.ones[found].copy(), self.alls[found].copy()
                if skip is not None:
                    ones[found == skip[k]] -= toxic[k]
                    alls[found == skip[k]] -= mass[k]
                share = np.minimum(left, NEIGHBOURS) / np.maximum(self.heads[found] if skip is None else left, 1)
                near_by = c * c / (1.05 - c) * share
                value[k] = ((near_by * ones).sum() + _PRIOR * self.prior) / ((near_by * alls).sum() + _PRIOR)
                entry[k], cosine[k] = found[0], c[0]
        return value, entry, cosine

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        x, y = self.steps
        fitted = np.interp(votes, x, y) if len(x) else votes
        return np.clip(0.98 * fitted + 0.02 * votes, 0.0, 1.0)

    def scores(self, column: pa.Array) -> tuple[np.ndarray, list[int | None], np.ndarray]:
        queries = self.vectors(column)
        keys = [t.tobytes() + w.tobytes() for t, w in map(queries.row, range(len(column)))]
        first = list(dict.fromkeys(keys))  # equal texts are looked for once
        at = {k: j for j, k in enumerate(first)}
        one = np.zeros(len(first), np.int64)
        back = np.array([at[k] for k in keys], np.int64)
        one[back] = np.arange(len(keys))
        votes, entry, cosine = (x[back] for x in self.votes(queries.some(one)))
        best = [int(self.keys[e]) if e >= 0 else None for e in entry.tolist()]
        return np.where(entry >= 0, self.calibrated(votes), self.prior), best, cosine


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weighted non-decreasing fit of y to x, at the middle of each level."""
    order = np.argsort(x, kind="stable")
    levels: list[list[float]] = []
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        levels.append([b * c, c, a * c])
        while len(levels) > 1 and levels[-2][0] * levels[-1][1] >= levels[-1][0] * levels[-2][1]:
            last = levels.pop()
            levels[-1] = [p + q for p, q in zip(levels[-1], last, strict=True)]
    s = np.array(levels).reshape(-1, 3)
    return s[:, 2] / s[:, 1], s[:, 0] / s[:, 1]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", examples_a_class: int = EXAMPLES_A_CLASS) -> Model:
    """labels: doc_id and label (0/1; nulls are left out). Give it the training rows only."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    some = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples_a_class) for c in (0, 1)]
    sample = some[0].unionByName(some[1])  # at most 2 * examples_a_class ids
    examples = materialize(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id", "text"]), "examples")
    n = {r.label: r["count"] for r in examples.groupBy("label").count().collect()}
    if len(n) < 2:
        none = np.zeros(0)
        return Model(np.zeros(0, np.uint64), none, 1.0, float(min(n, default=0)), None, np.zeros(0, np.int64), none, none, np.zeros(0, np.int64), (none, none))
    stands = {c: totals[c] / n[c] for c in (0, 1)}
    mean = sum(totals.values()) / sum(n.values())
    counts = pa.schema([("term", pa.int64()), ("ones", pa.int64()), ("zeros", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            doc, term, _ = _term_counts(batch.column(1))
            one = batch.column(2).to_numpy()[doc] == 1
            terms, back = np.unique(term, return_inverse=True)
            ones = np.bincount(back, one, len(terms)).astype(np.int64)
            yield as_batch({"term": signed(terms), "ones": ones, "zeros": np.bincount(back, minlength=len(terms)) - ones}, counts)

    found = examples.select("doc_id", "text", "label").mapInArrow(count, "term long, ones long, zeros long").groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).toArrow()  # the words of the examples
    terms, ones, zeros = unsigned(found.column("term").to_numpy()), found.column("ones").to_numpy(), found.column("zeros").to_numpy()
    order = np.argsort(terms)
    terms, ones, zeros = terms[order], ones[order], zeros[order]
    total, df = totals[0] + totals[1], ones * stands[1] + zeros * stands[0]
    none = np.zeros(0)
    idf = lambda df: np.log((total + 1) / (df + 1)) + 1
    model = Model(terms, idf(df) * _told_apart(ones, zeros, n[1], n[0]), float(idf(0)), 0.0, None, np.zeros(0, np.int64), none, none, np.zeros(0, np.int64), (none, none))
    del found, order, df, ones, zeros
    texts = examples.select("doc_id", "text", "label")  # at most 2 * examples_a_class texts
    return _indexed(model, _rows(model, texts.toArrow().to_batches()), {c: stands[c] / mean for c in (0, 1)}, totals[1] / total)


def _rows(model: Model, batches: list[pa.RecordBatch]) -> list[tuple]:
    """Terms, weights, doc_id, label of each example: alike vectors near each other, equal ones in a row."""
    rows = []
    for b in by_bytes(iter(batches)):
        v = model.vectors(b.column(1))
        for k, (key, label) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)):
            rows.append((*v.row(k), key, label))
    # big-endian bytes are in the order of the numbers, and take a tenth of the room of lists of them
    rows.sort(key=lambda r: (r[0][np.argsort(-r[1], kind="stable")[:4]].tolist(), r[0].astype(">i4").tobytes(), r[1].astype(">f8").tobytes(), r[2], r[3]))
    return rows


def _indexed(model: Model, rows: list[tuple], stands: dict[int, float], share: float) -> Model:
    """rows: as _rows() gives them; stands: each label's weight, 1 on average; share: of toxic ones among all labelled documents.

    The driver holds few copies of all vectors at a time.
    """
    none = [r for r in rows if not len(r[0])]
    mass = {c: stands[c] * sum(r[3] == c for r in none) for c in (0, 1)}
    model.prior = (mass[1] + share) / (mass[0] + mass[1] + 1)
    made: list[list] = []
    for terms, weights, key, label in rows:
        if len(terms):
            if not (made and np.array_equal(made[-1][4], terms) and np.array_equal(made[-1][5], weights)):
                made.append([key, 0.0, 0.0, 0, terms, weights])
            e = made[-1]
            e[0] = min(e[0], key)
            e[1] += label * stands[label]
            e[2] += stands[label]
            e[3] += 1
    model.keys, model.heads = np.array([e[0] for e in made], np.int64), np.array([e[3] for e in made], np.int64)
    model.ones, model.alls = np.array([e[1] for e in made]), np.array([e[2] for e in made])
    if not made:
        return model
    vectors = Vectors(np.concatenate([e[4] for e in made]), np.concatenate([e[5] for e in made]), np.concatenate([[0], np.cumsum([len(e[4]) for e in made])]))
    del rows, made, none, terms, weights, e
    give_back()
    model.index = Index(vectors, len(model.terms))
    give_back()
    # what each kind of example is told by the others
    entry, label = np.repeat(np.arange(len(model.keys)), 2), np.tile([1, 0], len(model.keys))
    weight = np.where(label == 1, model.ones[entry], model.alls[entry] - model.ones[entry])
    some = weight > 1e-12
    entry, label, weight = entry[some], label[some], weight[some]
    own = np.array([stands[c] for c in label.tolist()])
    votes = model.votes(vectors, entry, own * label, own)[0]
    model.steps = _isotonic(votes, label.astype(float), weight)
    give_back()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, evidence (nearest example's doc_id), evidence_cosine for each row of docs(doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the examples
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("evidence", pa.int64()), ("evidence_cosine", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=_BATCH_BYTES):
            scores, best, cosine = sent.value.scores(batch.column(1))
            yield as_batch({"doc_id": batch.column(0), "score": scores, "predicted": (scores >= 0.5).astype(np.int32), "evidence": best, "evidence_cosine": cosine}, schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, evidence long, evidence_cosine double")


def reject_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of docs with a score below 0.5, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    k_text = docs.columns.index(text)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, f"c{k_text}", _BATCH_BYTES):
            yield batch.filter(pa.array(sent.value.scores(batch.column(k_text))[0] < 0.5))

    return plain.mapInArrow(run, T.StructType(list(plain.schema))).toDF(*docs.columns)
