"""Near duplicates by MinHash bands, sequential Bayesian verification and an exact check.

A document is the set of its distinct word n-grams (two words by default, A-Z folded). PERMUTATIONS universal hash permutations of the
set make a signature; BANDS bands of ROWS values each make the keys by which sets meet in Spark, so that a pair of Jaccard similarity s
is a candidate with the probability 1 - (1 - s^ROWS)^BANDS: a pair at 0.8 is missed once in 8 million.

Candidates are compared by their signatures, BATCH values at a time (a byte of each, so that two values of different n-grams agree
with the probability 1/256). After each batch the posterior of the similarity, from a uniform prior and the matches so far, gives the
probability that it reaches the threshold; pairs for which that is below MISS are dropped at once. What survives is verified exactly, once
for each pair, on whole sets.

Equal sets count as one from the start. Buckets of more sets than ngram_join.DENSE are not turned into pairs; they go through the
groups, cores and residuals of ngram_join, which are exact.

n_shingles is the size of the set: a text of fewer words than an n-gram is one shingle; no words (a null text too) make an empty set, linked
with nothing. Rows of one doc_id are one document in its component. Rows with a null doc_id link with nothing, have no component and are
kept. Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .encoding import as_batch
from .ngram_join import Similarity, gram_sets, link_sets, named_sets, sent_frequencies, with_components
from .textops import by_bytes, mix, signed

ROWS, BANDS, BATCH = 5, 40, 25
PERMUTATIONS = ROWS * BANDS
#: Posterior probability of a link below which a pair is dropped.
MISS = 1e-9
_random = np.random.default_rng(31)
_A = _random.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_U = np.uint64


def least_values(sets: list[np.ndarray]) -> np.ndarray:
    """The least value of each permutation over each set of 64-bit hashes (all ones for an empty one)."""
    out = np.full((len(sets), PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    size = np.array([len(s) for s in sets], np.int64)
    some = np.flatnonzero(size)
    if len(some):
        x = (np.concatenate(sets) >> _U(32)).astype(np.uint32)
        begin, held = (np.cumsum(size) - size)[some], np.empty_like(x)
        for k in range(PERMUTATIONS):
            np.multiply(x, _A[k], out=held)
            np.add(held, _B[k], out=held)
            out[some, k] = np.minimum.reduceat(held, begin)
    return out


def bytes_of(least: np.ndarray) -> np.ndarray:
    """One byte of each value, mixed so that it says as much as a byte can."""
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(least), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = mix(keys + least[:, k * BANDS : (k + 1) * BANDS].astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    return keys


def _binomial(m: int, n: int, p: float) -> float:
    """The probability of at most m successes in n trials."""
    return math.fsum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(m + 1))


def posterior(matches: int, compared: int, threshold: float) -> float:
    """The probability that the similarity is the threshold at least, after so many of so many bytes match.

    Bytes match with the probability p = s + (1 - s) / 256. From a uniform prior of s, p has a Beta posterior above 1/256; its tails are
    sums of binomial terms.
    """
    chance = 1 / 256
    return _binomial(matches, compared + 1, threshold + (1 - threshold) * chance) / _binomial(matches, compared + 1, chance)


def least_matches(threshold: float, miss: float = MISS) -> np.ndarray:
    """For each batch, the fewest matches up to its end with which a pair goes on."""
    ends = range(BATCH, PERMUTATIONS + 1, BATCH)
    return np.array([next(m for m in range(n + 1) if m == n or posterior(m, n, threshold) >= miss) for n in ends])


def survivors(a: np.ndarray, b: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Indices of the pairs of signatures (rows of bytes) that no batch drops."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, least in enumerate(need.tolist()):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + np.count_nonzero(a[alive, cut] == b[alive, cut], axis=1)
        alive, matches = alive[matches >= least], matches[matches >= least]
    return alive


_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("signature", pa.binary()), ("keys", pa.list_(pa.int64()))])


def signed_sets(docs: DataFrame, grams: int) -> DataFrame:
    """doc_id, n (set size), low and high (128 bits that name the set), signature, keys of its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            sets = gram_sets(batch.column(1), grams)
            mixed = [mix(s) for s in sets]
            least = least_values(sets)
            yield as_batch(
                {
                    "doc_id": batch.column(0),
                    "n": np.array([len(s) for s in sets]),
                    "low": signed(np.array([m.sum(dtype=np.uint64) for m in mixed], np.uint64)),
                    "high": signed(np.array([mix(m + _U(1)).sum(dtype=np.uint64) for m in mixed], np.uint64)),
                    "signature": [row.tobytes() for row in bytes_of(least)],
                    "keys": list(signed(band_keys(least))),
                },
                _SETS,
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, low long, high long, signature binary, keys array<long>")


def likely(pairs: DataFrame, signatures: DataFrame, how: Similarity) -> DataFrame:
    """The pairs (a, b) that sequential comparison of their signatures (id, signature) leaves. Of several signatures of an id any may do."""
    need = least_matches(how.percent / 100)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, PERMUTATIONS) for k in (2, 3))
                keep = pa.array(survivors(a, b, need))
                yield pa.RecordBatch.from_arrays([batch.column(k).take(keep) for k in (0, 1)], schema=schema)

    for side in "ab":
        pairs = pairs.join(signatures.select(F.col("id").alias(side), F.col("signature").alias(f"{side}_signature")), side)
    return pairs.select("a", "b", "a_signature", "b_signature").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, how: Similarity = Similarity(grams=2, percent=80)) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links), kept (it is the least) for each row of docs(doc_id, text)."""
    docs = docs.select("doc_id", "text")
    sent = sent_frequencies(docs, how)
    sets = materialize(signed_sets(docs, how.grams).withColumn("row", F.monotonically_increasing_id()), "sets")
    named, ones = named_sets(sets)
    # a band says nothing of places in a set: positions that every filter lets pass
    tokens = ones.select("row", "n", F.lit(0).alias("pos"), F.explode("keys").alias("token"))
    links = link_sets(tokens, docs, ones, how, sent, lambda pairs: likely(pairs, ones.select("id", "signature"), how))
    out = with_components(sets, named, links)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
