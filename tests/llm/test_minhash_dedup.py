"""MinHash near-dedup against all pairs, and its sequential test against plain counting."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorchmap.llm import minhash_dedup as dedup
from scorchmap.llm import ngram_join
from test_exact import DOCS, brute_components, grams
from test_near_copies import near_copies, table


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies of several sizes, on both sides of the threshold."""
    rows, start = list(DOCS), 10_000
    for seed, (size, words, changes) in enumerate([(30, 40, 2), (30, 40, 3), (25, 120, 5), (25, 120, 7), (6, 9, 1), (40, 200, 9)]):
        rows += list(enumerate(near_copies(seed, size, words, lambda r, c=changes: r.randint(0, c)), start))
        start += 1000
    return rows


@pytest.mark.parametrize("settings", [{}, {"DENSE": 4, "LEVELS": 1, "MAX_NAMED": 5}])
def test_components(spark, copies, monkeypatch, settings):
    for k, v in settings.items():
        monkeypatch.setattr(ngram_join, k, v)
    sets = {k: grams(t, 2) for k, t in copies}
    want = brute_components(sets, 80)
    assert 50 < len(set(want.values())) < len(want) - 50
    docs = table(spark, copies).withColumns({"signature": F.lit(1), "row": F.lit(2), "keys": F.lit(3), "token": F.lit(4)})
    got = sorted(map(tuple, dedup.near_duplicates(docs).collect()))
    assert got == sorted((k, len(sets[k]), want[k], want[k] == k) for k in sets)


def test_odd_rows(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b), (4, c), (None, c), (None, None), (5, ""), (5, c), (6, " \n"), (7, None), (8, "one"), (9, "One"), (10, "one two " * 40_000), (11, "one two one")]
    got = dedup.near_duplicates(table(spark, rows)).collect()
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 8, 10: 10, 11: 10}
    assert sorted((repr(r.doc_id), repr(r.component_id), r.kept) for r in got) == sorted((repr(k), repr(want.get(k)), want.get(k) == k) for k, _ in rows)
    assert dedup.near_duplicates(table(spark, rows).limit(0)).count() == 0


def test_posterior_is_that_of_a_grid():
    """Against sums over a grid of similarities with a uniform prior."""
    s = (np.arange(40_000) + 0.5) / 40_000
    p = s + (1 - s) / 256
    for m, n in ((0, 25), (15, 25), (20, 25), (25, 25), (70, 100), (90, 100), (150, 200)):
        weight = np.exp(m * np.log(p) + (n - m) * np.log1p(-p) + math.lgamma(n + 1) - math.lgamma(m + 1) - math.lgamma(n - m + 1))
        assert dedup.posterior(m, n, 0.8) == pytest.approx(weight[s >= 0.8].sum() / weight.sum(), rel=1e-2, abs=1e-15)


def test_sequential_test_keeps_links_and_drops_others():
    need, rng = dedup.least_matches(0.8), np.random.default_rng(0)

    def signatures(s, size=20_000):
        a = rng.integers(0, 256, (size, dedup.PERMUTATIONS), dtype=np.uint8)
        return a, np.where(rng.random(a.shape) < s, a, rng.integers(0, 256, a.shape, dtype=np.uint8))

    for s, low, high in ((0.8, 1, 1), (0.9, 1, 1), (0.3, 0, 0.001), (0.5, 0, 0.2)):
        a, b = signatures(s)
        kept = dedup.survivors(a, b, need)
        matches = np.count_nonzero(a == b, axis=1)
        assert low <= len(kept) / len(a) <= high, (s, len(kept))
        assert (matches[kept] >= need[-1]).all()
        # a pair is kept if and only if it has enough matches at the end of each batch
        ends = np.cumsum([np.count_nonzero(a[:, k : k + dedup.BATCH] == b[:, k : k + dedup.BATCH], axis=1) for k in range(0, dedup.PERMUTATIONS, dedup.BATCH)], axis=0)
        assert kept.tolist() == np.flatnonzero((ends >= need[:, None]).all(axis=0)).tolist()


def test_signatures_are_least_values():
    rnd = random.Random(4)
    sets = [np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64)) for n in (1, 7, 300)]
    got = dedup.least_values([*sets, np.zeros(0, np.uint64)])
    for row, s in zip(got, sets, strict=False):
        assert row.tolist() == [min((int(x) >> 32) * int(a) + int(b) & 0xFFFFFFFF for x in s) for a, b in zip(dedup._A, dedup._B, strict=True)]
    assert (got[3] == 0xFFFFFFFF).all()
    # the share of equal values is near the Jaccard similarity
    base = np.unique(np.array([rnd.getrandbits(64) for _ in range(3000)], np.uint64))
    x, y = dedup.least_values([base[:2000], base[500:2500]])
    assert abs((x == y).mean() - 1500 / 2500) < 0.12
