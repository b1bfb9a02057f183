"""Groups of near copies: the n-gram join and the band join against brute force, and how their pairs grow."""

import random

import pytest

from scorchmap.llm import fingerprints, ngram_join

from test_exact import brute_components, grams


def near_copies(seed, size, words, changes, base=None):
    """size copies of one text (which is not among them), each with changes(rnd) of its words replaced."""
    rnd = random.Random(seed)
    base = base or [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for k in rnd.sample(range(words), changes(rnd)):
            copy[k] = f"e{rnd.randrange(10**7)}"
        out.append(" ".join(copy))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def groups():
    """Two groups of near copies around one text, with others that share half of it, and copies of copies."""
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(80)]
    other = base[:40] + [f"v{k}" for k in range(40)]
    texts = near_copies(1, 50, 80, lambda r: r.randint(0, 6), base) + near_copies(2, 40, 80, lambda r: r.randint(0, 5), other)
    texts += near_copies(3, 25, 80, lambda r: r.randint(0, 2), texts[7].split()) + texts[:5]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("settings, how", [({}, (4, 85)), ({"DENSE": 2, "MAX_NAMED": 3}, (4, 85)), ({"DENSE": 4, "LEVELS": 1}, (3, 70))])
def test_components(spark, groups, monkeypatch, settings, how):
    for name, value in settings.items():
        monkeypatch.setattr(ngram_join, name, value)
    how = ngram_join.Similarity(*how)
    want = brute_components({k: grams(t, how.grams) for k, t in groups}, how.percent)
    assert 3 < len(set(want.values())) < len(want)
    got = ngram_join.similarity_components(table(spark, groups), how).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_bands(spark, groups, monkeypatch):
    monkeypatch.setattr(ngram_join, "DENSE", 4)
    want = brute_components({k: grams(t, 5) for k, t in groups}, 80)
    assert {r.doc_id: r.component_id for r in fingerprints.near_duplicates(table(spark, groups)).collect()} == want


@pytest.mark.parametrize("changes, sizes", [(4, (100, 200, 400)), (6, (200,))])
def test_pairs_grow_in_proportion(spark, monkeypatch, changes, sizes):
    """Near copies under the threshold: all pairs would be 4950, 19900 and 79800. Beside true links, few pairs are made."""
    made, plain = [], ngram_join._same_bucket

    def counted(*a):
        out = plain(*a)
        made.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_same_bucket", counted)
    monkeypatch.setattr(ngram_join, "DENSE", 32)
    for m in sizes:
        made.clear()
        rows = list(enumerate(near_copies(m, m, 300, lambda r: changes)))
        sets = {k: grams(t, 4) for k, t in rows}
        got = ngram_join.similarity_components(table(spark, rows)).collect()
        assert {r.doc_id: r.component_id for r in got} == brute_components(sets, 85)
        links = sum(100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) for a in sets for b in range(a))
        assert sum(made) <= 2 * links + m, (m, made, links)


def test_odd_rows(spark):
    """A doc_id with several texts stands for all of them; equal rows are equal; a null doc_id has no component."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b), (4, c), (None, c), (None, None), (5, ""), (5, c), (6, ""), (7, None)]
    got = ngram_join.similarity_components(table(spark, rows)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.component_id is None else r.component_id) for r in got) == [(-1, -1), (-1, -1), (1, 1), (2, 1), (2, 1), (3, 1), (3, 1), (4, 4), (5, 4), (5, 4), (6, 6), (7, 7)]
