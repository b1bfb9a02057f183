"""Scores and evidence of the toxicity model against a plain computation over all examples."""

import math
import random
import zlib
from collections import Counter

import pytest

from scorchmap.llm import toxicity


def corpus():
    rnd = random.Random(9)
    bad, good, plain = [f"bad{k}" for k in range(12)], [f"good{k}" for k in range(8)], [f"w{k}" for k in range(200)]
    rows = []
    for k in range(700):
        toxic = int(k % 5 == 0)
        w = rnd.choices(plain, k=rnd.randint(5, 60)) + rnd.choices(bad if toxic or rnd.random() < 0.03 else good, k=rnd.randint(0, 4))
        rnd.shuffle(w)
        rows.append((k, " ".join(w), toxic))
    return rows + [(700, rows[0][1], 1), (701, rows[1][1].upper(), 0), (702, None, 0), (703, "", 1), (704, "bad1 good1", None)]


def words(text):
    return (text or "").lower().split()


def plain_scores(rows, train, k=toxicity.NEIGHBOURS):
    """All terms, weights, cosines, votes and the isotonic fit, without index, blocks or bounds."""
    texts = {d: Counter(words(t)) for d, t, _ in rows}
    n = Counter(train.values())
    ones, zeros = Counter(), Counter()
    for d, label in train.items():
        (ones if label else zeros).update(set(texts[d]))
    weight = {}
    idf = lambda df: math.log((n[0] + n[1] + 1) / (df + 1)) + 1
    for w in {*ones, *zeros}:
        p, q, both = ones[w] / n[1], zeros[w] / n[0], (ones[w] + zeros[w]) / (n[0] + n[1])
        chi2 = (p - q) ** 2 / (both * (1 - both) + 1e-12) * n[0] * n[1] / (n[0] + n[1])
        bits = abs(math.log2((ones[w] + 0.5) / (n[1] + 0.5) / ((zeros[w] + 0.5) / (n[0] + 0.5))))
        weight[w] = idf(ones[w] + zeros[w]) * (1 + toxicity.STRENGTH * chi2 / (chi2 + 25) * min(bits, 5) / 5)
    vectors = {}
    for d, c in texts.items():
        v = {w: (1 + math.log(m)) * weight.get(w, idf(0)) for w, m in c.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        vectors[d] = {w: x / size for w, x in v.items() if w in weight}
    silent = [train[d] for d in train if not vectors[d]]
    prior = (sum(silent) + n[1] / (n[0] + n[1])) / (len(silent) + 1)

    def vote(d, own=None):
        near = sorted(((sum(x * vectors[e].get(w, 0) for w, x in vectors[d].items()), e) for e in train if e != own), reverse=True)
        # examples of equal vectors count as K at most; all that are as near as the last one are taken
        groups = {}
        for c, e in near:
            if c > 1e-12:
                groups.setdefault(tuple(sorted(vectors[e].items())), [c, []])[1].append(e)
        found, have, last = [], 0, 2.0
        for c, es in sorted(groups.values(), key=lambda g: -g[0]):
            if have >= k and c < last - 1e-9:
                break
            found.append((c, es))
            if have < k:
                have, last = have + len(es), c
        if not found:
            return None
        by = [(c * c / (1.05 - c) * min(len(es), k) / len(es), es) for c, es in found]
        return (sum(w * sum(train[e] for e in es) for w, es in by) + 0.25 * prior) / (sum(w * len(es) for w, es in by) + 0.25)

    told = lambda d: prior if vote(d, d) is None else vote(d, d)
    points = sorted((told(d), train[d]) for d in train if vectors[d])
    levels = []
    for x, y in points:
        levels.append([y, 1, x])
        while len(levels) > 1 and levels[-2][0] * levels[-1][1] >= levels[-1][0] * levels[-2][1]:
            last = levels.pop()
            levels[-1] = [a + b for a, b in zip(levels[-1], last, strict=True)]
    xs, ys = [s[2] / s[1] for s in levels], [s[0] / s[1] for s in levels]

    def score(d):
        v = vote(d)
        if v is None:
            return prior
        if v <= xs[0]:
            fit = ys[0]
        elif v >= xs[-1]:
            fit = ys[-1]
        else:
            i = max(j for j in range(len(xs)) if xs[j] <= v)
            fit = ys[i] if xs[i] == v else ys[i] + (ys[i + 1] - ys[i]) * (v - xs[i]) / (xs[i + 1] - xs[i])
        return min(1, max(0, 0.98 * fit + 0.02 * v))

    best = lambda d: max((sum(x * vectors[e].get(w, 0) for w, x in vectors[d].items()) for e in train), default=0)
    return {d: score(d) for d in texts}, {d: best(d) for d in texts}


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_score_and_evidence(spark, rows):
    docs = spark.createDataFrame([(d, t, "w", 1) for d, t, _ in rows], "doc_id long, text string, terms string, score int").repartition(3)
    labels = spark.createDataFrame([(d, x) for d, _, x in rows] + [(7, 0), (5, 0), (None, 1), (9999, 1)], "doc_id long, toxic int")
    train = {d: x for d, _, x in rows if x is not None and zlib.crc32(str(d).encode()) % 5}
    # one class weight: the sample holds all labels, but for the one without a document
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()).where("doc_id < 9999 or doc_id is null"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    scores, cosines = plain_scores(rows, train)
    assert len({round(x, 6) for x in scores.values()}) > 5
    for d in scores:
        assert abs(got[d].evidence_cosine - cosines[d]) < 1e-9, d
        assert abs(got[d].score - scores[d]) < 1e-6, (d, got[d].score, scores[d])
        assert got[d].predicted == (got[d].score >= 0.5)
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d in scores if got[d].score < 0.5}


def test_a_copy_of_an_example_is_found(spark):
    """Whatever its words are, telling or not: cosine 1 and that evidence; every text that shares a word has some."""
    rnd = random.Random(2)
    own = lambda k: " ".join(f"only{k}x{j}" for j in range(30))
    rows = [(k, " ".join(rnd.choices([f"w{j}" for j in range(300)], k=40)), int(k % 4 == 0)) for k in range(400)]
    rows += [(1000, own(1), 1), (1001, own(2), 0)]
    asked = [(2000, own(1)), (2001, own(2).upper()), (2002, own(1) + " w1 w2"), (2003, "w7"), (2004, "never seen"), (2005, rows[8][1]), (2006, " ".join([own(1)] * 3000))]
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(d, x) for d, _, x in rows], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    for d, e in ((2000, 1000), (2001, 1001), (2005, 8)):
        assert got[d].evidence == e and abs(got[d].evidence_cosine - 1) < 1e-9
    assert got[2000].score > 0.5 > got[2001].score and got[2002].evidence == 1000 and 0.9 < got[2002].evidence_cosine < 1
    assert got[2003].evidence is not None and got[2004].evidence is None and got[2006].evidence == 1000
    assert got[2004].score == pytest.approx(model.prior)


@pytest.mark.parametrize("texts, block, head", [(300, 8, 0.5), (300, 8, 2.0), (70, 64, 0.01), (5, 4, 0.2)])
def test_search_is_that_of_a_scan(monkeypatch, texts, block, head):
    """Of any blocks and with any terms as columns: the nearest of all entries."""
    import numpy as np

    monkeypatch.setattr(toxicity, "_BLOCK", block)
    monkeypatch.setattr(toxicity, "_HEAD", head)
    rng = np.random.default_rng(texts)

    def vectors(n):
        rows = [np.unique((rng.random(rng.integers(0, 25)) ** 3 * 200).astype(np.int64)) for _ in range(n)]
        weights = [w / np.sqrt((w * w).sum()) if len(w) else w for w in (rng.random(len(r)) + 0.1 for r in rows)]
        return toxicity.Vectors(np.concatenate(rows), np.concatenate(weights), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))

    entries, queries, k = vectors(texts), vectors(90), 7
    dense = lambda v: np.stack([np.bincount(*v.row(j)[:1], weights=v.row(j)[1], minlength=200) if len(v.row(j)[0]) else np.zeros(200) for j in range(len(v.first) - 1)])
    want = dense(queries) @ dense(entries).T
    cosines, least = toxicity.Index(entries, 200).search(queries, k)
    for got, all_, low in zip(cosines, want, least, strict=True):
        if texts > k:
            assert low == pytest.approx(np.sort(all_)[-k], abs=1e-12)
        near = np.flatnonzero(all_ >= max(low, 1e-9) - 1e-12)
        assert np.allclose(got[near], all_[near])
    if texts == 300 and head == 2.0:
        assert (cosines == -1).mean() > 0.02  # some blocks were passed over


def test_the_driver_holds_few_copies_of_the_examples(spark):
    """What fitting takes there at most, and what is sent to tasks, in multiples of the terms and weights of all examples."""
    import pickle
    import tracemalloc

    rnd = random.Random(3)
    rows = [(k, " ".join(f"w{x}" for x in rnd.choices(range(100_000), k=600)), int(k % 3 == 0)) for k in range(1_500)]
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(d, x) for d, _, x in rows], "doc_id long, toxic int")
    vectors = 16 * sum(len(set(t.split())) for _, t, _ in rows)
    tracemalloc.start()
    model = toxicity.fit(docs, labels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 5 * vectors, most / vectors
    assert len(pickle.dumps(model)) < 2 * vectors, len(pickle.dumps(model)) / vectors
