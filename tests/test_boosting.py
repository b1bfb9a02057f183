"""One boosted ensemble for each class, against a plain one that looks at every row for every split."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scorchmap.operators import boosting, trees

NAMES = ("a", "b", "c")


def _plain(rows, classes, cuts, turns, depth, shrinkage, least=1):
    """The nodes of the ensemble; rows: (values, label), a missing value is None."""
    goes_left = lambda v, c: v is not None and v == v and v <= c
    sums, nodes = [[0.0] * classes for _ in rows], []

    def leaf(part, k):
        h = sum(curve[i][k] for i in part)
        return (classes - 1) / classes * sum(slope[i][k] for i in part) / h if h > 0 else 0.0

    for turn in range(turns):
        slope, curve = [], []
        for (_, label), s in zip(rows, sums):
            e = [math.exp(v - max(s)) for v in s]
            p = [v / sum(e) for v in e]
            slope.append([(label == k) - p[k] for k in range(classes)])
            curve.append([v * (1 - v) for v in p])
        step = [[0.0] * classes for _ in rows]
        for k in range(classes):
            tree, level = [None], [(0, list(range(len(rows))))]
            for d in range(depth + 1):
                following = []
                for node, part in level:
                    best = None
                    square = lambda ids: sum(slope[i][k] for i in ids) ** 2 / len(ids)
                    for f, c in [(f, c) for f in range(len(cuts)) for c in cuts[f] if d < depth]:
                        left = [i for i in part if goes_left(rows[i][0][f], c)]
                        right = [i for i in part if not goes_left(rows[i][0][f], c)]
                        if len(left) >= least and len(right) >= least:
                            gain = square(left) + square(right) - square(part)
                            if gain > 1e-9 and (best is None or gain > best[0] + 1e-7):
                                best = gain, f, c, left, right
                    if best is None:
                        value = leaf(part, k)
                        tree[node] = (k, turn, node, None, 0.0, -1, -1, value)
                        for i in part:
                            step[i][k] = shrinkage * value
                    else:
                        first = len(tree)
                        tree += [None, None]
                        tree[node] = (k, turn, node, best[1], best[2], first, first + 1, 0.0)
                        following += [(first, best[3]), (first + 1, best[4])]
                level = following
            nodes += tree
        sums = [[a + b for a, b in zip(s, t)] for s, t in zip(sums, step)]
    return nodes


@pytest.fixture(scope="module")
def rows():
    rnd, out = random.Random(11), []
    for _ in range(240):
        a, b, c = rnd.randrange(-300, 300), rnd.random() * 10, rnd.randrange(4)
        label = 2 if a > 120 else int(b > 4 + c)
        out.append(((None if rnd.random() < 0.05 else float(a), math.nan if rnd.random() < 0.05 else b, float(c)), label if rnd.random() > 0.05 else rnd.randrange(3)))
    return out + out[:1] * 120  # a third of all rows are one


def _table(spark, rows):
    return spark.createDataFrame([(*v, y) for v, y in rows], "a double, b double, c double, fire int").repartition(5)


def test_same_trees_as_plain_boosting(spark, rows, monkeypatch):
    monkeypatch.setattr(boosting, "KEPT_ROUNDS", 2)  # sums are written between the rounds
    data, options = _table(spark, rows), trees.TrainingOptions(3, 0.4, 2, 1.0)
    got = boosting.boost(data, options, features=NAMES, bins=12)
    cuts = boosting.cut_points(data, NAMES, 12)
    assert [len(c) for c in cuts] == [11, 11, 3]
    want = _plain(rows, 3, [c.tolist() for c in cuts], 3, 2, 0.4)
    assert [n[:7] for n in got.nodes] == [n[:7] for n in want]
    assert [n[7] for n in got.nodes] == pytest.approx([n[7] for n in want], abs=1e-6)
    # what is trained can be scored by all three ways; missing values go right in each
    scored = data.withColumn("model", F.lit("m"))
    forest = trees.score_forest(scored, spark.createDataFrame(trees.ensemble_rows("m", got), trees.NODES), spark.createDataFrame([("m", got.base, got.shrinkage)], "model string, base double, shrinkage double"), NAMES, 2)
    both = forest.select("probability", trees.tree_probability(got, 2).alias("built")).collect()
    assert [r.probability for r in both] == pytest.approx([r.built for r in both])


def test_repeatable_and_as_good_as_two_class_boosting(spark, rows):
    two = [(v, int(y > 0)) for v, y in rows]
    options = trees.TrainingOptions(4, 0.4, 3, 0.7, 0.7, 5)
    first = boosting.boost(_table(spark, two), options, features=NAMES)
    assert first.nodes == boosting.boost(_table(spark, two[::-1]).repartition(3), options, features=NAMES).nodes
    ensemble, report = boosting.train_classes(_table(spark, rows), options, features=NAMES)
    r = report.first()
    assert ensemble.classes == r.classes == 3 and r.train_error < 15 and r.test_error < 30

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    data = _table(spark, two).fillna(-1e9).withColumn("b", F.nanvl("b", F.lit(-1e9)))
    ours = data.select(F.avg((boosting.predicted_class(boosting.boost(data, options, features=NAMES)) != F.col("fire")).cast("double"))).first()[0]
    vectors = VectorAssembler(inputCols=list(NAMES), outputCol="v").transform(data)
    theirs = GBTClassifier(featuresCol="v", labelCol="fire", maxIter=4, stepSize=0.4, maxDepth=3, seed=5).fit(vectors).transform(vectors)
    assert abs(ours - theirs.select(F.avg((F.col("prediction") != F.col("fire")).cast("double"))).first()[0]) < 0.05


def test_edges(spark):
    options = trees.TrainingOptions(2, 0.5, 2, 1.0)
    table = lambda rows: spark.createDataFrame(rows, "a double, fire int, b double, c double")
    with pytest.raises(ValueError):
        boosting.boost(table([(1.0, None, 1.0, 1.0)]), options, features=NAMES)
    with pytest.raises(ValueError):
        boosting.boost(table([(1.0, 3, 1.0, 1.0)]), options, features=NAMES, classes=3)
    with pytest.raises(ValueError):
        boosting.boost(table([(1.0, -1, 1.0, 1.0)]), options, features=NAMES)
    # nothing to split by, one class, nothing but missing values
    for rows in ([(None, 0, None, None)] * 3, [(1.0, 1, None, math.nan), (1.0, 0, None, math.nan)]):
        e = boosting.boost(table(rows), options, features=NAMES)
        assert e.classes == 2 and all(n[3] is None for n in e.nodes)
    least = boosting.boost(table([(float(k), int(k > 0), 0.0, 0.0) for k in range(6)]), options, features=NAMES, least=2)
    assert {n[4] for n in least.nodes if n[3] is not None} <= {1.5, 2.5, 3.5}
