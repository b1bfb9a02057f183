"""Work that must not grow faster than what is read or returned."""

import os
import random
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorchmap.functions.quality import qa_code
from scorchmap.operators import placing, screening, trees
from scorchmap.plans import pipeline, views
from scorchmap.plans.queries import ENSEMBLE, QUERIES
from scorchmap.settings import RegionOptions
from scorchmap.sources import metadata
from scorchmap.storage import materialize

SMALL = "/root/testdata/sf0.001"


def _nodes(plan):
    """A plan that has run, with what is inside its stages."""
    yield plan
    for inner in ("executedPlan", "plan"):
        if plan.getClass().getSimpleName() in {"executedPlan": ("AdaptiveSparkPlanExec",), "plan": ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec")}[inner]:
            yield from _nodes(getattr(plan, inner)())
    children = plan.children()
    for k in range(children.size()):
        yield from _nodes(children.apply(k))


def _most_rows(df):
    """The rows of a table, and the most that any step of its plan put out."""
    rows = df.collect()
    counts = [n.metrics().get("numOutputRows") for n in _nodes(df._jdf.queryExecution().executedPlan())]
    return rows, max(c.get().value() for c in counts if c.isDefined())


def test_points_do_not_meet_scenes_without_a_look(spark, monkeypatch):
    """300 points in 400 scenes, each with a look at one of 40 pixels: no step makes the 120,000 pairs of a point and a scene."""
    points = spark.createDataFrame([(k, 15.0 + 30 * (k % 40), -15.0) for k in range(300)], "point_id long, px double, py double")
    bounds = [(0.0, 0.0, 1200.0, -30.0), (-30.0, 0.0, 1170.0, -30.0)]  # those of odd scenes begin a pixel further west
    scenes = spark.createDataFrame([(f"s{k}", *bounds[k % 2], 30.0, 30.0) for k in range(400)], "scene_id string, west double, north double, east double, south double, dx double, dy double")
    looks = spark.createDataFrame([(f"s{k}", 0, k % 40, k) for k in range(400)] + [("none", 0, 0, -1)], "scene_id string, y int, x int, v int")
    want = sorted((p, f"s{k}", 0, k % 40, k) for p in range(300) for k in range(400) if k % 40 == p % 40 + k % 2 and (k % 2 == 0 or p % 40 < 39))
    columns = ["point_id", "scene_id", "y", "x", "v"]
    rows, most = _most_rows(placing.point_stack(points, scenes, looks, ["v"]).select(*columns))
    assert sorted(map(tuple, rows)) == want
    assert most < 10_000
    monkeypatch.setattr(placing, "_small", lambda *_: False)  # as with many points, pixels and scenes
    assert sorted(map(tuple, placing.point_stack(points, scenes, looks, ["v"]).select(*columns).collect())) == want


def test_job_makes_the_list_of_scenes_once(spark):
    two = views.two_stacks(views.OBS)
    looks = views.view(spark, SMALL, two, "obs").withColumns({"qa": qa_code(), "half_year": F.expr("year * 10 + CAST(floor((month - 1) / 6) AS INT)")})
    shots, seen = materialize(views.view(spark, SMALL, f"{two},\n{views.SHOTS}", "shots"), "shots"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    models = {m: trees.tree_probability(ENSEMBLE) for m in (screening.USUAL_MODEL, "gbt_gp_west_model.xml")}
    out = pipeline.job(shots.mapInArrow(counted, shots.schema), looks, screening.default_models(spark), models, options=RegionOptions(80, 2, 70), scene="half_year", tile_side=16)
    assert out.count() > 1000 and seen.value == shots.count()


def _forest(rnd, depth, features, odd=0.0):
    """40 trees of many shapes, their thresholds among few numbers; odd: the share of thresholds that are no number."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    for _ in range(40):
        roots.append(base := len(feature))
        tree, open_nodes = [None], [(0, 0)]
        while open_nodes:
            n, d = open_nodes.pop()
            if d < depth and rnd.random() < 0.9:
                kids = [len(tree), len(tree) + 1]
                rnd.shuffle(kids)
                tree += [None, None]
                tree[n] = (rnd.randrange(features), float("nan") if rnd.random() < odd else float(rnd.randint(-5, 5)), *kids, 0.0)
                open_nodes += [(k, d + 1) for k in kids]
            else:
                tree[n] = (-1, 0.0, -1, -1, rnd.uniform(-1, 1))
        for f, c, a, b, v in tree:
            for column, x in ((feature, f), (threshold, c), (left, base + a), (right, base + b), (value, v)):
                column.append(x)
    return trees.Forest(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), {"m": np.array(roots)}, {"m": np.arange(40) % 2}, {"m": (0.1, 0.05)})


@pytest.mark.parametrize("depth, odd, tables", [(0, 0, 1 << 27), (2, 0, 1 << 27), (3, 0.02, 1 << 27), (5, 0, 1 << 27), (6, 0.005, 1 << 27), (9, 0, 1 << 27), (2, 0, 0), (6, 0, 20_000)])
def test_trees_are_looked_up_not_walked(monkeypatch, depth, odd, tables):
    """The same probabilities as from walks; no walk but for trees of more than 64 leaves, odd thresholds, or without room for tables."""
    monkeypatch.setattr(trees, "_TABLES", tables)
    rnd = random.Random(depth)
    forest = _forest(rnd, depth, 5, odd)
    special = [float("nan"), float("inf"), -float("inf")]
    x = np.array([[rnd.choice(special) if rnd.random() < 0.1 else float(rnd.randint(-6, 6)) for _ in range(5)] for _ in range(300)])
    roots, walk, walked = forest.roots["m"], trees.Forest._leaves, []

    def one_by_one(n, row):
        while forest.feature[n] >= 0:
            n = forest.left[n] if row[forest.feature[n]] <= forest.threshold[n] else forest.right[n]
        return forest.value[n]

    sums = np.array([[0.1 + 0.05 * sum(one_by_one(r, row) for r in roots[k::2]) for k in (0, 1)] for row in x])
    want = np.exp(sums[:, 1]) / np.exp(sums).sum(axis=1)
    monkeypatch.setattr(trees.Forest, "_leaves", lambda self, r, part: walked.append(len(r)) or walk(self, r, part))
    assert np.allclose(forest.probability("m", x, 1), want, rtol=0, atol=1e-12)
    if depth < 6 and not odd and tables:
        assert not walked
    elif depth < 9 and tables:
        assert all(n < 40 for n in walked)


def test_training_rows_are_kept_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(metadata, "TRAINING_ROWS", 1000, raising=False)
    rows = QUERIES["training_round_trip"](spark, SMALL)
    size = [os.path.getsize(urlparse(f).path) for f in rows.inputFiles()]
    rows.write.csv(f"file://{tmp_path}/plain")
    assert 3 * sum(size) < sum(f.stat().st_size for f in (tmp_path / "plain").glob("part-*"))
    assert len(size) >= rows.count() / 1000


def test_features_are_made_by_compiled_code(spark):
    """While the job makes and scores features, methods that the JVM does not compile are not used; afterwards the session is as before."""
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    looks = materialize(views.view(spark, SMALL, views.OBS, "obs").withColumn("qa", qa_code()).where("y < 2"), "looks")

    def score(featured):
        seen.append(int(spark.conf.get(name)))
        return featured.withColumn("burn_prob", F.col("raw_prob").cast("short"))

    spark.conf.set(name, "65535")
    try:
        assert pipeline.burned_pipeline(looks, score, RegionOptions(80, 2, 70), tile_side=16).count() > 100
        assert seen == [8000] and spark.conf.get(name) == "65535"
    finally:
        spark.conf.set(name, before)
