"""Grids out of phase, seasons of several stacks, tables of trees, models in the whole job and what it writes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scorchmap.operators import placing, temporal, trees
from scorchmap.plans import pipeline
from scorchmap.plans.queries import QUERIES
from scorchmap.settings import MEASURES
from scorchmap.sources.rasters import read_envi

SMALL = "/root/testdata/sf0.001"


def test_scenes_out_of_phase(spark):
    rnd = random.Random(1)
    origins = {"a": (0.0, 900.0), "b": (14.0, 900.0), "c": (-45.0, 915.0), "d": (61.0, 886.0), "e": (30.0 + 1e-6, 900.0)}
    grids = spark.createDataFrame([(k, 1, 1, w, n, 30.0, 30.0) for k, (w, n) in origins.items()], "scene_id string, path int, row int, west double, north double, dx double, dy double")
    looks = spark.createDataFrame([(k, y, x, rnd.randrange(100)) for k in origins for y in range(4) for x in range(5)], "scene_id string, y int, x int, v int")
    common = spark.createDataFrame([(1, 1, -60.0, 930.0)], "path int, row int, west double, north double")
    with pytest.raises(ValueError, match="out of phase"):
        placing.align(looks, grids, common)
    whole = placing.align(looks.where("scene_id in ('a', 'e')"), grids.where("scene_id in ('a', 'e')"), common)
    assert {r.scene_id: (r.y - r.oy, r.x - r.ox) for r in whole.join(looks.select("scene_id", F.col("y").alias("oy"), F.col("x").alias("ox"), "v"), ["scene_id", "v"]).groupBy("scene_id").agg(F.min("y").alias("y"), F.min("oy").alias("oy"), F.min("x").alias("x"), F.min("ox").alias("ox")).collect()} == {"a": (1, 2), "e": (1, 3)}
    # every pixel of the common grid takes the scene's pixel that its centre lies in
    value = {(r.scene_id, r.y, r.x): r.v for r in looks.collect()}
    want = {}
    for k, (w, n) in origins.items():
        for y in range(-2, 12):
            for x in range(-2, 12):
                px, py = round((-60 + 30 * x + 15 - w) / 30, 5), round((n - (930 - 30 * y - 15)) / 30, 5)
                own = value.get((k, math.floor(py), math.floor(px)))
                if own is not None:
                    want[k, y, x] = own
    got = {(r.scene_id, r.y, r.x): r.v for r in placing.align(looks, grids, common, resample="nearest").collect()}
    assert got == want and len(got) == looks.count()
    with pytest.raises(ValueError, match="nearest"):
        placing.align(looks, grids, common, resample="cubic")


def test_dense_seasons_of_each_stack(spark):
    seasonal = spark.createDataFrame([(1, 1, 0, 0, 2000, "fall", 3, *[7] * 8)], "path int, row int, y int, x int, season_year int, season string, good_looks int, " + ", ".join(f"{m} short" for m in MEASURES))
    pixels = spark.createDataFrame([(1, 1, 0, 0), (2, 1, 0, 0), (2, 1, 0, 1), (3, 1, 0, 0)], "path int, row int, y int, x int")
    years = spark.createDataFrame([(1, 1, 2000, 2001), (2, 1, 1990, 1990), (3, 1, 2005, 2003)], "path int, row int, first int, last int")
    rows = temporal.seasonal_dense(seasonal, pixels, years).collect()
    count = {}
    for r in rows:
        count.setdefault((r.path, r.x), set()).add(r.season_year)
    assert count == {(1, 0): {1999, 2000, 2001}, (2, 0): {1989, 1990}, (2, 1): {1989, 1990}, (3, 0): {2004}} and len(rows) == 4 * 8
    assert [(r.path, r.season_year, r.season) for r in rows if r.good_looks == 3] == [(1, 2000, "fall")] and sum(r.b3 == -9999 for r in rows) == 31


def _ensemble(seed, classes, count, names):
    rnd, nodes = random.Random(seed), []
    for k in range(classes):
        for t in range(count):
            # a leaf alone, a full tree of depth two, or a chain
            shape = rnd.choice(["leaf", "full", "chain"])
            inner = {"leaf": {}, "full": {0: (1, 2), 1: (3, 4), 2: (5, 6)}, "chain": {0: (1, 2), 2: (3, 4), 4: (5, 6)}}[shape]
            for n in range(1 if shape == "leaf" else 7):
                a, b = inner.get(n, (-1, -1))
                nodes.append((k, t, n, rnd.randrange(len(names)) if n in inner else None, rnd.random(), a, b, rnd.uniform(-1, 1)))
    return trees.Ensemble(nodes, rnd.random(), 0.3, names)


@pytest.mark.parametrize("most", [1 << 21, 60])
def test_a_table_of_trees(spark, monkeypatch, most):
    monkeypatch.setattr(trees, "MAX_NODES", most)
    monkeypatch.setattr(trees, "_WALKED", 50)
    names, rnd = ("a", "b", "c"), random.Random(0)
    models = {"two": _ensemble(1, 2, 9, names), "three": _ensemble(2, 3, 5, names), "one": _ensemble(3, 1, 4, names)}
    nodes = spark.createDataFrame([r for m, e in models.items() for r in trees.ensemble_rows(m, e)], trees.NODES).repartition(4)
    settings = spark.createDataFrame([(m, e.base, e.shrinkage) for m, e in models.items()], "model string, base double, shrinkage double")
    rows = [(k, [*models, "none", None][k % 5], rnd.random(), rnd.random(), None if k % 7 == 0 else rnd.random()) for k in range(200)]
    data = spark.createDataFrame(rows, "id int, model string, a double, b double, c double")

    def plainly(e, x, wanted):
        sums = [e.base] * e.classes
        for (k, _), tree in e.trees().items():
            n = 0
            while tree[n][0] is not None:
                f, cut, left, right, _ = tree[n]
                n = left if x[f] is not None and x[f] <= cut else right
            sums[k] += e.shrinkage * tree[n][4]
        return sums[0] if e.classes == 1 else math.exp(sums[wanted]) / sum(map(math.exp, sums))

    for wanted in (1, 2):
        got = {r.id: r.probability for r in trees.score_forest(data, nodes, settings, names, wanted).collect()}
        assert len(got) == len(rows)
        for k, m, *x in rows:
            if m not in models:
                assert got[k] is None
            else:
                assert got[k] == pytest.approx(0.0 if wanted >= max(2, models[m].classes) else plainly(models[m], x, wanted), rel=1e-12)
    assert len(trees.forest_passes(nodes)) == (1 if most > 1000 else 3)
    assert trees.score_forest(data, nodes.limit(0), settings, names).where("probability IS NULL").count() == len(rows)
    with pytest.raises(ValueError, match="no base"):
        trees.score_forest(data, nodes, settings.where("model = 'two'"), names).count()
    with pytest.raises(ValueError, match="nodes of each tree"):
        trees.load_forest(nodes.where("node <> 1"), settings)


def test_great_sums_have_a_probability(spark):
    e = trees.Ensemble([(k, 0, 0, None, 0.0, -1, -1, v) for k, v in enumerate((0.0, 2000.0))], 0.0, 1.0, ("a",))
    assert spark.range(1).select(F.col("id").alias("a")).select(trees.tree_probability(e)).first()[0] == 1.0


def test_features_take_three_shuffles(spark):
    """Looks are dealt by tile once; the two others are of the list of years."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["feature_vector"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    by_tile = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(by_tile) <= 3 and all("season_year" not in line for line in by_tile), "\n".join(by_tile)


def test_models_of_all_kinds_in_one_job(spark):
    looks = spark.createDataFrame([(k, ["column", "other", "trained"][k % 3]) for k in range(30)], "id int, model string").withColumn("qa", F.when(F.col("id") < 3, -7).otherwise(0))
    score = pipeline.by_model({"column": F.lit(0.5), "other": F.lit(0.25), "trained": lambda df: df.withColumn("burn_prob", (F.col("id") * 2).cast("short"))})
    got = {r.id: r.burn_prob for r in score(looks).collect()}
    assert got == {k: 2 * k if k % 3 == 2 else -9998 if k < 3 else (50, 25)[k % 3] for k in range(30)}


def test_outputs_of_a_job(spark, tmp_path):
    products = spark.createDataFrame([(p, 9, y, x, year, p + x, 1, 2, 90 + y) for p in (5, 6) for year in (2000, 2002) for y in range(3) for x in range(4)], "path int, row int, y int, x int, year int, burned_area int, burn_count int, good_looks_count int, max_burn_prob int")
    extent = spark.createDataFrame([(5, 9, 3, 4), (6, 9, 4, 5)], "path int, row int, nrow int, ncol int")
    listed = pipeline.write_outputs(products, extent, f"file://{tmp_path}/out").collect()
    assert sorted({(r.path, r.year, r.name) for r in listed}) == sorted((p, y, n) for p in (5, 6) for y in (2000, 2002) for n in ("burned_area", "burn_count", "good_looks_count", "max_burn_prob"))
    got = {(r.name, r.y, r.x): r.value for r in read_envi(spark, f"file://{tmp_path}/out/rasters/006009").collect()}
    assert len(got) == 8 * 20 and got["burned_area_2002", 1, 3] == 9 and got["max_burn_prob_2000", 2, 0] == 92 and got["burn_count_2000", 3, 4] == -9999
    assert spark.read.json(f"file://{tmp_path}/out/catalogue").count() == 16 and spark.read.parquet(f"file://{tmp_path}/out/products").count() == 48
    with pytest.raises(ValueError, match="no products"):
        pipeline.write_outputs(products.limit(0), extent, f"file://{tmp_path}/none")
