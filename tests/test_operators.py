import random

import pytest
from pyspark.sql import functions as F

from scorchmap.operators import annual, features, regions, screening, temporal, trees
from scorchmap.operators.components import connected_components
from scorchmap.settings import RegionOptions


def test_components_of_random_graphs(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(60)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for x in root if find(x) != x}
    assert dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect())) == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_screening(spark):
    rows = [("a", "L1G", 99.0, 99.0), ("b", "L1T", 10.0, 80.0), ("c", "L1T", 10.1, 90.0), ("d", None, None, 80.5), ("e", None, None, None)]
    got = screening.screen(spark.createDataFrame(rows, "id string, data_type string, rmse double, cloud_cover double"))
    assert dict(got.select("id", "exclude_reason").collect()) == {"a": "l1g", "b": None, "c": "rmse", "d": "cloud", "e": None}


def test_years(spark):
    s = spark.createDataFrame([(1984,), (1990,)], "year int")
    assert screening.year_window(s) == (1985, 1990)
    with pytest.raises(ValueError):
        screening.year_window(s, 1983)
    with pytest.raises(ValueError):
        screening.year_window(s, 1990, 1989)


def test_years_of_each_stack(spark):
    s = spark.createDataFrame([(1, 1, 1990), (1, 1, 1993), (2, 1, 1991), (2, 1, 1992), (3, 1, 2000)], "path int, row int, year int")
    assert sorted(map(tuple, screening.stack_years(s).collect())) == [(1, 1, 1991, 1993), (2, 1, 1992, 1992), (3, 1, 2001, 2000)]
    kept = screening.within_years(s, screening.stack_years(s))
    assert sorted(map(tuple, kept.select("path", "row", "year").collect())) == [(1, 1, 1993), (2, 1, 1992)]
    for wrong in ({"start": 1983}, {"start": 1990, "end": 1989}, {"end": 1900}):
        with pytest.raises(ValueError):
            screening.stack_years(s, **wrong)
    with pytest.raises(ValueError):
        screening.stack_years(s.limit(0))


def test_last_definition_of_a_model(spark):
    table = lambda rows: spark.createDataFrame(rows, "key string, model string, position int")
    models = screening.model_table(table([("a", "x", 2), ("a", "y", 1), ("b", "x", 1)]), table([("b", "p", 5), ("b", "q", 4)]))
    assert dict(map(tuple, models.collect())) == {"a": "x", "b": "p"}


def test_scenes_are_listed_by_name(spark):
    files = ["/b/LT50350321990001XXX01.xml", "/a/LT50350321991001XXX01.xml", "/a/LT40350321999001XXX01.xml", "/a/LT50350321990001XXX01.aux.xml", "/a/LT50350321990001XXX01.xml"]
    got = screening.list_scenes(spark.createDataFrame([(f,) for f in files], "file string")).orderBy("position").collect()
    assert [r.file for r in got] == [files[2], files[4], files[0], files[1]] and [r.position for r in got] == [1, 2, 3, 4]


def test_regions_of_two_stacks_stay_apart(spark):
    rows = [(p, 1, 2001, 6, 160, f"s{p}", 0, y, 0, 98 if y < 2 else 10) for p in (1, 2) for y in range(4)]
    burn = spark.createDataFrame(rows, "path int, row int, year int, month int, julian int, scene_id string, qa int, y int, x int, burn_prob int")
    one = burn.withColumn("scene", F.struct("path", "row", F.lit("same").alias("scene")))
    labelled = regions.grown_runs(one, RegionOptions(90, 2, 75))
    got = annual.annual_burn(regions.burn_class(one, labelled)).collect()
    assert len(got) == 8 and sum(r.burn_count == 1 for r in got) == 4


def test_points_meet_all_scenes_of_equal_bounds(spark):
    from scorchmap.operators import placing

    scenes = spark.createDataFrame([(k, 0.0, 9000.0, 9000.0 + 3000 * (k % 2), 0.0, 30.0, 30.0) for k in range(6)], "o int, west double, north double, east double, south double, dx double, dy double")
    points = spark.createDataFrame([(1, 45.0, 8985.0), (2, 10000.0, 10.0), (3, 9000.0, 10.0), (4, 0.0, 10.0)], "point_id int, px double, py double")
    got = sorted((r.point_id, r.o, r.x, r.y) for r in placing.scenes_at(points, scenes).collect())
    assert got == [(1, k, 1, 0) for k in range(6)] + [(2, k, 333, 299) for k in (1, 3, 5)] + [(3, k, 300, 299) for k in (1, 3, 5)]


def test_models(spark):
    models = screening.default_models(spark)
    assert dict(models.groupBy("model").count().collect()) == {"gbt_mountain_west_model.xml": 681, "gbt_east_model.xml": 11, "gbt_arid_west_model.xml": 8, "gbt_gp_west_model.xml": 2}
    stacks = spark.createDataFrame([(15, 35), (99, 1)], "path int, row int")
    assert [r.model for r in screening.lookup_models(stacks, models).orderBy("path").collect()] == ["gbt_east_model.xml", "invalid"]
    with pytest.raises(ValueError):
        screening.lookup_models(stacks, models, required=True)


def _looks(spark, rows):
    df = spark.createDataFrame(rows, "year int, month int, julian int, qa int, b int")
    return df.select(F.lit(1).alias("path"), F.lit(1).alias("row"), F.lit(0).alias("y"), F.lit(0).alias("x"), "*", *(F.col("b").alias(c) for c in ("b1", "b2", "b3", "b4", "b5", "b7")))


def test_december_and_gaps(spark):
    looks = temporal.with_indices(_looks(spark, [(1999, 12, 350, 0, 100), (2000, 1, 10, 0, 101), (2000, 7, 190, -7, 500), (2002, 12, 350, 0, 100)]))
    got = {(r.season_year, r.season): (r.good_looks, r.b3) for r in temporal.seasonal_means(looks, (1999, 2002)).collect()}
    assert got == {(2000, "winter"): (2, 101), (2000, "summer"): (0, -9999)}
    dense = temporal.seasonal_dense(temporal.seasonal_means(looks, (1999, 2002)), looks.select("path", "row", "y", "x").distinct(), (1999, 2002))
    assert dense.count() == 16 and dense.where("good_looks = 0 and b3 = -9999").count() == 15
    assert {r.year for r in temporal.annual_max(looks).collect()} == {1999, 2000, 2002}


def test_previous_year_is_needed(spark):
    looks = temporal.with_indices(_looks(spark, [(2000, 1, 10, 0, 100), (2002, 1, 10, 0, 100)]))
    wide = temporal.seasonal_wide(temporal.seasonal_means(looks, (2000, 2002)))
    with pytest.raises(ValueError):
        features.previous_year(looks.where("year = 2002"), wide, temporal.annual_max(looks))
    loose = features.previous_year(looks.where("year = 2002"), wide, temporal.annual_max(looks), check_years=False).first()
    assert loose.max_nbr == -9999 and loose.winter_b3 == -9999
    assert len(features.FEATURES) == 50


def _grid(spark, text, marks):
    lines = text.split()
    return spark.createDataFrame([("s", y, x, marks[c]) for y, line in enumerate(lines) for x, c in enumerate(line)], "scene string, y int, x int, burn_prob int")


def test_corner_touch_makes_two_regions(spark):
    prob = _grid(spark, "##.. ##.. ..## ..##", {"#": 99, ".": 0})
    assert regions.seed_regions(prob, RegionOptions(seed_size=4)).count() == 2
    assert regions.seed_regions(prob).count() == 0
    assert regions.seed_regions(_grid(spark, "###.. ##...", {"#": 98, ".": 97})).count() == 1


def test_growth_and_classes(spark):
    prob = _grid(spark, "##### ooo=o ....o xX..#", {"#": 98, "o": 76, "=": 75, ".": 0, "x": -9998, "X": -9999})
    labelled = regions.grown_runs(prob)
    got = {(r.y, r.x): r.burn_class for r in regions.burn_class(prob, labelled).collect()}
    assert sum(v == 1 for v in got.values()) == 5 + 4 + 1 + 1 and got[1, 3] == 0 and got[3, 0] == -9998 and got[3, 1] == -9999


def test_filled_area(spark):
    options = RegionOptions(seed_size=3)
    closed = _grid(spark, "### #.# ###", {"#": 99, ".": 10})
    row = regions.patch_attributes(closed, regions.grown_runs(closed, options)).first()
    assert (row.area, row.filled_area, row.max_intensity, row.min_intensity) == (8, 9, 99, 99)
    opened = _grid(spark, "##. #.# ###", {"#": 99, ".": 10})
    row = regions.patch_attributes(opened, regions.grown_runs(opened, options)).first()
    assert (row.area, row.filled_area) == (7, 7)


def test_labels_do_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    rows = [(f"s{s}", y, x, rnd.choice([10, 80, 99])) for s in range(2) for y in range(12) for x in range(12)]
    prob = spark.createDataFrame(rows, "scene string, y int, x int, burn_prob int")
    options = RegionOptions(90, 2, 75)
    columns = ("scene", "y", "x0", "x1", "label")
    one = sorted(map(tuple, regions.grown_runs(prob.coalesce(1), options).select(*columns).collect()))
    assert one == sorted(map(tuple, regions.grown_runs(prob.repartition(7), options).select(*columns).collect())) and one


def test_annual_products(spark):
    rows = [("LE7b", 200, 90, 1, 0), ("LT5a", 100, 80, 1, 0), ("LT5c", 50, 10, 0, 0), ("LT5a", 1, -9999, -9999, 1), ("LT5b", 2, -9998, -9998, 1), ("LT5a", 1, -9999, -9999, 2)]
    burn = spark.createDataFrame(rows, "scene_id string, julian int, burn_prob int, burn_class int, x int").select("*", F.lit(1).alias("path"), F.lit(1).alias("row"), F.lit(0).alias("y"), F.lit(2000).alias("year"))
    pick = lambda df: {r.x: (r.burned_area, r.burn_count, r.good_looks_count, r.max_burn_prob) for r in df.collect()}
    assert pick(annual.annual_burn(burn)) == {0: (100, 2, 3, 90), 1: (0, 0, 0, -9998), 2: (-9999,) * 4}
    assert pick(annual.annual_burn(burn, "stack"))[0][0] == 200


def test_tree_scoring_styles_agree(spark):
    nodes = [n for k in range(2) for t in range(40) for n in ((k, t, 0, (k + t) % 3, 0.5 - t / 80, 1, 2, 0.0), (k, t, 1, None, 0.0, -1, -1, t / 10), (k, t, 2, None, 0.0, -1, -1, -k / 3))]
    few = trees.Ensemble(nodes[:120] + nodes[120:240], 0.1, 0.05, ("a", "b", "c"))
    df = spark.createDataFrame([(random.Random(k).random(), random.Random(k + 9).random(), -0.2) for k in range(50)], "a double, b double, c double")
    built = [r[0] for r in df.select(trees.tree_probability(few)).collect()]
    limit, trees.MAX_EXPRESSION_NODES = trees.MAX_EXPRESSION_NODES, 0
    try:
        walked = [r[0] for r in df.select(trees.tree_probability(few)).collect()]
    finally:
        trees.MAX_EXPRESSION_NODES = limit
    assert max(abs(a - b) for a, b in zip(built, walked, strict=True)) < 1e-12
    assert df.select(trees.tree_probability(few, wanted=5)).first()[0] == 0.0


def test_training_and_saving(spark, tmp_path):
    rnd = random.Random(1)
    rows = [tuple(rnd.random() for _ in features.FEATURES) for _ in range(400)]
    data = spark.createDataFrame([(*r, int(r[8] < 0.5)) for r in rows], [*features.FEATURES, "fire"])
    options = trees.TrainingOptions(5, 0.3, 2, 1.0, 0.8, 3)
    model, report = trees.train(data, options)
    assert report.first().test_error < 5
    model.write().overwrite().save(f"file://{tmp_path}/m")
    again = trees.train_or_load(None, None, f"file://{tmp_path}/m")
    looks = data.withColumn("qa", F.when(F.col("b1") < 0.1, -7).otherwise(0))
    scored = trees.score_looks(looks, again)
    assert scored.count() == 400 and scored.where("qa < 0 and burn_prob != -9998").count() == 0
    with pytest.raises(ValueError):
        trees.train_or_load(data, options, "x")


def test_grid_bbox_holds_all_scenes_of_both_origins(spark):
    import math

    from scorchmap.plans.queries import QUERIES, _scenes

    d = "/root/testdata/sf0.001"
    want = {}
    for r in _scenes(spark, d).select("path", "row", "ul_x", "ul_y", "grid_origin").collect():
        h = 15 if r.grid_origin == "CENTER" else 0
        want.setdefault((r.path, r.row), []).append((r.ul_x - h, r.ul_y + h))
    got = {(r.path, r.row): r for r in QUERIES["grid_bbox"](spark, d).collect()}
    assert got.keys() == want.keys()
    for k, corners in want.items():
        west, north = min(x for x, _ in corners), max(y for _, y in corners)
        east, south = max(x for x, _ in corners) + 6000, min(y for _, y in corners) - 4500
        assert (got[k].min_x, got[k].max_y) == (west, north)
        assert (got[k].max_x, got[k].min_y) == (west + 30 * math.ceil((east - west) / 30), north - 30 * math.ceil((north - south) / 30))


def test_point_scene_bounds_counts_every_scene(spark):
    from scorchmap.plans import views
    from scorchmap.plans.queries import QUERIES, _scenes

    d = "/root/testdata/sf0.001"
    scenes = [(r.o, r.ul_x, r.ul_y) for r in _scenes(spark, d).collect()]
    assert sum(o >= 200 for o, _, _ in scenes) > 0
    want = {}
    for p in views.view(spark, d, views.POINTS, "points").collect():
        for o, x, y in scenes:
            if x < p.px < x + 6000 and y - 4500 < p.py < y:
                want.setdefault((p.point_id, x, y, int((p.px - x) / 30), int((p.py - y) / -30)), []).append(o)
    got = {(r.point_id, r.west, r.north, r.x, r.y): (r.n_scenes, r.first_o, r.last_o) for r in QUERIES["point_scene_bounds"](spark, d).collect()}
    assert got == {k: (len(o), min(o), max(o)) for k, o in want.items()}
