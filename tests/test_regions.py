"""Two-level labelling and the merge of runs and pixels, against plain searches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorchmap.operators import regions
from scorchmap.settings import RegionOptions


def flood(cells, near):
    """The first cell in raster order of the component of each cell."""
    first = {}
    for c in sorted(cells):
        if c not in first:
            first[c], todo = c, [c]
            while todo:
                y, x = todo.pop()
                for dy, dx in near:
                    n = (y + dy, x + dx)
                    if n in cells and n not in first:
                        first[n] = c
                        todo.append(n)
    return first


FOUR, EIGHT = ((0, 1), (0, -1), (1, 0), (-1, 0)), tuple((a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b)


@pytest.mark.parametrize("reach, near", [(0, FOUR), (1, EIGHT)])
def test_labels_of_a_band(reach, near):
    for seed in range(12):
        rng = np.random.default_rng(seed)
        mask = rng.random((rng.integers(1, 30), rng.integers(1, 40))) < rng.choice([0.3, 0.5, 0.6, 0.8])
        y, x0, x1 = regions.pixel_runs(*(v.astype(np.int64) for v in np.nonzero(mask)))
        first = regions._labels(y + 5, x0, x1, reach)
        want = flood(set(zip(*(v.tolist() for v in np.nonzero(mask)), strict=True)), near)
        got = {(a, x): (y[f], x0[f]) for a, p, q, f in zip(y.tolist(), x0.tolist(), x1.tolist(), first.tolist(), strict=True) for x in range(p, q + 1)}
        assert got == want


def test_runs_of_repeated_pixels():
    y, x0, x1 = regions.pixel_runs(np.array([1, 0, 0, 0, 0, 1]), np.array([5, 2, 1, 2, 4, 5]))
    assert list(zip(y, x0, x1, strict=True)) == [(0, 1, 2), (0, 4, 4), (1, 5, 5)]
    assert [len(v) for v in regions.pixel_runs(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0, 0]


@pytest.mark.parametrize("band", [3, 7, 256])
def test_components_across_bands(spark, monkeypatch, band):
    monkeypatch.setattr(regions, "BAND", band)
    rnd = random.Random(band)
    cells = {s: {(y, x) for y in range(25) for x in range(30) if rnd.random() < 0.62} for s in ("a", "b")}
    cells["b"] |= {(y, 0) for y in range(25)}
    pixels = spark.createDataFrame([(s, y, x) for s, c in cells.items() for y, x in c], "scene string, y int, x int").repartition(5)
    got = {(r.scene, r.y, x): (r.first_y, r.first_x) for r in regions.components(pixels).collect() for x in range(r.x0, r.x1 + 1)}
    assert got == {(s, y, x): f for s, c in cells.items() for (y, x), f in flood(c, FOUR).items()}
    assert regions.components(pixels.limit(0)).count() == 0


def test_edges_grow_with_borders_and_not_with_areas(spark, monkeypatch):
    """A comb of columns is one run a line and tooth: all runs would give an edge each, bands only those of their borders."""
    monkeypatch.setattr(regions, "BAND", 16)
    made = []
    for lines in (64, 256):
        pixels = spark.range(lines * 40).selectExpr("'s' AS scene", "CAST(id DIV 40 AS INT) AS y", "CAST(id % 40 AS INT) * 2 AS x")
        edges = regions._across_bands(regions.band_runs(pixels), ["scene"], 0)
        made.append(edges.count())
        assert made[-1] == 40 * (lines // 16 - 1)
    assert made[1] < 256 * 40 / 16


@pytest.mark.parametrize("band", [2, 256])
def test_runs_meet_pixels(spark, monkeypatch, band):
    monkeypatch.setattr(regions, "BAND", band)
    rnd = random.Random(1)
    rows = [("s", y, x, rnd.randrange(100)) for y in range(9) for x in range(20) if rnd.random() < 0.8] * 2 + [("t", 0, 0, 5)]
    runs = [("s", y, a, a + rnd.randrange(4), y * 10 + a) for y in range(0, 9, 2) for a in range(0, 20, 5)] + [("u", 0, 0, 3, 1)]
    prob, labelled = spark.createDataFrame(rows, "scene string, y int, x int, burn_prob int"), spark.createDataFrame(runs, "scene string, y int, x0 int, x1 int, label int")
    label = lambda s, y, x: next((k for t, line, a, b, k in runs if (t, line) == (s, y) and a <= x <= b), None)
    got = regions.with_runs(prob, labelled)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((*r, label(*r[:3]))) for r in rows)
    assert got._jdf.queryExecution().executedPlan().toString().count("Generate") == 0
    assert regions.with_runs(prob, labelled, inside=True).count() == sum(label(*r[:3]) is not None for r in rows)
    assert regions.with_runs(prob, labelled.limit(0)).where("label IS NULL").count() == len(rows)
    assert regions.with_runs(prob.limit(0), labelled).count() == 0


def test_the_plan_of_burn_class_spreads_no_runs(spark):
    prob = spark.range(400).selectExpr("'s' AS scene", "CAST(id DIV 20 AS INT) AS y", "CAST(id % 20 AS INT) AS x", "CAST(99 - (id % 7) * 9 AS INT) AS burn_prob")
    out = regions.burn_class(prob, regions.grown_runs(prob, RegionOptions(90, 2, 75)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "FlatMapCoGroupsInArrow" in plan
    assert out.where("burn_class > 0").count() > 0 and out.groupBy("scene").agg(F.max("burn_class")).count() == 1
