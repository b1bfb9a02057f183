"""Tables of seasons and maxima that are kept from year to year, against the same made from all looks at once."""

import random

import pytest
from pyspark.sql import functions as F

from scorchmap.functions.quality import qa_code
from scorchmap.operators import temporal
from scorchmap.operators.features import FEATURES
from scorchmap.operators.screening import stack_years
from scorchmap.plans import pipeline
from scorchmap.plans.yearly import YearlyState
from scorchmap.settings import BANDS, INDICES, MEASURES
from scorchmap.storage import new_path

QA = ("qa_fill", "qa_cloud", "qa_adjacent", "qa_shadow", "qa_snow", "qa_water")


@pytest.fixture(scope="module")
def looks(spark):
    rnd, rows = random.Random(5), []
    for path, first in ((7, 1990), (8, 1992)):
        for year in range(first, first + 4):
            for month in (1, 4, 12):
                for y in range(4):
                    for x in range(5):
                        if rnd.random() < 0.8:
                            bands = [None if rnd.random() < 0.05 else rnd.randrange(100, 3000) for _ in BANDS]
                            rows.append((f"s{path}{year}{month:02d}", path, 3, year, month, month * 30 - 10, y, x, *bands, *(int(rnd.random() < 0.06) for _ in QA)))
    types = "scene_id string, path int, row int, year int, month int, julian int, y int, x int, " + ", ".join(f"{c} int" for c in (*BANDS, *QA))
    return pipeline.materialize(spark.createDataFrame(rows, types).withColumn("qa", qa_code()), "looks")


def rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


SEASON = ("path", "row", "y", "x", "season_year", "season", "good_looks", *MEASURES)
YEAR = ("path", "row", "y", "x", "year", *INDICES)
LOOK = ("scene_id", "y", "x", *FEATURES)


def same(state, looks):
    stored = temporal.with_indices(looks)
    assert rows(state.seasonal(), SEASON) == rows(temporal.seasonal_means(stored, stack_years(looks)), SEASON)
    assert rows(state.annual_max(), YEAR) == rows(temporal.annual_max(stored), YEAR)


def test_batches_give_what_all_looks_give(spark, looks):
    folder = new_path(spark, "state")
    state = YearlyState(spark, folder, buckets=2, side=2)
    parts = {"early": "year < 1992", "late": "year > 1992", "rest": "year = 1992 and month > 1", "winter": "year = 1992 and month = 1"}
    seen = "false"
    for name, where in parts.items():
        assert state.add(name, looks.where(where))
        seen += f" or ({where})"
        if name == "late":
            same(state, looks.where(seen))
    assert not state.add("early", looks.where("year < 1992"))
    with pytest.raises(ValueError, match="is there already"):
        state.add("again", looks.where("year = 1991"))
    # what the refused batch wrote is not read, see below
    # the winter of 1992 has looks of December 1991 and January 1992, and only touched years have a new version
    winter = {(r.kind, r.year) for r in state.commits().where("batch = 'winter' and kind <> 'scene'").collect()}
    assert winter == {("looks", 1992), ("seasonal", 1992), ("maxima", 1992)}
    want = rows(pipeline.featured_looks(looks), LOOK)
    assert len(want) > 200 and rows(state.featured(), LOOK) == want
    # another session finds the folder as it is
    for kind in ("looks", "seasonal", "maxima"):
        spark.sql(f"DROP TABLE {state._name}_{kind}")
    other = YearlyState(spark, folder, buckets=99, side=77)
    assert (other.buckets, other.side) == (2, 2)
    assert rows(other.featured(), LOOK) == want
    other.vacuum()
    same(other, looks)
    only = rows(other.featured([1993]), ("year", *LOOK))
    assert {r[0] for r in only} == {1993} and [r[1:] for r in only] == rows(pipeline.featured_looks(looks).where("year = 1993"), LOOK)


def test_scoring_shuffles_nothing(spark, looks):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = YearlyState(spark, new_path(spark, "state"), buckets=2, side=2)
        state.add("a", looks.where("year < 1993"))
        state.add("b", looks.where("year >= 1993"))
        with pipeline.kept_in_place(spark):
            plan = state.featured([1993])._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") >= 2 and "Exchange hashpartitioning" not in plan, plan
            assert "Exchange hashpartitioning" not in state.annual_max()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_batch_that_broke_off(spark, looks, monkeypatch):
    state = YearlyState(spark, new_path(spark, "state"), buckets=2, side=3)
    state.add("a", looks.where("year < 1992"))
    merge = YearlyState._merge

    def broken(self, kind, *rest):
        merge(self, kind, *rest)
        if kind == "seasonal":
            raise RuntimeError("lost")

    monkeypatch.setattr(YearlyState, "_merge", broken)
    with pytest.raises(RuntimeError):
        state.add("b", looks.where("year >= 1992"))
    monkeypatch.undo()
    same(state, looks.where("year < 1992"))
    # the next attempt has fewer looks; nothing of the first one is left
    state.add("b", looks.where("year = 1992"))
    same(state, looks.where("year <= 1992"))


def test_gaps_and_names(spark, looks):
    state = YearlyState(spark, new_path(spark, "state"), buckets=2)
    with pytest.raises(ValueError, match="no name"):
        state.add("a'b", looks)
    state.add("a", looks.where("year <> 1992 and path = 7").withColumn("a `b.c", F.lit(1)))
    with pytest.raises(ValueError, match="year before"):
        state.featured()
    assert state.featured([1991]).where("`a ``b.c` = 1").count() == looks.where("year = 1991 and path = 7").count()
