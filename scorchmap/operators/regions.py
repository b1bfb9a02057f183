"""Burned regions: seeds, connected components, growing, patches.

Components are found in two levels. Pixels are dealt by scene and band, BAND lines; a task joins the pixels of a band to horizontal runs
and these to components by union-find in numpy. Only runs on the first and last lines of bands give edges between components of
different bands; those edges, as many as borders are long and not as areas are large, go through operators.components.

The id of a component is (scene, y, x) of its first pixel in raster order. Pixels are 4-neighbours, the background of a patch is joined
by 8 neighbours.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settings import FILL, RegionOptions
from ..storage import materialize
from .components import connected_components
from .screening import _small

#: Lines of a band: what a task holds is one band of a scene.
BAND = 256


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of the component of each of n nodes, from edges (a, b): hooking and pointer jumping until nothing changes."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    return label


def pixel_runs(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """y, x0, x1 of the runs of horizontally neighbouring pixels, in raster order; repeated pixels count once."""
    order = np.lexsort((x, y))
    y, x = y[order], x[order]
    starts = np.ones(len(y), bool)
    starts[1:] = (y[1:] != y[:-1]) | (x[1:] > x[:-1] + 1)
    starts = np.flatnonzero(starts)
    return y[starts], x[starts], x[np.append(starts[1:], len(x)) - 1] if len(x) else x


def touching(y: np.ndarray, x0: np.ndarray, x1: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of runs (in raster order) of neighbouring lines that touch within reach columns."""
    wide = int(x1.max(initial=0)) + reach + 2
    first, last = y * wide + x0, y * wide + x1
    # runs of the next line that neither end before a run begins nor begin after it ends
    low, high = np.searchsorted(last, (y + 1) * wide + np.maximum(x0 - reach, 0)), np.searchsorted(first, (y + 1) * wide + x1 + reach, "right")
    n = np.maximum(high - low, 0)
    a = np.repeat(np.arange(len(y)), n)
    return a, np.repeat(low - (np.cumsum(n) - n), n) + np.arange(len(a))


def _labels(y: np.ndarray, x0: np.ndarray, x1: np.ndarray, reach: int) -> np.ndarray:
    """The first run of the component of each run (in raster order)."""
    y = y.astype(np.int64) - int(y.min(initial=0))
    return joined(len(y), *touching(y, x0.astype(np.int64), x1.astype(np.int64), reach))


def _in_bands(rows: DataFrame, keys: list[str], label: Callable[[pa.Table], pa.Table], schema: T.StructType) -> DataFrame:
    """label() of the rows of each band of each scene."""
    return rows.withColumn("band", F.floor(F.col("y") / BAND).cast("int")).groupBy(*keys, "band").applyInArrow(label, schema)


def _fields(rows: DataFrame, columns: list[str], ints: list[str]) -> T.StructType:
    return T.StructType([rows.schema[c] for c in columns] + [T.StructField(c, T.IntegerType()) for c in ints])


def _ints(table: pa.Table, *columns: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy().astype(np.int64) for c in columns]


def _across_bands(found: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Edges (a, b) between components (keys.., y, x) of different bands. found: runs with local_y, local_x of their component in the band."""
    node = lambda p: F.struct(*(F.col(f"{p}{k}").alias(k) for k in keys), F.col(f"{p}local_y").alias("y"), F.col(f"{p}local_x").alias("x"))
    columns = [*keys, "y", "x0", "x1", "local_y", "local_x"]
    side = lambda p, rest: found.where(F.pmod("y", F.lit(BAND)) == rest).select(*(F.col(c).alias(f"{p}{c}") for c in columns))
    same = F.col("a_y") + 1 == F.col("b_y")
    for k in keys:
        same = same & (F.col(f"a_{k}") == F.col(f"b_{k}"))
    touch = (F.col("a_x0") <= F.col("b_x1") + reach) & (F.col("b_x0") <= F.col("a_x1") + reach)
    return side("a_", BAND - 1).join(side("b_", 0), same & touch).select(node("a_").alias("a"), node("b_").alias("b"))


def _labelled(found: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Adds first (the component's first run: keys.., y, x) to runs with local_y, local_x, a written table."""
    labels = connected_components(_across_bands(found, keys, reach))
    own = F.struct(*keys, F.col("local_y").alias("y"), F.col("local_x").alias("x"))
    labels = labels.withColumnRenamed("id", "_id")
    out = found.withColumn("_id", own).join(F.broadcast(labels) if _small(labels) else labels, "_id", "left")
    return out.withColumn("first", F.coalesce("component", "_id")).drop("_id", "component", "local_y", "local_x")


def band_runs(pixels: DataFrame) -> DataFrame:
    """Runs (scene, y, x0, x1) of pixels(scene, y, x), cut by nothing, with the first run of their component in the band (local_y, local_x)."""

    def label(table: pa.Table) -> pa.Table:
        y, x0, x1 = pixel_runs(*_ints(table, "y", "x"))
        first = _labels(y, x0, x1, 0)
        scene = pa.chunked_array([pa.repeat(table.column("scene")[0], len(y))])
        return pa.table({"scene": scene, **{n: pa.array(v.astype(np.int32)) for n, v in (("y", y), ("x0", x0), ("x1", x1), ("local_y", y[first]), ("local_x", x0[first]))}})

    return _in_bands(pixels.select("scene", "y", "x"), ["scene"], label, _fields(pixels, ["scene"], ["y", "x0", "x1", "local_y", "local_x"]))


def _banded(found: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Adds local_y, local_x to runs."""

    def label(table: pa.Table) -> pa.Table:
        y, x0, x1 = _ints(table, "y", "x0", "x1")
        order = np.lexsort((x0, y))
        first = _labels(y[order], x0[order], x1[order], reach)
        table = table.drop_columns(["band"]).take(pa.array(order))
        for name, v in (("local_y", y), ("local_x", x0)):
            table = table.append_column(name, pa.array(v[order][first].astype(np.int32)))
        return table

    return _in_bands(found, keys, label, _fields(found, found.columns, ["local_y", "local_x"]))


def components(pixels: DataFrame) -> DataFrame:
    """Runs of pixels(scene, y, x) with first_y, first_x of their 4-neighbour component."""
    found = _labelled(materialize(band_runs(pixels), "runs"), ["scene"], 0)
    return found.select("scene", "y", "x0", "x1", F.col("first.y").alias("first_y"), F.col("first.x").alias("first_x"))


def seed_regions(prob: DataFrame, options: RegionOptions = RegionOptions()) -> DataFrame:
    """scene, first_y, first_x, area of the regions of seed pixels that are large enough; prob: scene, y, x, burn_prob."""
    found = components(prob.where(F.col("burn_prob") >= options.seed_threshold))
    area = F.sum(F.col("x1") - F.col("x0") + 1).cast("long")
    return found.groupBy("scene", "first_y", "first_x").agg(area.alias("area")).where(F.col("area") >= options.seed_size)


def grown_runs(prob: DataFrame, options: RegionOptions = RegionOptions()) -> DataFrame:
    """Runs of patches with their label: components above the growing threshold that hold the first pixel of a seed region.

    Labels are 1, 2, .. for each scene in raster order of the patches' first pixels.
    """
    seeds = seed_regions(prob, options).select("scene", F.col("first_y").alias("y"), F.col("first_x").alias("seed_x"))
    grown = materialize(components(prob.where((F.col("burn_prob") > options.grow_threshold) & (F.col("burn_prob") != FILL))), "grown")
    hit = grown.join(seeds, ["scene", "y"]).where("seed_x between x0 and x1").select("scene", "first_y", "first_x").distinct()
    order = Window.partitionBy("scene").orderBy("first_y", "first_x")
    label = hit.withColumn("label", F.row_number().over(order))
    return grown.join(label, ["scene", "first_y", "first_x"])


def with_runs(prob: DataFrame, labelled: DataFrame, inside: bool = False) -> DataFrame:
    """The pixels of prob with the label of the run that holds each (null: none; inside: only those that have one).

    Both are dealt by scene and band and merged there: a pixel's run is the last one that begins at or before it, if it ends at or after
    it. No run is spread out into pixels.
    """
    band = F.floor(F.col("y") / BAND).cast("int")
    schema = _fields(prob, prob.columns, ["label"])

    def merge(pixels: pa.Table, found: pa.Table) -> pa.Table:
        y, x = _ints(pixels, "y", "x")
        line, x0, x1, label = _ints(found, "y", "x0", "x1", "label")
        pixels = pixels.drop_columns(["band"])
        own, hit = np.zeros(len(y), np.int64), np.zeros(len(y), bool)
        if len(line) and len(y):
            wide = int(max(x.max(), x1.max())) + 1
            order = np.argsort(line * wide + x0)
            at = np.searchsorted((line * wide + x0)[order], y * wide + x, "right") - 1
            own = order[np.maximum(at, 0)]
            hit = (at >= 0) & (line[own] == y) & (x1[own] >= x)
        out = pixels.append_column("label", pa.array(label[own].astype(np.int32) if len(line) else np.zeros(len(y), np.int32), mask=~hit))
        return out.filter(pa.array(hit)) if inside else out

    runs = labelled.select("scene", "y", "x0", "x1", "label").withColumn("band", band)
    return prob.withColumn("band", band).groupBy("scene", "band").cogroup(runs.groupBy("scene", "band")).applyInArrow(merge, schema)


def burn_class(prob: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds burn_class: the patch label, the code where the probability is one, else 0."""
    code = F.coalesce("label", F.when(F.col("burn_prob") < 0, F.col("burn_prob")), F.lit(0)).cast("int")
    return with_runs(prob, labelled).withColumn("burn_class", code).drop("label")


def filled_area(labelled: DataFrame) -> DataFrame:
    """scene, label, hole_area: background within a patch that no 8-neighbour path joins to the edge of its box."""
    box = labelled.groupBy("scene", "label").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x0").alias("left"), F.max("x1").alias("right"), F.sum(F.col("x1") - F.col("x0") + 1).alias("area"))
    holed = box.where("area < (y1 - y0 + 1) * (right - left + 1) and y1 - y0 > 1 and right - left > 1").drop("area")
    rows = labelled.join(holed, ["scene", "label"])
    line = Window.partitionBy("scene", "label", "y").orderBy("x0")
    rows = rows.withColumns({"next": F.lead("x0").over(line), "last": F.lag("x0").over(line)})
    after = F.coalesce(F.col("next") - 1, F.col("right"))
    before = F.when(F.col("last").isNull(), F.struct(F.col("left").alias("x0"), (F.col("x0") - 1).alias("x1")))
    gaps = rows.select("scene", "label", "y", "y0", "y1", "left", "right", F.explode(F.array(F.struct((F.col("x1") + 1).alias("x0"), after.alias("x1")), before)).alias("g"))
    gaps = gaps.where("g is not null and g.x0 <= g.x1").select("scene", "label", "y", "g.x0", "g.x1", F.expr("y = y0 or y = y1 or g.x0 = left or g.x1 = right").alias("outside"))
    gaps = gaps.select("scene", "label", *(F.col(c).cast("int").alias(c) for c in ("y", "x0", "x1")), "outside")
    found = _labelled(materialize(_banded(gaps, ["scene", "label"], 1), "gaps"), ["scene", "label"], 1)
    each = found.groupBy("scene", "label", "first").agg(F.max("outside").alias("outside"), F.sum(F.col("x1") - F.col("x0") + 1).alias("n"))
    return each.where(~F.col("outside")).groupBy("scene", "label").agg(F.sum("n").cast("long").alias("hole_area"))


def patch_attributes(prob: DataFrame, labelled: DataFrame) -> DataFrame:
    """scene, label, area, filled_area and the greatest, mean and least probability of each patch."""
    inside = with_runs(prob.select("scene", "y", "x", "burn_prob"), labelled, inside=True)
    out = inside.groupBy("scene", "label").agg(F.count("*").alias("area"), F.max("burn_prob").alias("max_intensity"), F.avg(F.col("burn_prob").cast("double")).alias("mean_intensity"), F.min("burn_prob").alias("min_intensity"))
    out = out.join(filled_area(labelled), ["scene", "label"], "left")
    return out.select("scene", "label", "area", (F.col("area") + F.coalesce("hole_area", F.lit(0))).cast("long").alias("filled_area"), "max_intensity", "mean_intensity", "min_intensity")
