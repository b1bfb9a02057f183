"""Scenes on the common grid, points against scenes, slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import map_to_pixel
from .screening import _small


#: Parts of a pixel by which grids may be apart and still count as in phase.
PHASE = 1e-6


def align(looks: DataFrame, grids: DataFrame, common: DataFrame, resample: str | None = None) -> DataFrame:
    """Moves scene-local y, x to the common grid of the stack.

    grids: scene_id, path, row, west, north, dx, dy (positive); common: path, row, west, north (of grids that share the pixel size).
    Without resample, grids must share their phase: looks then only move by whole pixels, and a scene out of phase is an error. With
    resample="nearest" each pixel of the common grid takes the look of its scene's pixel that its centre lies in; a centre on an edge
    between two pixels lies in the one to the east, or south.
    """
    if resample not in (None, "nearest"):
        raise ValueError(f"resample is None or nearest, not {resample}")
    shift = grids.join(common.select("path", "row", F.col("west").alias("_w"), F.col("north").alias("_n")), ["path", "row"])
    down, right = (F.col("_n") - F.col("north")) / F.col("dy"), (F.col("west") - F.col("_w")) / F.col("dx")
    if resample is None:
        apart = shift.where(F.greatest(F.abs(down - F.round(down)), F.abs(right - F.round(right))) > PHASE).limit(1).collect()
        if apart:
            raise ValueError(f"{apart[0].scene_id} is out of phase with the grid of its stack: resample it")
        moves = (F.round(down), F.round(right))
    else:
        # the pixel of the common grid whose centre is in pixel p of the scene: p <= c + 1/2 - shift < p + 1; shifts within PHASE are whole
        moves = tuple(F.when(F.abs(v - F.round(v)) <= PHASE, F.round(v)).otherwise(F.ceil(v - 0.5)) for v in (down, right))
    shift = shift.select("scene_id", *(m.cast("int").alias(n) for m, n in zip(moves, ("_dy", "_dx"), strict=True)))
    joined = looks.join(F.broadcast(shift) if _small(shift) else shift, "scene_id")
    return joined.withColumns({"y": F.col("y") + F.col("_dy"), "x": F.col("x") + F.col("_dx")}).drop("_dy", "_dx")


def scenes_at(points: DataFrame, scenes: DataFrame, cell: float = 6000.0) -> DataFrame:
    """Pairs of points (point_id, px, py) and the scenes whose bounds strictly hold them, with the pixel there.

    Scenes of equal bounds, as most of a stack are, meet the points as one. Bounds and points are dealt by square cells of map space,
    bounds into all that they cover, so that the range join is an equi-join; scenes join those bounds that hold a point.
    """
    bounds = ["west", "north", "east", "south", "dx", "dy"]
    found = points_in(points, scenes.select(*bounds).distinct(), cell)
    return found.join(scenes, bounds)


def points_in(points: DataFrame, scenes: DataFrame, cell: float = 6000.0) -> DataFrame:
    """The same for bounds that are few for each place."""
    spot = points.withColumns({"_cx": F.floor(F.col("px") / cell), "_cy": F.floor(F.col("py") / cell)})
    cover = scenes.select("*", F.explode(F.sequence(F.floor(F.col("west") / cell), F.floor(F.col("east") / cell))).alias("_cx"))
    cover = cover.select("*", F.explode(F.sequence(F.floor(F.col("south") / cell), F.floor(F.col("north") / cell))).alias("_cy"))
    found = spot.join(cover, ["_cx", "_cy"]).where("px > west and px < east and py > south and py < north")
    column, line = map_to_pixel(F.col("px"), F.col("py"), F.col("west"), F.col("north"), F.col("dx"), -F.col("dy"))
    return found.withColumns({"x": column, "y": line}).drop("_cx", "_cy")


def point_stack(points: DataFrame, scenes: DataFrame, looks: DataFrame, columns: list[str]) -> DataFrame:
    """point_id, scene_id and the columns of the look that each point has in each scene that holds it.

    Points get one row for each different bounds that hold them, never one for each scene; looks take the bounds of their scene and meet
    the points by bounds and pixel.
    """
    bounds = ["west", "north", "east", "south", "dx", "dy"]
    keys = ["_bounds", "y", "x"]
    found = points_in(points, scenes.select(*bounds).distinct()).select("point_id", F.struct(*bounds).alias("_bounds"), "y", "x")
    of = scenes.select("scene_id", F.struct(*bounds).alias("_bounds"))
    placed = looks.select("scene_id", "y", "x", *columns).join(F.broadcast(of) if _small(of) else of, "scene_id")
    spots = found.select(*keys).distinct()
    if _small(spots):
        placed = placed.join(F.broadcast(spots), keys, "left_semi")  # points at few pixels: other looks stay where they are
    if _small(found):
        found = F.broadcast(found)
    return found.join(placed, keys).select("point_id", "scene_id", "y", "x", *columns)


def line_slice(looks: DataFrame, columns: list[str], line: int | None = None, map_y: float | None = None, north: float = 0.0, south: float = 0.0, dy: float = 30.0) -> DataFrame:
    """Columns of one line, by its number or by a map y strictly within the bounds (else nothing)."""
    keys = ["scene_id", "y", "x"]
    if line is None:
        if map_y is None or not south < map_y < north:
            return looks.select(*keys, *columns).limit(0)
        line = int((north - map_y) / dy)
    return looks.where(F.col("y") == line).select(*keys, *columns)
