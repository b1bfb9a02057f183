"""The registered queries on fire-scar mapping, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import map_to_pixel, pixel_to_map
from ..functions.indices import FURTHER, feature_index, further_index
from ..functions.quality import product_code, qa_code
from ..functions.scenes import date_parts, scene_id_parts, season
from ..operators import annual, boosting, features, placing, regions, screening, temporal, trees
from ..settings import BANDS, FILL, INDICES, MEASURES, PIXEL, SEASONS, RegionOptions
from ..sources.metadata import EXTENT, STACK, mtl_values, read_extent, read_scene_xml, read_stack, read_training, write_extent, write_stack, write_training
from ..sources.rasters import read_envi, read_spots, write_envi, write_products
from ..storage import materialize, new_path, release
from . import pipeline, views
from .yearly import YearlyState

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


def _scenes(spark: SparkSession, d: str) -> DataFrame:
    return views.view(spark, d, views.SCENES, "scenes")


def _obs(spark: SparkSession, d: str) -> DataFrame:
    return views.view(spark, d, views.OBS, "obs")


def _looks(spark: SparkSession, d: str) -> DataFrame:
    return _obs(spark, d).withColumn("qa", qa_code())


def _stored(spark: SparkSession, d: str) -> DataFrame:
    return temporal.with_indices(_looks(spark, d))


def _years(looks: DataFrame) -> tuple[int, int]:
    return tuple(looks.agg(F.min("year"), F.max("year")).first())


def _featured(spark: SparkSession, d: str) -> DataFrame:
    """Featured looks, dealt by tile once for all aggregations and joins."""
    pipeline.keep_in_place(spark)
    return pipeline.featured_looks(materialize(_looks(spark, d), "looks"), tile_side=16)


def _burn_prob(spark: SparkSession, d: str) -> DataFrame:
    code = F.when(F.col("qa") == FILL, FILL).when(F.col("qa") < 0, -9998).otherwise(F.col("raw_prob"))
    scene = (F.col("year") * 10 + F.floor((F.col("month") - 1) / 6)).cast("int").alias("scene")
    return _looks(spark, d).groupBy(scene, "y", "x").agg(F.max(code).cast("int").alias("burn_prob"))


_REGION = RegionOptions(seed_threshold=90, seed_size=3, grow_threshold=75)
_S, _O, _Q, _L, _B = (f"WITH {c} " for c in (views.SCENES, views.OBS, views.OBS_QA, views.LOOKS, views.BURN_PROB))
_PIX = ", ".join(PIXEL)
_PARTS = "CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(dayofmonth(d) AS INT) AS day, CAST(dayofyear(d) AS INT) AS julian"
_SEASON = "CASE WHEN {m} IN (12, 1, 2) THEN 'winter' WHEN {m} <= 5 THEN 'spring' WHEN {m} <= 8 THEN 'summer' ELSE 'fall' END"


# ---- the catalogue


@registered(_S + "SELECT file, scene_id, CAST(row_number() OVER (ORDER BY file, o) AS BIGINT) AS position FROM (SELECT DISTINCT file, scene_id, 0 AS o FROM scenes WHERE NOT file LIKE '%.aux.xml')")
def scene_list(spark: SparkSession, d: str) -> DataFrame:
    files = _scenes(spark, d).select("file", "scene_id").distinct()
    return screening.list_scenes(files).select("file", "scene_id", "position")


@registered(_S + "SELECT o, CASE WHEN o % 23 = 0 THEN NULL ELSE data_type END AS data_type, rmse, cloud_cover FROM scenes")
def mtl_parse(spark: SparkSession, d: str) -> DataFrame:
    s = _scenes(spark, d)
    said = [F.concat(F.lit("    DATA_TYPE = \""), "data_type", F.lit("\"")), F.concat(F.lit("GEOMETRIC_RMSE_MODEL = "), F.col("rmse").cast("string")), F.concat(F.lit("  CLOUD_COVER = "), F.col("cloud_cover").cast("string")), F.lit("END_GROUP = IMAGE"), F.lit("END")]
    lines = s.select(F.col("o").alias("scene_id"), F.explode(F.array(*said)).alias("line")).where("line is not null")
    return mtl_values(lines).withColumnRenamed("scene_id", "o")


@registered(_S + f"SELECT o, file, {_PARTS}, {_SEASON.format(m='month(d)')} AS season, path, row, sensor AS satellite, ul_x AS west, CAST(ul_x + ncol * dx AS DOUBLE) AS east, ul_y AS north, CAST(ul_y - nrow * dy AS DOUBLE) AS south, nrow, ncol, dx, dy, utm_zone FROM scenes")
def stack_catalogue(spark: SparkSession, d: str) -> DataFrame:
    rows = screening.catalogue(_scenes(spark, d).drop("d"))
    return rows.select("o", "file", "year", "month", "day", "julian", "season", "path", "row", F.col("sensor").alias("satellite"), F.col("ul_x").alias("west"), (F.col("ul_x") + F.col("ncol") * F.col("dx")).alias("east"), F.col("ul_y").alias("north"), (F.col("ul_y") - F.col("nrow") * F.col("dy")).alias("south"), "nrow", "ncol", "dx", "dy", "utm_zone")


@registered(_S + """SELECT path, row, CAST(min(ul_x - h) AS DOUBLE) AS west, CAST(max(ul_y + h) AS DOUBLE) AS north, CAST(max(lr_x + h) AS DOUBLE) AS east, CAST(min(lr_y - h) AS DOUBLE) AS south
FROM (SELECT *, CASE WHEN grid_origin = 'CENTER' THEN 15.0 ELSE 0.0 END AS h FROM scenes) s GROUP BY path, row""")
def max_extent(spark: SparkSession, d: str) -> DataFrame:
    out = screening.max_extent(_scenes(spark, d))
    return out.select("path", "row", *(F.col(c).cast("double").alias(c) for c in ("west", "north", "east", "south")))


@registered(_S + "SELECT o, substr(scene_id, 1, 3) AS sensor, CAST(substr(scene_id, 4, 3) AS INT) AS path, CAST(substr(scene_id, 7, 3) AS INT) AS row, CAST(substr(scene_id, 10, 4) AS INT) AS year FROM scenes")
def scene_id_parse(spark: SparkSession, d: str) -> DataFrame:
    return _scenes(spark, d).select("o", *(c.alias(n) for n, c in scene_id_parts().items()))


@registered(_S + f"SELECT o, {_PARTS} FROM scenes")
def acq_date_parts(spark: SparkSession, d: str) -> DataFrame:
    parts = date_parts("acq_date")
    return _scenes(spark, d).select("o", *(parts[n].alias(n) for n in ("year", "month", "day", "julian")))


@registered(_S + f"SELECT o, {_SEASON.format(m='month(d)')} AS season FROM scenes")
def season_label(spark: SparkSession, d: str) -> DataFrame:
    return _scenes(spark, d).select("o", season(F.month("d")).alias("season"))


_SCREEN = "CASE WHEN data_type = 'L1G' THEN 'l1g' WHEN rmse > 10.0 THEN 'rmse' WHEN cloud_cover > 80.0 THEN 'cloud' END"


@registered(_S + f"SELECT o, scene_id, {_SCREEN} AS exclude_reason FROM scenes")
def scene_screen(spark: SparkSession, d: str) -> DataFrame:
    return screening.screen(_scenes(spark, d)).select("o", "scene_id", "exclude_reason")


@registered(_S + "SELECT o, scene_id, CAST(year(d) AS INT) AS year FROM scenes WHERE year(d) > (SELECT min(year(d)) FROM scenes) AND year(d) <= (SELECT max(year(d)) FROM scenes)")
def year_window(spark: SparkSession, d: str) -> DataFrame:
    s = screening.catalogue(_scenes(spark, d).drop("d"))
    return s.where(F.col("year").between(*screening.year_window(s))).select("o", "scene_id", "year")


@registered(_S + "SELECT o, s.path, s.row, CAST(year(d) AS INT) AS year FROM scenes s JOIN (SELECT path, row, min(year(d)) AS first FROM scenes GROUP BY path, row) f ON s.path = f.path AND s.row = f.row WHERE year(d) > first")
def scorable_scenes(spark: SparkSession, d: str) -> DataFrame:
    return screening.scorable(screening.catalogue(_scenes(spark, d).drop("d"))).select("o", "path", "row", "year")


@registered(_S + f"""SELECT e.path, e.row, e.year, season, n_season, n_year FROM
(SELECT path, row, CAST(year(d) AS INT) AS year, {_SEASON.format(m='month(d)')} AS season, count(*) AS n_season FROM scenes GROUP BY 1, 2, 3, 4) e JOIN
(SELECT path, row, CAST(year(d) AS INT) AS year, count(*) AS n_year FROM scenes GROUP BY 1, 2, 3) y ON e.path = y.path AND e.row = y.row AND e.year = y.year""")
def scene_counts(spark: SparkSession, d: str) -> DataFrame:
    return screening.scene_counts(screening.catalogue(_scenes(spark, d).drop("d"))).select("path", "row", "year", "season", "n_season", "n_year")


_MODEL = "CASE " + " ".join(f"WHEN key IN ({', '.join(repr(k) for k in keys)}) THEN '{m}'" for m, keys in screening.OTHER_MODELS.items()) + f" WHEN path BETWEEN 10 AND 48 AND row BETWEEN 26 AND 43 THEN '{screening.USUAL_MODEL}' ELSE 'invalid' END"


@registered(_S + f"SELECT o, key, {_MODEL} AS model FROM (SELECT *, lpad(CAST(path AS STRING), 3, '0') || lpad(CAST(row AS STRING), 3, '0') AS key FROM scenes) s")
def model_lookup(spark: SparkSession, d: str) -> DataFrame:
    return screening.lookup_models(_scenes(spark, d), screening.default_models(spark)).select("o", "key", "model")


# ---- looks


_KEY = "scene_id, y, x"


@registered(_Q + f"SELECT {_KEY}, qa FROM obs_qa")
def qa_combine(spark: SparkSession, d: str) -> DataFrame:
    return _looks(spark, d).select("scene_id", "y", "x", "qa")


@registered(_O + f"SELECT {_KEY}, CAST(CASE WHEN qa_fill > 0 THEN -9999 WHEN qa_cloud > 0 THEN -7 WHEN qa_shadow > 0 THEN -6 WHEN qa_adjacent > 0 THEN -5 WHEN qa_snow > 0 THEN -4 WHEN qa_water > 0 THEN -3 ELSE 0 END AS INT) AS qa FROM obs")
def qa_combine_point(spark: SparkSession, d: str) -> DataFrame:
    return _obs(spark, d).select("scene_id", "y", "x", qa_code("point").alias("qa"))


@registered(_L + f"SELECT {_KEY}, ndvi, ndmi, nbr, nbr2 FROM looks")
def spectral_indices(spark: SparkSession, d: str) -> DataFrame:
    return _stored(spark, d).select("scene_id", "y", "x", *INDICES)


@registered(_Q + f"SELECT {_KEY}, " + ", ".join(f"{e} AS {n}" for n, e in views.FEATURE.items()) + " FROM obs_qa")
def feature_indices(spark: SparkSession, d: str) -> DataFrame:
    return _looks(spark, d).select("scene_id", "y", "x", *(feature_index(n).alias(n) for n in INDICES))


_EXTRA = {
    "csi": "B4 / B5",
    "mirbi": "10 * B7 - 9.5 * B5 + 2",
    "bai": "1.0 / ((B4 - 0.06) * (B4 - 0.06) + (B3 - 0.1) * (B3 - 0.1))",
    "baim": "1.0 / ((B4 - 0.05) * (B4 - 0.05) + (B5 - 0.2) * (B5 - 0.2))",
    "baim2": "1.0 / ((B4 - 0.05) * (B4 - 0.05) + (B7 - 0.2) * (B7 - 0.2))",
    "savi": "1.5 * (B4 - B3) / (B4 + B3 + 0.5)",
    "evi": "CASE WHEN B4 + 6 * B3 - 7.5 * B1 + 1 = 0 THEN 0.0 ELSE 2.5 * (B4 - B3) / (B4 + 6 * B3 - 7.5 * B1 + 1) END",
    "evi2": "2.5 * (B4 - B3) / (B4 + 2.4 * B3 + 1)",
}


def _as_double(sql: str) -> str:
    for k in (1, 3, 4, 5, 7):
        sql = sql.replace(f"B{k}", f"CAST(b{k} AS DOUBLE)")
    return sql


@registered(_O + f"SELECT {_KEY}, " + ", ".join(f"round(CAST({_as_double(e)} AS DOUBLE), 9) AS {n}" for n, e in _EXTRA.items()) + " FROM obs")
def extra_indices(spark: SparkSession, d: str) -> DataFrame:
    return _obs(spark, d).select("scene_id", "y", "x", *(F.round(further_index(n), 9).alias(n) for n in FURTHER))


# ---- grids


@registered(_S + "SELECT o, CAST(ul_x + (o % 200) * 30.0 + (o % 150) * 0.0 AS DOUBLE) AS map_x, CAST(ul_y + (o % 200) * 0.0 + (o % 150) * -30.0 AS DOUBLE) AS map_y FROM scenes")
def pixel_to_map_space(spark: SparkSession, d: str) -> DataFrame:
    g = [F.col("ul_x"), F.col("dx"), F.lit(0.0), F.col("ul_y"), F.lit(0.0), -F.col("dy")]
    x, y = pixel_to_map(F.col("o") % 200, F.col("o") % 150, g)
    return _scenes(spark, d).select("o", x.alias("map_x"), y.alias("map_y"))


@registered(_S + "SELECT o, CAST(trunc((300000 + 7.5 * (o % 997) - ul_x) / 30.0) AS INT) AS px, CAST(trunc((4500000 - 7.5 * (o % 613) - ul_y) / -30.0) AS INT) AS py, CAST(ul_x + 200 * 30.0 AS DOUBLE) AS east, CAST(ul_y - 150 * 30.0 AS DOUBLE) AS south FROM scenes")
def map_to_pixel_space(spark: SparkSession, d: str) -> DataFrame:
    px, py = map_to_pixel(300000 + 7.5 * (F.col("o") % 997), 4500000 - 7.5 * (F.col("o") % 613), F.col("ul_x"), F.col("ul_y"), F.col("dx"), -F.col("dy"))
    return _scenes(spark, d).select("o", px.alias("px"), py.alias("py"), (F.col("ul_x") + F.col("ncol") * F.col("dx")).alias("east"), (F.col("ul_y") - F.col("nrow") * F.col("dy")).alias("south"))


@registered(f"WITH {views.OBS}, {views.GRIDS} SELECT obs.scene_id, CAST(y + round((n - north) / 30.0) AS INT) AS y, CAST(x + round((west - w) / 30.0) AS INT) AS x, b4 FROM obs JOIN grids ON obs.scene_id = grids.scene_id CROSS JOIN (SELECT min(west) AS w, max(north) AS n FROM grids) c")
def align_grid(spark: SparkSession, d: str) -> DataFrame:
    grids = views.view(spark, d, f"{views.OBS}, {views.GRIDS}", "grids")
    common = grids.groupBy("path", "row").agg(F.min("west").alias("west"), F.max("north").alias("north"))
    return placing.align(_obs(spark, d), grids, common).select("scene_id", "y", "x", "b4")


@registered(f"""WITH {views.OBS}, {views.PHASES}, near AS (SELECT g.scene_id, g.west, g.north, w, n FROM grids g CROSS JOIN (SELECT min(west) AS w, max(north) AS n FROM grids) c)
SELECT obs.scene_id, CAST(y + ceil((n - north) / 30.0 - 0.5) AS INT) AS y, CAST(x + ceil((west - w) / 30.0 - 0.5) AS INT) AS x, b4 FROM obs JOIN near ON obs.scene_id = near.scene_id""")
def align_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Scenes out of phase on the common grid: the nearest pixel."""
    grids = views.view(spark, d, f"{views.OBS}, {views.PHASES}", "grids")
    common = grids.groupBy("path", "row").agg(F.min("west").alias("west"), F.max("north").alias("north"))
    return placing.align(_obs(spark, d), grids, common, resample="nearest").select("scene_id", "y", "x", "b4")


def _scene_bounds(spark: SparkSession, d: str) -> DataFrame:
    """The different bounds of all scenes, with the number, the sum and the least and greatest id of the scenes that have them."""
    s = _scenes(spark, d).select("o", F.col("ul_x").alias("west"), F.col("ul_y").alias("north"), (F.col("ul_x") + F.col("ncol") * F.col("dx")).alias("east"), (F.col("ul_y") - F.col("nrow") * F.col("dy")).alias("south"), "dx", "dy")
    return s.groupBy("west", "north", "east", "south", "dx", "dy").agg(F.count("*").alias("n_scenes"), F.sum("o").alias("sum_o"), F.min("o").alias("first_o"), F.max("o").alias("last_o"))


_BOUNDS = f"""WITH {views.POINTS}, {views.SCENES}, bounds AS (SELECT ul_x, ul_y, count(*) AS n_scenes, CAST(sum(o) AS BIGINT) AS sum_o, min(o) AS first_o, max(o) AS last_o FROM scenes GROUP BY ul_x, ul_y),
found AS (SELECT *, CAST(trunc((px - ul_x) / 30.0) AS INT) AS x, CAST(trunc((py - ul_y) / -30.0) AS INT) AS y FROM points JOIN bounds ON px > ul_x AND px < ul_x + 6000.0 AND py < ul_y AND py > ul_y - 4500.0)"""


@registered(_BOUNDS + "SELECT point_id, CAST(sum(n_scenes) AS BIGINT) AS n_scenes, CAST(sum(sum_o) AS BIGINT) AS sum_o, min(first_o) AS first_o, max(last_o) AS last_o, CAST(sum(n_scenes * x) AS BIGINT) AS sum_x, CAST(sum(n_scenes * y) AS BIGINT) AS sum_y FROM found GROUP BY point_id")
def point_scenes(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of a point and a scene that holds it, as one row for each point: how many, and sums of scene ids, columns and lines."""
    found = placing.points_in(views.view(spark, d, views.POINTS, "points"), _scene_bounds(spark, d))
    sums = [F.sum(F.col("n_scenes") * F.col(c)).alias(f"sum_{c}") for c in ("x", "y")]
    return found.groupBy("point_id").agg(F.sum("n_scenes").alias("n_scenes"), F.sum("sum_o").alias("sum_o"), F.min("first_o").alias("first_o"), F.max("last_o").alias("last_o"), *sums)


@registered(_BOUNDS + "SELECT point_id, ul_x AS west, ul_y AS north, n_scenes, first_o, last_o, x, y FROM found")
def point_scene_bounds(spark: SparkSession, d: str) -> DataFrame:
    """All scenes at each point, by their bounds: how many there are, the least and the greatest id, and the pixel."""
    found = placing.points_in(views.view(spark, d, views.POINTS, "points"), _scene_bounds(spark, d))
    return found.select("point_id", "west", "north", "n_scenes", "first_o", "last_o", "x", "y")


_LINES = "(SELECT max(y) + 1 AS h FROM obs)"


@registered(f"""WITH {views.OBS_QA}, {views.GRIDS}, {views.POINTS} SELECT point_id, o.scene_id, o.b3, o.b4, o.qa FROM points p JOIN grids g ON px > west AND px < west + 1500 AND py < north AND py > north - 30 * {_LINES}
JOIN obs_qa o ON o.scene_id = g.scene_id AND o.x = CAST(trunc((px - west) / 30) AS INT) AND o.y = CAST(trunc((py - north) / -30) AS INT)""")
def point_stack(spark: SparkSession, d: str) -> DataFrame:
    looks = materialize(_looks(spark, d).select("scene_id", "path", "row", "y", "x", "b3", "b4", "qa"), "looks")
    lines = looks.agg(F.max("y") + 1).first()[0] or 0
    looks.createOrReplaceTempView("obs")
    grids = spark.sql(f"WITH {views.GRIDS} SELECT * FROM grids").withColumns({"east": F.col("west") + 1500, "south": F.col("north") - 30.0 * lines})
    return placing.point_stack(views.view(spark, d, views.POINTS, "points"), grids, looks, ["b3", "b4", "qa"]).drop("y", "x")


@registered(_O + f"SELECT {_KEY}, b4, b7 FROM obs WHERE y = 2")
def line_slice(spark: SparkSession, d: str) -> DataFrame:
    return placing.line_slice(_obs(spark, d), ["b4", "b7"], map_y=4500000.0 - 75, north=4500000.0, south=4500000.0 - 120)


# ---- summaries over time


_SY = "CAST(year + CASE WHEN month = 12 THEN 1 ELSE 0 END AS INT)"
_SEASONAL = (
    views.LOOKS
    + f""",
years AS (SELECT path, row, min(year) AS y0, max(year) AS y1 FROM obs GROUP BY path, row),
seasonal AS (
  SELECT {_PIX}, {_SY} AS season_year, {_SEASON.format(m='month')} AS season,
         CAST(least(count(CASE WHEN qa >= 0 THEN 1 END), 255) AS INT) AS good_looks, """
    + ", ".join(f"CAST(coalesce(round(avg(CASE WHEN qa >= 0 THEN CAST({m} AS DOUBLE) END)), -9999.0) AS SMALLINT) AS {m}" for m in MEASURES)
    + f" FROM looks JOIN years USING (path, row) WHERE {_SY} BETWEEN y0 AND y1 GROUP BY 1, 2, 3, 4, 5, 6),\nannual AS (SELECT {_PIX}, year, "
    + ", ".join(f"max({i}) AS {i}" for i in INDICES)
    + f" FROM looks GROUP BY {_PIX}, year)"
)


@registered(f"WITH {_SEASONAL} SELECT * FROM seasonal")
def seasonal_means(spark: SparkSession, d: str) -> DataFrame:
    looks = _stored(spark, d)
    return temporal.seasonal_means(looks, _years(looks))


_GRID = "SELECT path, row, CAST(g.y AS INT) AS y, CAST(h.x AS INT) AS x, CAST(s.season_year AS INT) AS season_year, season FROM (SELECT DISTINCT path, row FROM looks) p CROSS JOIN (SELECT DISTINCT y FROM looks) g CROSS JOIN (SELECT DISTINCT x FROM looks) h CROSS JOIN (SELECT unnest(generate_series((SELECT y0 FROM years), (SELECT y1 FROM years))) AS season_year) s CROSS JOIN (SELECT unnest(['winter', 'spring', 'summer', 'fall']) AS season) t"


@registered(f"WITH {_SEASONAL}, grid AS ({_GRID}) SELECT grid.*, coalesce(good_looks, 0) AS good_looks, " + ", ".join(f"coalesce({m}, CAST(-9999 AS SMALLINT)) AS {m}" for m in MEASURES) + " FROM grid LEFT JOIN seasonal USING (path, row, y, x, season_year, season)")
def seasonal_dense(spark: SparkSession, d: str) -> DataFrame:
    looks = _stored(spark, d)
    size = looks.groupBy("path", "row").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    lines = size.select("path", "row", "x0", "x1", F.explode(F.sequence("y0", "y1")).alias("y"))
    pixels = lines.select("path", "row", "y", F.explode(F.sequence("x0", "x1")).alias("x"))
    years = _years(looks)
    return temporal.seasonal_dense(temporal.seasonal_means(looks, years), pixels, years)


_STACK_GRID = _GRID.replace("FROM (SELECT DISTINCT path, row FROM looks) p CROSS JOIN", "FROM (SELECT path, row, unnest(generate_series(y0, y1)) AS season_year FROM years) s CROSS JOIN").replace(" CROSS JOIN (SELECT unnest(generate_series((SELECT y0 FROM years), (SELECT y1 FROM years))) AS season_year) s", "")


@registered(views.two_stacks(f"WITH {_SEASONAL}, grid AS ({_STACK_GRID}) SELECT grid.*, coalesce(good_looks, 0) AS good_looks, " + ", ".join(f"coalesce({m}, CAST(-9999 AS SMALLINT)) AS {m}" for m in MEASURES) + " FROM grid LEFT JOIN seasonal USING (path, row, y, x, season_year, season)"))
def seasonal_dense_two_stacks(spark: SparkSession, d: str) -> DataFrame:
    """Dense seasons of two stacks, each in its own years."""
    looks = temporal.with_indices(views.view(spark, d, views.two_stacks(views.OBS), "obs").withColumn("qa", qa_code()))
    size = looks.agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    stacks = looks.groupBy("path", "row").agg(F.min("year").alias("first"), F.max("year").alias("last")).withColumn("first", F.col("first") + 1)
    lines = size.select("x0", "x1", F.explode(F.sequence("y0", "y1")).alias("y"))
    pixels = lines.select("y", F.explode(F.sequence("x0", "x1")).alias("x")).join(F.broadcast(stacks.select("path", "row")))
    return temporal.seasonal_dense(temporal.seasonal_means(looks, stacks), pixels, stacks)


@registered(f"WITH {_SEASONAL} SELECT * FROM annual")
def annual_max(spark: SparkSession, d: str) -> DataFrame:
    return temporal.annual_max(_stored(spark, d))


_WIDE = ", ".join(f"max(CASE WHEN season = '{s}' THEN {m} END) AS {s}_{m}" for s in SEASONS for m in MEASURES)
_FEATURED = (
    _SEASONAL
    + f",\nwide AS (SELECT {_PIX}, season_year, {_WIDE} FROM seasonal GROUP BY {_PIX}, season_year),\nfeatured AS (SELECT l.scene_id, l.path, l.row, l.y, l.x, l.year, l.month, l.julian, l.qa, l.raw_prob, "
    + ", ".join(f"CAST(l.{b} AS DOUBLE) AS {b}" for b in BANDS)
    + ", "
    + ", ".join(f"f_{i} AS {i}" for i in INDICES)
    + ", "
    + ", ".join(f"CAST(coalesce(w.{c}, -9999) AS DOUBLE) AS {c}" for c in features.SEASONAL)
    + ", "
    + ", ".join(f"CAST(coalesce(a.{i}, -9999) AS DOUBLE) AS max_{i}" for i in INDICES)
    + ", "
    + ", ".join(f"CASE WHEN l.qa = -9999 THEN CAST(-9999 AS DOUBLE) ELSE f_{i} - coalesce(a.{i}, -9999) END AS d{i}" for i in INDICES)
    + " FROM (SELECT *, "
    + ", ".join(f"{e} AS f_{n}" for n, e in views.FEATURE.items())
    + """ FROM looks) l
LEFT JOIN wide w ON l.path = w.path AND l.row = w.row AND l.y = w.y AND l.x = w.x AND l.year = w.season_year + 1
LEFT JOIN annual a ON l.path = a.path AND l.row = a.row AND l.y = a.y AND l.x = a.x AND l.year = a.year + 1
JOIN years t ON l.path = t.path AND l.row = t.row WHERE l.year > t.y0)"""
)


@registered(f"WITH {_FEATURED} SELECT scene_id, y, x, " + ", ".join((*features.SEASONAL, *features.MAXIMA)) + " FROM featured")
def features_prev_year(spark: SparkSession, d: str) -> DataFrame:
    return _featured(spark, d).select("scene_id", "y", "x", *features.SEASONAL, *features.MAXIMA)


@registered(views.two_stacks(f"WITH {_FEATURED} SELECT scene_id, y, x, " + ", ".join((*features.SEASONAL, *features.MAXIMA)) + " FROM featured"))
def features_of_two_stacks(spark: SparkSession, d: str) -> DataFrame:
    looks = views.view(spark, d, views.two_stacks(views.OBS), "obs").withColumn("qa", qa_code())
    return pipeline.featured_looks(materialize(looks, "looks")).select("scene_id", "y", "x", *features.SEASONAL, *features.MAXIMA)


@registered(f"WITH {_FEATURED} SELECT scene_id, y, x, " + ", ".join(features.FEATURES) + " FROM featured")
def feature_vector(spark: SparkSession, d: str) -> DataFrame:
    return _featured(spark, d).select("scene_id", "y", "x", *features.FEATURES)


def _state(spark: SparkSession, d: str, ctes: str) -> YearlyState:
    """Looks in three batches: those of even years, those of odd ones but for their last half, and the rest, which are late."""
    looks = materialize(views.view(spark, d, ctes, "obs").withColumn("qa", qa_code()), "looks")
    late = (F.col("year") % 2 == 1) & (F.col("month") > 6)
    state = YearlyState(spark, new_path(spark, "yearly"), side=16)
    for name, some in (("even", F.col("year") % 2 == 0), ("odd", (F.col("year") % 2 == 1) & ~late), ("late", late)):
        state.add(name, looks.where(some))
    release(looks)
    return state


@registered(f"WITH {_SEASONAL} SELECT * FROM seasonal")
def seasonal_means_kept(spark: SparkSession, d: str) -> DataFrame:
    """The seasons of tables that are kept from batch to batch."""
    return _state(spark, d, views.OBS).seasonal().select(*PIXEL, "season_year", "season", "good_looks", *MEASURES)


@registered(views.two_stacks(f"WITH {_FEATURED} SELECT scene_id, y, x, " + ", ".join(features.FEATURES) + " FROM featured"))
def feature_vector_kept(spark: SparkSession, d: str) -> DataFrame:
    """The features of two stacks' looks, from tables that are kept from batch to batch; nothing is shuffled to join them."""
    pipeline.keep_in_place(spark)
    return _state(spark, d, views.two_stacks(views.OBS)).featured().select("scene_id", "y", "x", *features.FEATURES)



# ---- the model


_NBR, _DNBR = features.FEATURES.index("nbr"), features.FEATURES.index("dnbr")
_NODES = [
    node
    for k, sign in ((0, -1.0), (1, 1.0))
    for t, (f, g, cut, low, high) in enumerate(((_NBR, _DNBR, -100.0, -600.0, -300.0), (_DNBR, _NBR, -400.0, -200.0, 100.0)))
    for node in ((k, t, 0, f, cut, 1, 2, 0.0), (k, t, 1, g, low, 3, 4, 0.0), (k, t, 2, g, high, 5, 6, 0.0), *((k, t, 3 + j, None, 0.0, -1, -1, sign * v) for j, v in enumerate((2.0, 1.25, -0.5, -1.5))))
]
ENSEMBLE = trees.Ensemble(_NODES, base=0.1, shrinkage=0.5)


def _case(tree: dict, node: int = 0) -> str:
    f, cut, left, right, value = tree[node]
    return f"CAST({value} AS DOUBLE)" if f is None else f"CASE WHEN {features.FEATURES[f]} <= {cut} THEN {_case(tree, left)} ELSE {_case(tree, right)} END"



def _probability(shrinkage: float = 0.5) -> str:
    sums = ["CAST(0.1 AS DOUBLE)" + "".join(f" + CAST({shrinkage} AS DOUBLE) * ({_case(t)})" for (c, _), t in sorted(ENSEMBLE.trees().items()) if c == k) for k in (0, 1)]
    return f"(exp({sums[1]}) / (exp({sums[0]}) + exp({sums[1]})))"


_PROBABILITY = _probability()
_CODE = f"CAST(CASE WHEN qa = -9999 THEN -9999 WHEN qa < 0 THEN -9998 ELSE floor({_PROBABILITY} * 100 + 0.5) END AS SMALLINT)"


@registered(f"WITH {_FEATURED} SELECT scene_id, y, x, round({_PROBABILITY}, 9) AS p FROM featured")
def tree_score(spark: SparkSession, d: str) -> DataFrame:
    return _featured(spark, d).select("scene_id", "y", "x", F.round(trees.tree_probability(ENSEMBLE), 9).alias("p"))


@registered(f"WITH {_FEATURED} SELECT scene_id, y, x, {_CODE} AS burn_prob FROM featured")
def burn_probability(spark: SparkSession, d: str) -> DataFrame:
    return _featured(spark, d).select("scene_id", "y", "x", product_code(trees.tree_probability(ENSEMBLE)).alias("burn_prob"))


#: Two models of 1,000 trees of depth two, three nodes and four leaves each, from the 25 nations.
_FOREST_TREES = 160
_TREE = "n_nationkey * 160 + j"
_FOREST_FEATURES = (*BANDS, *INDICES)


def _cut(place: str) -> str:
    return f"CAST(CASE WHEN {place} < 6 THEN 100 + (t * 37 + node * 311) % 1500 ELSE (t * 53 + node * 97) % 1000 - 500 END AS DOUBLE)"


def _forest(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Tables of nodes and of settings."""
    nations = spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(_FOREST_TREES - 1))).alias("j"))
    t = nations.select(F.expr(_TREE).cast("int").alias("t"))
    nodes = t.select("t", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("node")).withColumn("f", F.expr("(t * 7 + node * 3) % 10"))
    inner, kind = F.col("node") < 3, {"model": "concat('m', t % 2)", "class": "CAST(t DIV 2 % 2 AS INT)", "tree": "CAST(t DIV 4 AS INT)"}
    value = F.when(~inner, ((F.col("t") * 13 + F.col("node") * 29) % 41 - 20) / 10).otherwise(0.0)
    columns = {"feature": F.when(inner, F.col("f")).cast("int"), "threshold": F.when(inner, F.expr(_cut("f"))).otherwise(0.0), "left": F.when(inner, 2 * F.col("node") + 1).otherwise(-1).cast("int"), "right": F.when(inner, 2 * F.col("node") + 2).otherwise(-1).cast("int"), "value": value.cast("double")}
    nodes = nodes.select(*(F.expr(e).alias(n) for n, e in kind.items()), "node", *(c.alias(n) for n, c in columns.items()))
    return nodes, nodes.groupBy("model").agg(F.lit(0.1).alias("base"), F.when(F.col("model") == "m0", 0.01).otherwise(0.02).alias("shrinkage"))


_AT = lambda node: f"feats[(t * 7 + {node} * 3) % 10 + 1] <= " + _cut(f"((t * 7 + {node} * 3) % 10)").replace("node", str(node))
_LEAF = lambda node: f"((t * 13 + {node} * 29) % 41 - 20) / 10.0"


@registered(f"""WITH {views.LOOKS}, t AS (SELECT CAST({_TREE} AS INT) AS t FROM nation CROSS JOIN (SELECT unnest(generate_series(0, {_FOREST_TREES - 1})) AS j) s),
f AS (SELECT scene_id, y, x, CASE WHEN x % 3 = 0 THEN 0 ELSE 1 END AS m, [{', '.join(f'CAST({c} AS DOUBLE)' for c in _FOREST_FEATURES)}] AS feats FROM looks),
s AS (SELECT scene_id, y, x, m, (t // 2) % 2 AS k, sum(CAST(CASE WHEN {_AT(0)} THEN CASE WHEN {_AT(1)} THEN {_LEAF(3)} ELSE {_LEAF(4)} END ELSE CASE WHEN {_AT(2)} THEN {_LEAF(5)} ELSE {_LEAF(6)} END END AS DOUBLE)) AS v FROM f JOIN t ON t % 2 = m GROUP BY ALL),
w AS (SELECT scene_id, y, x, m, max(CASE WHEN k = 0 THEN v END) AS a, max(CASE WHEN k = 1 THEN v END) AS b FROM s GROUP BY scene_id, y, x, m)
SELECT scene_id, y, x, 'm' || CAST(m AS VARCHAR) AS model, round(1 / (1 + exp(CASE WHEN m = 0 THEN 0.01 ELSE 0.02 END * (a - b))), 9) AS p FROM w""")
def forest_score(spark: SparkSession, d: str) -> DataFrame:
    """Two models of 1,000 trees a class, in a table of nodes, over all looks in one pass."""
    nodes, settings = _forest(spark, d)
    model = F.when(F.col("x") % 3 == 0, "m0").otherwise("m1")
    scored = trees.score_forest(_stored(spark, d).withColumn("model", model), nodes, settings, _FOREST_FEATURES, name="p")
    return scored.select("scene_id", "y", "x", "model", F.round("p", 9).alias("p"))


@registered()
def model_error(spark: SparkSession, d: str) -> DataFrame:
    rows = _featured(spark, d).where("qa >= 0").withColumn("fire", F.expr("CAST(nbr < -100 AND dnbr < -300 AS INT)"))
    rows = materialize(rows.select(*features.FEATURES, "fire"), "training")
    return trees.train(rows, trees.TrainingOptions(tree_count=5, shrinkage=0.3, max_depth=3, subsample=0.8))[1]


_KIND = "CAST(CASE WHEN nbr < -100 AND dnbr < -300 THEN 2 WHEN dnbr < -100 THEN 1 ELSE 0 END AS INT)"


@registered()
def class_model_error(spark: SparkSession, d: str) -> DataFrame:
    """Three classes, an ensemble for each: the report of its training."""
    rows = _featured(spark, d).where("qa >= 0").withColumn("kind", F.expr(_KIND))
    return boosting.train_classes(rows, trees.TrainingOptions(tree_count=3, shrinkage=0.3, max_depth=3, subsample=0.8), label="kind")[1]


@registered(f"WITH {_FEATURED} SELECT year, count(*) AS n_looks, round(avg(CASE WHEN ({_PROBABILITY} > 0.5) = (nbr < -100 AND dnbr < -300) THEN 0 ELSE 100 END), 9) AS error FROM featured WHERE qa >= 0 GROUP BY year")
def prediction_error(spark: SparkSession, d: str) -> DataFrame:
    """How often a given ensemble is wrong on clear looks, by year."""
    scored = _featured(spark, d).where("qa >= 0").withColumns({"prediction": boosting.predicted_class(ENSEMBLE), "label": F.expr("CAST(nbr < -100 AND dnbr < -300 AS INT)")})
    return trees.misclassified(scored, "year").select("year", "n_looks", F.round("error", 9).alias("error"))


# ---- regions


_CC = """
g AS (SELECT scene, y, x, y*50+x AS id FROM burn_prob WHERE burn_prob > 75),
h AS (SELECT scene, y, x, y*50+x AS id FROM burn_prob WHERE burn_prob >= 90),
e AS (SELECT a.scene, a.id AS a, b.id AS b FROM g a JOIN g b ON a.scene = b.scene AND ((b.y = a.y AND abs(b.x-a.x) = 1) OR (b.x = a.x AND abs(b.y-a.y) = 1))),
f AS (SELECT a.scene, a.id AS a, b.id AS b FROM h a JOIN h b ON a.scene = b.scene AND ((b.y = a.y AND abs(b.x-a.x) = 1) OR (b.x = a.x AND abs(b.y-a.y) = 1))),
w AS (SELECT scene, id, id AS root FROM g UNION SELECT w.scene, e.b, w.root FROM w JOIN e ON w.scene = e.scene AND w.id = e.a WHERE w.root < e.b),
v AS (SELECT scene, id, id AS root FROM h UNION SELECT v.scene, f.b, v.root FROM v JOIN f ON v.scene = f.scene AND v.id = f.a WHERE v.root < f.b),
grown AS (SELECT scene, id, min(root) AS first FROM w GROUP BY scene, id),
seeds AS (SELECT scene, first, count(*) AS area FROM (SELECT scene, id, min(root) AS first FROM v GROUP BY scene, id) s GROUP BY scene, first HAVING count(*) >= 3),
kept AS (SELECT DISTINCT grown.scene, grown.first FROM grown JOIN seeds ON grown.scene = seeds.scene AND grown.id = seeds.first),
labels AS (SELECT scene, first, CAST(row_number() OVER (PARTITION BY scene ORDER BY first) AS INT) AS label FROM kept),
patch AS (SELECT grown.scene, grown.id, label FROM grown JOIN labels ON grown.scene = labels.scene AND grown.first = labels.first),
"""
_REGIONS = f"WITH RECURSIVE {views.BURN_PROB}, {_CC.strip()} "


@registered(_REGIONS.rstrip().rstrip(",") + " SELECT scene, CAST(floor(first / 50) AS INT) AS first_y, CAST(first % 50 AS INT) AS first_x, CAST(area AS BIGINT) AS area FROM seeds")
def seed_regions(spark: SparkSession, d: str) -> DataFrame:
    return regions.seed_regions(_burn_prob(spark, d), _REGION)


@registered(_REGIONS.rstrip().rstrip(",") + " SELECT b.scene, b.y, b.x, burn_prob, CAST(coalesce(label, CASE WHEN burn_prob < 0 THEN burn_prob ELSE 0 END) AS INT) AS burn_class FROM burn_prob b LEFT JOIN patch p ON b.scene = p.scene AND b.y * 50 + b.x = p.id")
def burn_class(spark: SparkSession, d: str) -> DataFrame:
    prob = materialize(_burn_prob(spark, d), "burn-prob")
    return regions.burn_class(prob, regions.grown_runs(prob, _REGION)).select("scene", "y", "x", "burn_prob", "burn_class")


_PATCHES = """box AS (SELECT scene, label, min(id // 50) - 1 AS y0, max(id // 50) + 1 AS y1, min(id % 50) - 1 AS x0, max(id % 50) + 1 AS x1 FROM patch GROUP BY scene, label),
back AS (SELECT scene, label, y, x FROM (SELECT scene, label, x0, x1, unnest(generate_series(y0, y1)) AS y FROM box) r, LATERAL (SELECT unnest(generate_series(x0, x1)) AS x) c
         WHERE NOT EXISTS (SELECT 1 FROM patch p WHERE p.scene = r.scene AND p.label = r.label AND p.id // 50 = r.y AND p.id % 50 = c.x)),
open AS (SELECT scene, label, y0 AS y, x0 AS x FROM box UNION SELECT b.scene, b.label, b.y, b.x FROM open o JOIN back b ON b.scene = o.scene AND b.label = o.label AND abs(b.y - o.y) <= 1 AND abs(b.x - o.x) <= 1),
holes AS (SELECT scene, label, count(*) AS n FROM back WHERE NOT EXISTS (SELECT 1 FROM open o WHERE o.scene = back.scene AND o.label = back.label AND o.y = back.y AND o.x = back.x) GROUP BY scene, label)
SELECT p.scene, p.label, count(*) AS area, CAST(count(*) + coalesce(any_value(n), 0) AS BIGINT) AS filled_area, max(burn_prob) AS max_intensity, avg(CAST(burn_prob AS DOUBLE)) AS mean_intensity, min(burn_prob) AS min_intensity
FROM patch p JOIN burn_prob b ON b.scene = p.scene AND b.y * 50 + b.x = p.id LEFT JOIN holes h ON h.scene = p.scene AND h.label = p.label GROUP BY p.scene, p.label"""


@registered(_REGIONS + _PATCHES)
def patch_attributes(spark: SparkSession, d: str) -> DataFrame:
    prob = materialize(_burn_prob(spark, d), "burn-prob")
    return regions.patch_attributes(prob, materialize(regions.grown_runs(prob, _REGION), "labelled"))


# ---- yearly products


_BURN = """burn AS (SELECT scene_id, path, row, y, x, year, julian, CAST(CASE WHEN qa = -9999 THEN -9999 WHEN qa < 0 THEN -9998 ELSE raw_prob END AS INT) AS burn_prob,
  CAST(CASE WHEN qa = -9999 THEN -9999 WHEN qa < 0 THEN -9998 WHEN raw_prob > 75 THEN 1 ELSE 0 END AS INT) AS burn_class FROM obs_qa)"""


def _annual_sql(day: str) -> str:
    empty = "CASE WHEN max(burn_prob) = -9999 THEN -9999 ELSE {} END"
    values = {"burned_area": f"coalesce({day}, 0)", "burn_count": "count(CASE WHEN burn_class >= 1 THEN 1 END)", "good_looks_count": "count(CASE WHEN burn_class >= 0 THEN 1 END)", "max_burn_prob": "max(burn_prob)"}
    return f"SELECT {_PIX}, year, " + ", ".join(f"CAST({empty.format(v)} AS INT) AS {n}" for n, v in values.items()) + f" FROM burn GROUP BY {_PIX}, year"


def _burn(spark: SparkSession, d: str) -> DataFrame:
    looks = _looks(spark, d)
    code = F.when(F.col("qa") == FILL, FILL).when(F.col("qa") < 0, -9998)
    return looks.select("scene_id", *PIXEL, "year", "julian", code.otherwise(F.col("raw_prob")).cast("int").alias("burn_prob"), code.otherwise((F.col("raw_prob") > 75).cast("int")).cast("int").alias("burn_class"))


_FIRST = "min(CASE WHEN burn_class >= 1 THEN julian END)"


@registered(f"{_Q}, {_BURN} {_annual_sql(_FIRST)}")
def annual_burn(spark: SparkSession, d: str) -> DataFrame:
    return annual.annual_burn(_burn(spark, d))


@registered(f"{_Q}, {_BURN} " + _annual_sql("arg_min(CASE WHEN burn_class >= 1 THEN julian END, CASE WHEN burn_class >= 1 THEN scene_id END)"))
def first_burn_stack_order(spark: SparkSession, d: str) -> DataFrame:
    return annual.annual_burn(_burn(spark, d), order="stack")


@registered(f"""{_Q}, {_BURN}, a AS ({_annual_sql(_FIRST)}) SELECT g.*, coalesce(burned_area, -9999) AS burned_area, coalesce(burn_count, -9999) AS burn_count, coalesce(good_looks_count, -9999) AS good_looks_count, coalesce(max_burn_prob, -9999) AS max_burn_prob
FROM (SELECT p.path, p.row, y, x, year FROM (SELECT DISTINCT path, row, y, x FROM obs_qa) p JOIN (SELECT DISTINCT path, row, year FROM obs_qa) t ON p.path = t.path AND p.row = t.row) g LEFT JOIN a USING (path, row, y, x, year)""")
def annual_burn_dense(spark: SparkSession, d: str) -> DataFrame:
    looks = _burn(spark, d)
    return annual.annual_dense(annual.annual_burn(looks), looks.select(*PIXEL).distinct()).select(*PIXEL, "year", *annual.PRODUCTS)


@registered(f"""{_S}, n AS (SELECT unnest(['burned_area', 'burn_count', 'good_looks_count', 'max_burn_prob']) AS name), y AS (SELECT unnest(generate_series((SELECT min(year(d)) + 1 FROM scenes), (SELECT max(year(d)) FROM scenes))) AS year)
SELECT CAST(year AS INT) AS year, name, name || '_' || CAST(year AS STRING) || '.img' AS file_name, CAST(CASE WHEN name = 'max_burn_prob' THEN 100 ELSE 366 END AS INT) AS valid_max, 'INT16' AS data_type, CAST(-9999 AS INT) AS fill_value FROM n CROSS JOIN y""")
def product_catalog(spark: SparkSession, d: str) -> DataFrame:
    start, end = screening.year_window(screening.catalogue(_scenes(spark, d).drop("d")))
    return annual.product_catalog(spark, start, end).select("year", "name", "file_name", "valid_max", "data_type", "fill_value")


_BOX = f"""{_S}, e AS (SELECT path, row, min(ul_x - h) AS w, max(ul_y + h) AS n, max(ul_x - h + 6000) AS e, min(ul_y + h - 4500) AS s FROM (SELECT *, CASE WHEN grid_origin = 'CENTER' THEN 15.0 ELSE 0.0 END AS h FROM scenes) a GROUP BY path, row),
box AS (SELECT path, row, CAST(w AS DOUBLE) AS w, CAST(n AS DOUBLE) AS n, CAST(ceil((e - w) / 30) AS INT) AS c, CAST(ceil((n - s) / 30) AS INT) AS l FROM e)"""


@registered(_BOX + " SELECT path, row, w AS min_x, CAST(w + 30.0 * c AS DOUBLE) AS max_x, CAST(n - 30.0 * l AS DOUBLE) AS min_y, n AS max_y FROM box")
def grid_bbox_map(spark: SparkSession, d: str) -> DataFrame:
    return _bbox(_scenes(spark, d)).select("path", "row", "min_x", "max_x", "min_y", "max_y")


def _degrees_sql(east: str, north: str, zone: int) -> tuple[str, str]:
    """Latitude and longitude in SQL, by the series of functions.grid.utm_to_degrees with its coefficients as numbers."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    scale = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3, n**2 / 48 + n**3 / 15, 17 / 480 * n**3)
    delta = (2 * n - 2 / 3 * n**2 - 2 * n**3, 7 / 3 * n**2 - 8 / 5 * n**3, 56 / 15 * n**3)
    double = lambda v: f"CAST({v!r} AS DOUBLE)"
    xi, eta = f"({north} / {double(scale)})", f"(({east} - 500000.0) / {double(scale)})"
    x = xi + "".join(f" - {double(b)} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, b in enumerate(beta, 1))
    e = eta + "".join(f" - {double(b)} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, b in enumerate(beta, 1))
    chi = f"asin(sin({x}) / cosh({e}))"
    lat = f"degrees({chi}" + "".join(f" + {double(v)} * sin({2 * j} * {chi})" for j, v in enumerate(delta, 1)) + ")"
    return lat, f"({zone * 6 - 183} + degrees(atan2(sinh({e}), cos({x}))))"


_LAT, _LON = _degrees_sql("x", "y", 13)
_CORNERS = {"ul": ("w + 15.0", "n - 15.0"), "lr": ("w + 30.0 * c - 15.0", "n - 30.0 * l + 15.0")}


@registered(f"""{_BOX}, k AS (SELECT *, unnest(generate_series(0, c)) AS k FROM box), m AS (SELECT *, unnest(generate_series(0, l)) AS k FROM box),
edge AS (SELECT path, row, w + 30.0 * k AS x, n AS y FROM k UNION ALL SELECT path, row, w + 30.0 * k, n - 30.0 * l FROM k UNION ALL SELECT path, row, w, n - 30.0 * k FROM m UNION ALL SELECT path, row, w + 30.0 * c, n - 30.0 * k FROM m),
seen AS (SELECT path, row, x, y, {_LAT} AS lat, {_LON} AS lon FROM (SELECT path, row, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM edge) q),
around AS (SELECT path, row, """ + ", ".join(f"round({f}({v}), 6) AS {f}_{v}" for v in ("x", "y", "lat", "lon") for f in ("min", "max")) + """ FROM seen GROUP BY path, row)
SELECT around.*, """ + ", ".join(f"CAST({x} AS DOUBLE) AS {k}_x, CAST({y} AS DOUBLE) AS {k}_y, round({v[0]}, 6) AS {k}_lat, round({v[1]}, 6) AS {k}_lon" for k, (x, y) in _CORNERS.items() for v in [_degrees_sql(f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)", 13)]) + """
FROM around JOIN box USING (path, row)""")
def grid_bbox(spark: SparkSession, d: str) -> DataFrame:
    out = _bbox(_scenes(spark, d))
    return out.select("path", "row", *(F.round(c, 6).alias(c) for c in out.columns if c not in ("path", "row")))


def _bbox(scenes: DataFrame) -> DataFrame:
    """Of the grid of whole pixels that starts at the outermost west and north edges and holds all scenes of a stack."""
    edges = screening.edge_extent(scenes)
    east, south = F.col("west") + F.col("ncol") * F.col("dx"), F.col("north") - F.col("nrow") * F.col("dy")
    common = edges.groupBy("path", "row").agg(F.min("west").alias("west"), F.max("north").alias("north"), F.max(east).alias("east"), F.min(south).alias("south"), *(F.first(c).alias(c) for c in ("dx", "dy", "utm_zone")))
    size = {"ncol": F.ceil((F.col("east") - F.col("west")) / F.col("dx")).cast("int"), "nrow": F.ceil((F.col("north") - F.col("south")) / F.col("dy")).cast("int")}
    return annual.grid_bbox(common.withColumns(size))


_RASTERS = f"""{_B}, s AS (SELECT DISTINCT scene FROM burn_prob), yy AS (SELECT unnest(generate_series(0, (SELECT max(y) FROM burn_prob))) AS y), xx AS (SELECT unnest(generate_series(0, 49)) AS x),
rasters AS (SELECT 'prob_' || CAST(s.scene AS STRING) AS name, CAST(yy.y AS INT) AS y, CAST(xx.x AS INT) AS x, CAST(coalesce(burn_prob, -9999) AS SMALLINT) AS value FROM s CROSS JOIN yy CROSS JOIN xx LEFT JOIN burn_prob b ON b.scene = s.scene AND b.y = yy.y AND b.x = xx.x)"""


def _rasters(spark: SparkSession, d: str) -> tuple[str, int]:
    """A folder with a raster of probabilities for each half year, and their lines."""
    prob = materialize(_burn_prob(spark, d), "burn-prob")
    lines = prob.agg(F.max("y") + 1).first()[0] or 0
    folder = new_path(spark, "envi")
    named = prob.select(F.concat(F.lit("prob_"), F.col("scene").cast("string")).alias("name"), "y", "x", F.col("burn_prob").cast("short").alias("value"))
    write_envi(named, folder, lines, 50)
    release(prob)
    return folder, lines


@registered(_RASTERS + " SELECT * FROM rasters")
def envi_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return read_envi(spark, _rasters(spark, d)[0])


@registered(_RASTERS + " SELECT * FROM rasters WHERE y IN (1, 2) AND x >= 10 AND x < 20")
def envi_slice(spark: SparkSession, d: str) -> DataFrame:
    """Two lines of all rasters, of which no other bytes are read."""
    return read_envi(spark, _rasters(spark, d)[0]).where("y IN (1, 2) AND x >= 10 AND x < 20")


@registered(_RASTERS + f", {views.POINTS}, spot AS (SELECT point_id, px, py, CAST(trunc((px - 300000.0) / 30.0) AS INT) AS x, CAST(trunc((py - 4500000.0) / -30.0) AS INT) AS y FROM points) SELECT point_id, name, value FROM spot JOIN rasters USING (y, x) WHERE px > 300000 AND py < 4500000")
def envi_point_stack(spark: SparkSession, d: str) -> DataFrame:
    """The pixel of each point in each raster that holds it, read at its place."""
    folder, lines = _rasters(spark, d)
    bounds = {"west": 300_000.0, "north": 4_500_000.0, "east": 301_500.0, "south": 4_500_000.0 - 30 * lines, "dx": 30.0, "dy": 30.0}
    rasters = _burn_prob(spark, d).select(F.concat(F.lit("prob_"), F.col("scene").cast("string")).alias("name")).distinct()
    found = placing.scenes_at(views.view(spark, d, views.POINTS, "points"), rasters.withColumns({k: F.lit(v) for k, v in bounds.items()}))
    return read_spots(found.select("point_id", "name", "y", "x"), folder).select("point_id", "name", "value")


def _pipe(code: str, scene: str) -> str:
    """Yearly products in SQL, from featured looks on; code: the burn probability; scene: a number for each composite of a stack."""
    head = f"""WITH RECURSIVE {_FEATURED},
scored AS (SELECT *, {scene} AS scene, {code} AS burn_prob FROM featured),
g AS (SELECT DISTINCT scene, y, x, y*50+x AS id FROM scored WHERE burn_prob > 70),
h AS (SELECT DISTINCT scene, y, x, y*50+x AS id FROM scored WHERE burn_prob >= 80),
"""
    tail = """
patches AS (SELECT DISTINCT * FROM patch),
burn AS (SELECT s.path, s.row, s.y, s.x, s.year, s.julian, s.scene_id, s.burn_prob, CAST(coalesce(label, CASE WHEN burn_prob < 0 THEN burn_prob ELSE 0 END) AS INT) AS burn_class FROM scored s LEFT JOIN patches p ON s.scene = p.scene AND s.y * 50 + s.x = p.id)
"""
    return head + _CC.strip().split("\n", 2)[2].replace(">= 3)", ">= 2)") + tail + _annual_sql(_FIRST)


_HALF = "CAST(year * 10 + CAST(floor((month - 1) / 6) AS INT) AS INT)"


@registered(_pipe(_CODE, _HALF))
def pipeline_annual_burn(spark: SparkSession, d: str) -> DataFrame:
    looks = materialize(_looks(spark, d).withColumn("half_year", F.expr(_HALF)), "looks")
    return pipeline.burned_pipeline(looks, trees.tree_probability(ENSEMBLE), RegionOptions(80, 2, 70), scene="half_year", tile_side=16)


#: For the stacks of another model.
OTHER_ENSEMBLE = trees.Ensemble(_NODES, base=0.1, shrinkage=0.25)
_EITHER = f"CASE WHEN path = 32 THEN {_probability(0.25)} ELSE {_PROBABILITY} END"


@registered(views.screened(views.two_stacks(_pipe(_CODE.replace(_PROBABILITY, f"({_EITHER})"), f"path * 100000 + {_HALF}"))))
def job_annual_burn(spark: SparkSession, d: str) -> DataFrame:
    """The whole job on two stacks with different models and first years, of scenes that are screened first."""
    two = views.two_stacks(views.OBS)
    looks = views.view(spark, d, two, "obs").withColumns({"qa": qa_code(), "half_year": F.expr(_HALF)})
    scenes = views.view(spark, d, f"{two},\n{views.SHOTS}", "shots")
    probabilities = {screening.USUAL_MODEL: trees.tree_probability(ENSEMBLE), "gbt_gp_west_model.xml": trees.tree_probability(OTHER_ENSEMBLE)}
    return pipeline.job(scenes, looks, screening.default_models(spark), probabilities, options=RegionOptions(80, 2, 70), scene="half_year", tile_side=16)


@registered(f"""WITH p AS ({ORACLES["annual_burn"]}) SELECT path, row, name, year, CAST(count(*) AS BIGINT) AS n_pixels, CAST(sum(value) AS BIGINT) AS total FROM
(SELECT path, row, year, unnest(['burned_area', 'burn_count', 'good_looks_count', 'max_burn_prob']) AS name, unnest([burned_area, burn_count, good_looks_count, max_burn_prob]) AS value FROM p) v WHERE value <> -9999 GROUP BY path, row, name, year""")
def job_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Yearly products written with their rasters and catalogue; sums of what is read back from the rasters that the catalogue names."""
    products, folder = materialize(annual_burn(spark, d), "yearly"), new_path(spark, "outputs")
    extent = products.groupBy("path", "row").agg((F.max("y") + 1).alias("nrow"), (F.max("x") + 1).alias("ncol"))
    pipeline.write_outputs(products, extent, folder)
    listed = spark.read.json(f"{folder}/catalogue").select("path", "row", "name", "year", F.regexp_replace("file_name", r"\.img$", "").alias("raster"))
    found = None
    for r in listed.select("path", "row").distinct().collect():  # stacks
        one = read_envi(spark, f"{folder}/rasters/{r.path:03d}{r.row:03d}").select(F.lit(r.path).alias("path"), F.lit(r.row).alias("row"), F.col("name").alias("raster"), "value")
        found = one if found is None else found.unionByName(one)
    out = found.where(F.col("value") != FILL).join(listed, ["path", "row", "raster"])
    return out.groupBy(F.col("path").cast("int").alias("path"), F.col("row").cast("int").alias("row"), "name", F.col("year").cast("int").alias("year")).agg(F.count("*").alias("n_pixels"), F.sum("value").alias("total"))


@registered()
def job_with_trained_model(spark: SparkSession, d: str) -> DataFrame:
    """The whole job on two stacks, one with a given ensemble, the other with a model trained on the looks of both."""
    two = views.two_stacks(views.OBS)
    looks = views.view(spark, d, two, "obs").withColumns({"qa": qa_code(), "half_year": F.expr(_HALF)})
    scenes = views.view(spark, d, f"{two},\n{views.SHOTS}", "shots")
    model = _trained(spark, d)
    scorers = {screening.USUAL_MODEL: trees.tree_probability(ENSEMBLE), "gbt_gp_west_model.xml": lambda featured: trees.score_looks(featured, model)}
    return pipeline.job(scenes, looks, screening.default_models(spark), scorers, options=RegionOptions(80, 2, 70), scene="half_year", tile_side=16)


def _trained(spark: SparkSession, d: str):
    rows = _featured(spark, d).where("qa >= 0").withColumn("fire", F.expr("CAST(nbr < -100 AND dnbr < -300 AS INT)"))
    rows = materialize(rows.select(*features.FEATURES, "fire"), "training")
    return trees.train(rows, trees.TrainingOptions(tree_count=5, shrinkage=0.3, max_depth=3, subsample=0.8))[0]


# ---- sources, written and read again


_STACK_SQL = ORACLES["stack_catalogue"].replace("SELECT o, file, ", "SELECT file, ")


@registered(_STACK_SQL)
def stack_round_trip(spark: SparkSession, d: str) -> DataFrame:
    folder = new_path(spark, "stack")
    write_stack(stack_catalogue(spark, d), folder)
    return read_stack(spark, folder).select(*STACK.names)


@registered(f"SELECT west AS West, north AS North, east AS East, south AS South FROM ({ORACLES['max_extent']}) x")
def extent_round_trip(spark: SparkSession, d: str) -> DataFrame:
    folder = new_path(spark, "extent")
    write_extent(max_extent(spark, d), folder)
    return read_extent(spark, folder).select(*EXTENT.names)


@registered(_S + "SELECT sensor AS satellite, acq_date, path, row, ul_x, ul_y, CAST(lr_x AS DOUBLE) AS lr_x, CAST(lr_y AS DOUBLE) AS lr_y, grid_origin, utm_zone, nrow, ncol, dx, dy FROM scenes WHERE o % 5 <> 0")
def scene_xml_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """All scenes as XML; a fifth of them lacks the band that is asked for, and so is left out by the reader."""
    folder, attribute = new_path(spark, "scene-xml"), lambda **of: [F.col(c).alias(f"_{k}") for k, c in of.items()]
    corner = lambda at, x, y: F.struct(F.lit(at).alias("_location"), *attribute(x=x, y=y))
    place = F.struct(F.array(corner("UL", "ul_x", "ul_y"), corner("LR", "lr_x", "lr_y")).alias("corner_point"), "grid_origin", F.struct(F.col("utm_zone").alias("zone_code")).alias("utm_proj_params"))
    name = F.when(F.col("o") % 5 == 0, "sr_band2").otherwise("sr_band1")
    band = F.struct(F.lit("sr_refl").alias("_product"), name.alias("_name"), *attribute(nlines="nrow", nsamps="ncol"), F.struct(*attribute(x="dx", y="dy")).alias("pixel_size"))
    rows = _scenes(spark, d).select(
        F.struct(F.col("sensor").alias("satellite"), F.col("acq_date").alias("acquisition_date"), F.struct(*attribute(path="path", row="row")).alias("wrs"), place.alias("projection_information")).alias("global_metadata"),
        F.struct(F.array(band).alias("band")).alias("bands"),
    )
    rows.write.format("xml").option("rowTag", "espa_metadata").option("rootTag", "scenes").save(folder)
    return read_scene_xml(spark, folder).drop("file", "scene_id")


@registered(ORACLES["annual_burn"])
def product_round_trip(spark: SparkSession, d: str) -> DataFrame:
    folder = new_path(spark, "products")
    write_products(annual_burn(spark, d), folder)
    return spark.read.parquet(folder).select(*(F.col(c).cast("int").alias(c) for c in (*PIXEL, "year")), *annual.PRODUCTS)


@registered(f"WITH {_FEATURED} SELECT " + ", ".join(features.FEATURES) + ", CAST(nbr < -100 AND dnbr < -300 AS INT) AS fire FROM featured WHERE qa >= 0")
def training_round_trip(spark: SparkSession, d: str) -> DataFrame:
    folder = new_path(spark, "training")
    rows = _featured(spark, d).where("qa >= 0").select(*features.FEATURES, F.expr("CAST(nbr < -100 AND dnbr < -300 AS INT)").alias("fire"))
    write_training(rows, folder)
    return read_training(spark, folder, features.FEATURES)
