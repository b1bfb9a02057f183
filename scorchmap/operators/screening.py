"""The scene catalogue: listing, screening, years, extents and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scenes import date_parts
from ..settings import FIRST_MISSION_YEAR, ScreenOptions


def list_scenes(files: DataFrame, file: str = "file") -> DataFrame:
    """Metadata files (*.xml, not *.aux.xml) with their place in name order, which is the order of the stack.

    Names count without their folders; files of one name in several folders follow each other by path. Ranks come from counts by
    name prefix and a window within each, so that no task sorts all names.
    """
    rows = files.where(F.col(file).endswith(".xml") & ~F.col(file).endswith(".aux.xml"))
    name = F.substring_index(file, "/", -1)
    rows = rows.withColumn("_group", name.substr(1, 9))
    sizes = rows.groupBy("_group").agg(F.count("*").alias("_n"))  # a row for each sensor, path and row
    ahead = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(name, file)) + F.col("_before")
    return rows.join(F.broadcast(ahead) if _small(ahead) else ahead, "_group").withColumn("position", rank.cast("long")).drop("_group", "_n", "_before")


def _small(df: DataFrame, rows: int = 100_000) -> bool:
    """Whether a narrow table is safe to broadcast: it has at most so many rows."""
    return df.limit(rows + 1).count() <= rows


def screen(scenes: DataFrame, options: ScreenOptions = ScreenOptions()) -> DataFrame:
    """Adds exclude_reason: the first test that a scene fails (L1G, RMSE, cloud), or null. A missing value passes."""
    tests = [
        (options.exclude_l1g, F.col("data_type") == "L1G", "l1g"),
        (options.exclude_rmse, F.col("rmse") > options.max_rmse, "rmse"),
        (options.exclude_cloudy, F.col("cloud_cover") > options.max_cloud_cover, "cloud"),
    ]
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    for wanted, fails, name in tests:
        if wanted:
            reason = reason.when(F.coalesce(fails, F.lit(False)), F.lit(name))
    return scenes.withColumn("exclude_reason", reason)


def catalogue(scenes: DataFrame) -> DataFrame:
    """Adds year, month, day, julian, season; scenes whose date is rejected are left out."""
    return scenes.withColumns(date_parts("acq_date")).where("year is not null")


def year_window(scenes: DataFrame, start: int | None = None, end: int | None = None) -> tuple[int, int]:
    """The years to process: by default from the year after the first one to the last."""
    first, last = scenes.agg(F.min("year"), F.max("year")).first()
    if first is None:
        raise ValueError("no scenes")
    start = first + 1 if start is None else start
    end = last if end is None else end
    if start < FIRST_MISSION_YEAR or end < FIRST_MISSION_YEAR:
        raise ValueError(f"years begin with {FIRST_MISSION_YEAR}: {start}, {end}")
    if end < start:
        raise ValueError(f"the end {end} is before the start {start}")
    return start, end


def stack_years(scenes: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """path, row, first, last: the years to process of each stack, by default from the year after its first one to its last.

    A stack of one year has none by default (first is after last), which is no error.
    """
    if start is not None and end is not None and end < start:
        raise ValueError(f"the end {end} is before the start {start}")
    span = scenes.groupBy("path", "row").agg(F.min("year").alias("first"), F.max("year").alias("last"))
    early = span.agg(F.min("first"), F.min("last")).first()
    if early[0] is None:
        raise ValueError("no scenes")
    begins, ends = early[0] + 1 if start is None else start, early[1] if end is None else end
    if begins < FIRST_MISSION_YEAR or ends < FIRST_MISSION_YEAR:
        raise ValueError(f"years begin with {FIRST_MISSION_YEAR}: {begins}, {ends}")
    first, last = F.col("first") + 1 if start is None else F.lit(start), F.col("last") if end is None else F.lit(end)
    return span.select("path", "row", first.cast("int").alias("first"), last.cast("int").alias("last"))


def within_years(rows: DataFrame, years: tuple[int, int] | DataFrame, column: str = "year", ahead: int = 0) -> DataFrame:
    """Rows in these years, or in those of their stack (see stack_years()); ahead: so many years before the first one count too."""
    if isinstance(years, tuple):
        return rows.where(F.col(column).between(years[0] - ahead, years[1]))
    span = years.select("path", "row", (F.col("first") - ahead).alias("_first"), F.col("last").alias("_last"))
    joined = rows.join(F.broadcast(span) if _small(span) else span, ["path", "row"])
    return joined.where(F.col(column).between(F.col("_first"), F.col("_last"))).drop("_first", "_last")


def scorable(scenes: DataFrame) -> DataFrame:
    """Scenes after the first year of their stack (path, row): those with a year before them."""
    first = scenes.groupBy("path", "row").agg(F.min("year").alias("_first"))
    return scenes.join(first, ["path", "row"]).where("year > _first").drop("_first")


def scene_counts(scenes: DataFrame) -> DataFrame:
    """Scenes in each year and season, and in each year."""
    each = scenes.groupBy("path", "row", "year", "season").agg(F.count("*").alias("n_season"))
    whole = scenes.groupBy("path", "row", "year").agg(F.count("*").alias("n_year"))
    return each.join(whole, ["path", "row", "year"])


def edge_extent(scenes: DataFrame) -> DataFrame:
    """West, north, east and south of the outer pixel edges: where corners are pixel centres, half a pixel is added all round."""
    half = F.col("grid_origin") == "CENTER"
    x, y = F.when(half, F.col("dx") / 2).otherwise(F.lit(0.0)), F.when(half, F.col("dy") / 2).otherwise(F.lit(0.0))
    return scenes.withColumns({"west": F.col("ul_x") - x, "north": F.col("ul_y") + y, "east": F.col("lr_x") + x, "south": F.col("lr_y") - y})


def max_extent(scenes: DataFrame) -> DataFrame:
    """The largest common extent of each stack."""
    return edge_extent(scenes).groupBy("path", "row").agg(F.min("west").alias("west"), F.max("north").alias("north"), F.max("east").alias("east"), F.min("south").alias("south"))


def model_table(defaults: DataFrame, exceptions: DataFrame) -> DataFrame:
    """key, model from two tables of (key, model): the last definition wins.

    Exceptions come after defaults; within a table the greatest value of a column `position` is last, if the table has one, then the
    greatest name.
    """
    tables = [t.select("key", "model", (F.col("position") if "position" in t.columns else F.lit(0)).cast("long").alias("_position"), F.lit(k).alias("_ord")) for k, t in enumerate((defaults, exceptions))]
    both = tables[0].unionByName(tables[1])
    last = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("_ord"), F.desc("_position"), F.desc("model")))
    return both.withColumn("_last", last).where("_last = 1").select("key", "model")


#: The stacks (paths, rows) that have a model, the usual model, and the stacks with another one.
MODEL_PATHS, MODEL_ROWS, USUAL_MODEL = (10, 48), (26, 43), "gbt_mountain_west_model.xml"
OTHER_MODELS = {
    "gbt_east_model.xml": ["015035", "015041", "015042", "016031", "018038", "024029", "024039", "025040", "026040", "026041", "026042"],
    "gbt_gp_west_model.xml": ["032032", "033030"],
    "gbt_arid_west_model.xml": ["035035", "036035", "037038", "039034", "042036", "043035", "044033", "044034"],
}


def default_models(spark: SparkSession) -> DataFrame:
    """key, model of all stacks that have a model."""
    paths = spark.range(MODEL_PATHS[0], MODEL_PATHS[1] + 1).select(F.col("id").alias("path"))
    stacks = paths.select("path", F.explode(F.sequence(F.lit(MODEL_ROWS[0]), F.lit(MODEL_ROWS[1]))).alias("row"))
    usual = stacks.select(F.format_string("%03d%03d", "path", "row").alias("key"), F.lit(USUAL_MODEL).alias("model"))
    other = spark.createDataFrame([(k, m) for m, keys in OTHER_MODELS.items() for k in keys], "key string, model string")
    return model_table(usual, other)


def lookup_models(scenes: DataFrame, models: DataFrame, required: bool = False) -> DataFrame:
    """Adds model by the key pppRRR; 'invalid' where there is none, which is an error if models are required."""
    key = F.format_string("%03d%03d", "path", "row")
    small = models.select("key", "model")
    out = scenes.withColumn("key", key).join(F.broadcast(small) if _small(small) else small, "key", "left").withColumn("model", F.coalesce("model", F.lit("invalid")))
    if required and out.where("model = 'invalid'").limit(1).count():
        raise ValueError("a stack has no model")
    return out
