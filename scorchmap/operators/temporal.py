"""Summaries of each pixel over seasons and years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.indices import stored_index
from ..functions.scenes import season, season_year
from ..settings import FILL, INDICES, MEASURES, PIXEL, SEASONS, pixel_keys
from .screening import _small, within_years


def with_indices(obs: DataFrame) -> DataFrame:
    """Adds the four stored indices to looks that have qa."""
    return obs.withColumns({name: stored_index(name) for name in INDICES})


def seasonal_means(looks: DataFrame, years: tuple[int, int] | DataFrame) -> DataFrame:
    """Good looks (at most 255) and means of the eight measures over them, for pixels, season-years and seasons with any look.

    Means are rounded, and fill without a good look. Season-years outside the years given, or those of the stack (screening.stack_years())
    and the one before, are not produced. One aggregation.
    """
    good = F.col("qa") >= 0
    keys = pixel_keys(looks.columns)
    rows = looks.select(*keys, season_year().alias("season_year"), season().alias("season"), "qa", *MEASURES)
    rows = within_years(rows, years, "season_year", 0 if isinstance(years, tuple) else 1)
    means = [F.coalesce(F.round(F.avg(F.when(good, F.col(m).cast("double")))), F.lit(float(FILL))).cast("short").alias(m) for m in MEASURES]
    return rows.groupBy(*keys, "season_year", "season").agg(F.least(F.count_if(good), F.lit(255)).cast("int").alias("good_looks"), *means)


def seasonal_dense(seasonal: DataFrame, pixels: DataFrame, years: tuple[int, int] | DataFrame) -> DataFrame:
    """The same for all pixels (path, row, y, x) in all seasons of all years: 0 good looks and fill where there is nothing.

    years: as seasonal_means() takes them; those of a stack begin a year before its first one.
    """
    if isinstance(years, tuple):
        grid = pixels.select(*PIXEL, F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))).alias("season_year"))
    else:
        span = years.select("path", "row", F.sequence(F.col("first") - 1, F.greatest(F.col("first") - 1, "last")).alias("_years"))
        grid = pixels.select(*PIXEL).join(F.broadcast(span) if _small(span) else span, ["path", "row"])
        grid = grid.select(*PIXEL, F.explode("_years").alias("season_year"))
    grid = grid.withColumn("season", F.explode(F.array(*map(F.lit, SEASONS))))
    joined = grid.join(seasonal, [*PIXEL, "season_year", "season"], "left")
    return joined.select(*PIXEL, "season_year", "season", F.coalesce("good_looks", F.lit(0)).alias("good_looks"), *(F.coalesce(m, F.lit(FILL).cast("short")).alias(m) for m in MEASURES))


def annual_max(looks: DataFrame) -> DataFrame:
    """The greatest stored value of each index in a calendar year; bad looks take part as fill."""
    return looks.groupBy(*pixel_keys(looks.columns), "year").agg(*(F.max(i).alias(i) for i in INDICES))


def seasonal_wide(seasonal: DataFrame) -> DataFrame:
    """One row for each pixel and season-year with the columns winter_b3 .. fall_nbr2 (null where a season has no look)."""
    wide = [F.max(F.when(F.col("season") == s, F.col(m))).alias(f"{s}_{m}") for s in SEASONS for m in MEASURES]
    return seasonal.groupBy(*pixel_keys(seasonal.columns), "season_year").agg(*wide)
