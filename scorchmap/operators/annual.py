"""Yearly burn products of each pixel, and their catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import pixel_to_map, utm_to_degrees
from ..settings import FILL, PIXEL

PRODUCTS = ("burned_area", "burn_count", "good_looks_count", "max_burn_prob")


def annual_burn(burn: DataFrame, order: str = "date") -> DataFrame:
    """burn (path, row, y, x, year, julian, scene_id, burn_prob, burn_class) -> the four yearly products.

    burned_area is the day of the first burned look, by date or (order='stack') in the order of scene names. All four are fill
    where the greatest probability is.
    """
    burned = F.col("burn_class") >= 1
    day = F.when(burned, F.col("julian"))
    first = F.min(day) if order == "date" else F.min_by(day, F.when(burned, F.col("scene_id")))
    out = burn.groupBy(*PIXEL, "year").agg(first.alias("burned_area"), F.count_if(burned).alias("burn_count"), F.count_if(F.col("burn_class") >= 0).alias("good_looks_count"), F.max("burn_prob").alias("max_burn_prob"))
    empty = F.col("max_burn_prob") == FILL
    return out.select(*PIXEL, "year", *(F.when(empty, F.lit(FILL)).otherwise(F.coalesce(F.col(p), F.lit(0))).cast("int").alias(p) for p in PRODUCTS))


def annual_dense(annual: DataFrame, pixels: DataFrame) -> DataFrame:
    """The same for all pixels in all years that have any: fill where there is nothing."""
    years = annual.select("path", "row", "year").distinct()
    grid = pixels.select(*PIXEL).join(years, ["path", "row"])
    return grid.join(annual, [*PIXEL, "year"], "left").na.fill(FILL, list(PRODUCTS))


def product_catalog(spark: SparkSession, start: int, end: int) -> DataFrame:
    """A row for each product and year with the metadata that goes with it."""
    said = {
        "burned_area": ("day of first burn", "day of year", 0, 366, "0: not burned"),
        "burn_count": ("looks with a burn", "count", 0, 366, "0: not burned"),
        "good_looks_count": ("looks that are not masked", "count", 0, 366, "0: never seen clearly"),
        "max_burn_prob": ("greatest burn probability", "percent", 0, 100, "-9998: only masked looks"),
    }
    years = spark.range(start, end + 1).select(F.col("id").cast("int").alias("year"))
    rows = [F.struct(F.lit(name).alias("name"), F.lit(long).alias("long_name"), F.lit(units).alias("units"), F.lit(low).alias("valid_min"), F.lit(high).alias("valid_max"), F.lit(qa).alias("qa_text")) for name, (long, units, low, high, qa) in said.items()]
    out = years.select("year", F.explode(F.array(*rows)).alias("p")).select("year", "p.*")
    file = F.concat("name", F.lit("_"), F.col("year").cast("string"), F.lit(".img"))
    return out.withColumns({"file_name": file, "category": F.lit("image"), "data_type": F.lit("INT16"), "fill_value": F.lit(FILL)})


def grid_bbox(extent: DataFrame) -> DataFrame:
    """Least and greatest map coordinates, latitude and longitude over the corners of all edge pixels of each grid, and the centres of
    its first and last pixel (ul_x, ul_y, ul_lat, ul_lon, lr_x, ..).

    extent: path, row, west, north, dx, dy (positive), ncol, nrow, utm_zone; one row for each path and row.
    """
    g = [F.col("west"), F.col("dx"), F.lit(0.0), F.col("north"), F.lit(0.0), -F.col("dy")]
    zero = F.lit(0)
    sides = [
        F.transform(F.sequence(zero, F.col("ncol")), lambda k: F.struct(k.alias("px"), zero.alias("py"))),
        F.transform(F.sequence(zero, F.col("ncol")), lambda k: F.struct(k.alias("px"), F.col("nrow").alias("py"))),
        F.transform(F.sequence(zero, F.col("nrow")), lambda k: F.struct(zero.alias("px"), k.alias("py"))),
        F.transform(F.sequence(zero, F.col("nrow")), lambda k: F.struct(F.col("ncol").alias("px"), k.alias("py"))),
    ]
    edge = extent.withColumn("p", F.explode(F.concat(*sides)))
    mx, my = pixel_to_map(F.col("p.px"), F.col("p.py"), g)
    edge = edge.withColumns({"mx": mx, "my": my})
    lat, lon = utm_to_degrees(F.col("mx"), F.col("my"), F.col("utm_zone"))
    edge = edge.withColumns({"lat": lat, "lon": lon})
    names = {"mx": "x", "my": "y", "lat": "lat", "lon": "lon"}
    box = edge.groupBy("path", "row").agg(*(f(c).alias(f"{s}_{n}") for c, n in names.items() for s, f in (("min", F.min), ("max", F.max))))
    half = F.lit(0.5)
    for name, px, py in (("ul", half, half), ("lr", F.col("ncol") - half, F.col("nrow") - half)):
        x, y = pixel_to_map(px, py, g)
        extent = extent.withColumns({f"{name}_x": x, f"{name}_y": y})
        lat, lon = utm_to_degrees(F.col(f"{name}_x"), F.col(f"{name}_y"), F.col("utm_zone"))
        extent = extent.withColumns({f"{name}_lat": lat, f"{name}_lon": lon})
    corners = extent.select("path", "row", *(f"{name}_{c}" for name in ("ul", "lr") for c in ("x", "y", "lat", "lon")))
    return box.join(corners, ["path", "row"])
