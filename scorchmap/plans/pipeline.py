"""From looks to yearly burn products: the whole job."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import tile
from ..functions.quality import product_code
from ..operators.annual import PRODUCTS, annual_burn, product_catalog
from ..operators.features import features, previous_year
from ..operators.regions import burn_class, grown_runs
from ..operators.screening import _small, catalogue, lookup_models, screen, stack_years, within_years
from ..operators.temporal import annual_max, seasonal_means, seasonal_wide, with_indices
from ..settings import INDICES, RegionOptions, ScreenOptions
from ..sources.rasters import write_envi, write_products
from ..storage import materialize


def co_locate(looks: DataFrame, side: int = 256) -> DataFrame:
    """Shuffles looks once by stack and tile; later groupings and joins by pixel then need no shuffle of their own.

    Joins take this up with spark.sql.requireAllClusterKeysForCoPartition=false, see keep_in_place().
    """
    return looks.select("*", *tile(side)).repartition("path", "row", "tile_y", "tile_x")


#: Joins take up a partitioning by stack and tile. The 50 features of a row are more code than the JVM compiles as one method (8000 bytes);
#: above that, Spark then uses its operators one by one, which are compiled.
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.codegen.hugeMethodLimit": "8000"}


def keep_in_place(spark: SparkSession) -> None:
    """From now on, joins of this session on a pixel use a partitioning by its stack and tile, and features are made by compiled code."""
    for name, value in IN_PLACE.items():
        spark.conf.set(name, value)


@contextmanager
def kept_in_place(spark: SparkSession) -> Iterator[None]:
    """The same for what runs within it."""
    old = {name: spark.conf.get(name) for name in IN_PLACE}
    keep_in_place(spark)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def featured_looks(looks: DataFrame, years: DataFrame | None = None, tile_side: int | None = None) -> DataFrame:
    """Looks after the first year of their stack with their 50 features. looks: obs columns and qa, read several times.

    years: of each stack, see screening.stack_years(). tile_side: deals looks by tile first.
    """
    years = materialize(stack_years(looks) if years is None else years, "years")
    stored = with_indices(looks if tile_side is None else co_locate(looks, tile_side))
    wide = seasonal_wide(seasonal_means(stored, years))
    own = within_years(stored.drop(*INDICES), years)
    return features(previous_year(own, wide, annual_max(stored), seen=looks))


def burned_pipeline(looks: DataFrame, probability: Column | Callable[[DataFrame], DataFrame], options: RegionOptions = RegionOptions(), scene: str = "scene_id", tile_side: int = 256, years: DataFrame | None = None) -> DataFrame:
    """Yearly burn products of looks (obs columns and qa) of any number of stacks.

    probability: a column of the featured looks between 0 and 1, or a function that adds burn_prob to them. scene: the column by
    which regions are formed, within each stack.
    """
    featured = featured_looks(looks, years, tile_side)
    scoring = callable(probability) and not isinstance(probability, Column)
    keep = ["scene_id", *([scene] if scene != "scene_id" else []), "path", "row", "year", "julian", "y", "x", "burn_prob"]
    with kept_in_place(looks.sparkSession):
        scored = probability(featured) if scoring else featured.withColumn("burn_prob", product_code(probability))
        burn = materialize(scored.select(*keep), "burn")
    one = burn.withColumn("scene", F.struct("path", "row", F.col(scene).alias("scene")))
    classed = burn_class(one, grown_runs(one.select("scene", "y", "x", "burn_prob"), options))
    return annual_burn(classed)


def job(
    scenes: DataFrame,
    looks: DataFrame,
    models: DataFrame,
    probabilities: dict[str, Column | Callable[[DataFrame], DataFrame]],
    screening: ScreenOptions = ScreenOptions(),
    options: RegionOptions = RegionOptions(),
    start: int | None = None,
    end: int | None = None,
    scene: str = "scene_id",
    tile_side: int = 256,
) -> DataFrame:
    """From the list of scenes (scene_id, path, row, acq_date, data_type, rmse, cloud_cover) and their looks to yearly burn products.

    The years of each stack come from all its scenes, before any is screened out; those of its first year only serve the next one.
    A stack without a model is an error, and so is a model that is not in probabilities: a column of the featured looks for each model, or
    a function that adds burn_prob to them, as trees.score_looks() with a trained model does.
    """
    # written first: it is read several times, and tests of dates would otherwise move down to the rows that the list is made of
    listed = [c for c in ("scene_id", "path", "row", "acq_date", "data_type", "rmse", "cloud_cover") if c in scenes.columns]
    dated = catalogue(materialize(scenes.select(*listed), "scenes"))
    years = stack_years(dated, start, end)
    kept = screen(dated, screening).where("exclude_reason is null")
    known = lookup_models(kept, models, required=True).select("scene_id", "path", "row", "model").distinct()
    if known.where(~F.col("model").isin(*probabilities)).limit(1).count():
        raise ValueError("a model has no probability")
    own = materialize(looks.join(F.broadcast(known) if _small(known) else known, ["scene_id", "path", "row"]), "looks")
    return burned_pipeline(own, by_model(probabilities), options, scene, tile_side, years)


def by_model(probabilities: dict[str, Column | Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame], DataFrame]:
    """A function that adds burn_prob to looks by the model that each names in a column model. All columns are one pass over the looks."""
    columns = {n: p for n, p in probabilities.items() if not callable(p) or isinstance(p, Column)}

    def score(featured: DataFrame) -> DataFrame:
        parts, rest = [], {n: p for n, p in probabilities.items() if n not in columns}
        if rest:
            featured = materialize(featured, "featured")  # else each model would make the features again
        if columns:
            each = F.coalesce(*(F.when(F.col("model") == name, p) for name, p in columns.items()))
            parts.append(featured.where(F.col("model").isin(*columns)).withColumn("burn_prob", product_code(each)))
        parts += [add(featured.where(F.col("model") == name)) for name, add in rest.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    return score


def write_outputs(products: DataFrame, extent: DataFrame, folder: str) -> DataFrame:
    """What a job leaves: products by path, row and year, a raster of each product and year of each stack, and their catalogue.

    extent: path, row, nrow, ncol of the common grid of each stack. Returns the catalogue with path and row.
    """
    write_products(products, f"{folder}/products")
    kept = products.sparkSession.read.schema(products.schema).parquet(f"{folder}/products")
    spans = kept.groupBy("path", "row").agg(F.min("year").alias("first"), F.max("year").alias("last"))
    sizes = {(r.path, r.row): (r.nrow, r.ncol) for r in extent.select("path", "row", "nrow", "ncol").collect()}  # a row for each stack
    catalogue = None
    for s in spans.orderBy("path", "row").collect():
        own = kept.where((F.col("path") == s.path) & (F.col("row") == s.row))
        stacked = own.select("year", "y", "x", F.explode(F.create_map(*(v for p in PRODUCTS for v in (F.lit(p), F.col(p))))).alias("product", "value"))
        named = stacked.select(F.concat("product", F.lit("_"), F.col("year").cast("string")).alias("name"), "y", "x", "value")
        write_envi(named, f"{folder}/rasters/{s.path:03d}{s.row:03d}", *sizes[s.path, s.row])
        rows = product_catalog(products.sparkSession, s.first, s.last).join(own.select("year").distinct(), "year").select(F.lit(s.path).alias("path"), F.lit(s.row).alias("row"), "*")
        catalogue = rows if catalogue is None else catalogue.unionByName(rows)
    if catalogue is None:
        raise ValueError("no products")
    catalogue.coalesce(1).write.json(f"{folder}/catalogue")  # four rows for each stack and year
    return catalogue
