"""Scene metadata: MTL text, scene XML, catalogue and extent CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STACK = T.StructType([T.StructField(n, t) for n, t in (("file", T.StringType()), ("year", T.IntegerType()), ("season", T.StringType()), ("month", T.IntegerType()), ("day", T.IntegerType()), ("julian", T.IntegerType()), ("path", T.IntegerType()), ("row", T.IntegerType()), ("satellite", T.StringType()), ("west", T.DoubleType()), ("east", T.DoubleType()), ("north", T.DoubleType()), ("south", T.DoubleType()), ("nrow", T.IntegerType()), ("ncol", T.IntegerType()), ("dx", T.DoubleType()), ("dy", T.DoubleType()), ("utm_zone", T.IntegerType()))])
EXTENT = T.StructType([T.StructField(n, T.DoubleType()) for n in ("West", "North", "East", "South")])
MTL_KEYS = {"DATA_TYPE": "data_type", "GEOMETRIC_RMSE_MODEL": "rmse", "CLOUD_COVER": "cloud_cover"}


def mtl_values(lines: DataFrame) -> DataFrame:
    """scene_id, data_type, rmse, cloud_cover from lines (scene_id, line) of the form KEY = "value"; a missing key gives null."""
    parts = F.split("line", "=", 2)
    rows = lines.select("scene_id", F.trim(parts[0]).alias("key"), F.trim(F.regexp_replace(F.trim(F.get(parts, F.lit(1))), '"', "")).alias("value")).where(F.col("key").isin(*MTL_KEYS))
    pick = {name: F.max(F.when(F.col("key") == key, F.col("value"))) for key, name in MTL_KEYS.items()}
    every = lines.select("scene_id").distinct()
    out = rows.groupBy("scene_id").agg(*(c.alias(n) for n, c in pick.items()))
    return every.join(out, "scene_id", "left").select("scene_id", "data_type", F.expr("try_cast(rmse AS double)").alias("rmse"), F.expr("try_cast(cloud_cover AS double)").alias("cloud_cover"))


def read_mtl(spark: SparkSession, path: str) -> DataFrame:
    """The same from files named <scene_id>_MTL.txt."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_MTL\.txt$", 1)
    return mtl_values(spark.read.text(path, pathGlobFilter="*_MTL.txt").select(name.alias("scene_id"), F.col("value").alias("line")))


_BOUNDS = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in ("product", "name", "category", "nlines", "nsamps", "data_type", "file_name")] + [T.StructField("pixel_size", T.StructType([T.StructField("_x", T.DoubleType()), T.StructField("_y", T.DoubleType())]))])
_CORNER = T.StructType([T.StructField("_location", T.StringType()), T.StructField("_x", T.DoubleType()), T.StructField("_y", T.DoubleType())])
_SCENE = T.StructType(
    [
        T.StructField(
            "global_metadata",
            T.StructType(
                [
                    T.StructField("satellite", T.StringType()),
                    T.StructField("acquisition_date", T.StringType()),
                    T.StructField("wrs", T.StructType([T.StructField("_path", T.IntegerType()), T.StructField("_row", T.IntegerType())])),
                    T.StructField("projection_information", T.StructType([T.StructField("corner_point", T.ArrayType(_CORNER)), T.StructField("grid_origin", T.StringType()), T.StructField("utm_proj_params", T.StructType([T.StructField("zone_code", T.IntegerType())]))])),
                ]
            ),
        ),
        T.StructField("bands", T.StructType([T.StructField("band", T.ArrayType(_BOUNDS))])),
    ]
)


def read_scene_xml(spark: SparkSession, path: str) -> DataFrame:
    """One catalogue row for each scene file; files without the first surface reflectance band are left out."""
    rows = spark.read.format("xml").option("rowTag", "espa_metadata").option("pathGlobFilter", "*.xml").schema(_SCENE).load(path).select("*", F.col("_metadata.file_path").alias("file"))
    rows = rows.where(~F.col("file").endswith(".aux.xml"))
    band = F.filter("bands.band", lambda b: (b["_name"] == "sr_band1") & (b["_product"] == "sr_refl"))
    rows = rows.withColumn("b", F.get(band, F.lit(0))).where("b is not null")
    corner = lambda at: F.get(F.filter("global_metadata.projection_information.corner_point", lambda c: c["_location"] == at), F.lit(0))
    return rows.select(
        "file",
        F.regexp_extract("file", r"([^/]+)\.xml$", 1).alias("scene_id"),
        F.col("global_metadata.satellite").alias("satellite"),
        F.col("global_metadata.acquisition_date").alias("acq_date"),
        F.col("global_metadata.wrs._path").alias("path"),
        F.col("global_metadata.wrs._row").alias("row"),
        *(corner(at)[f"_{k}"].alias(f"{n}_{k}") for at, n in (("UL", "ul"), ("LR", "lr")) for k in "xy"),
        F.col("global_metadata.projection_information.grid_origin").alias("grid_origin"),
        F.col("global_metadata.projection_information.utm_proj_params.zone_code").alias("utm_zone"),
        F.col("b._nlines").cast("int").alias("nrow"),
        F.col("b._nsamps").cast("int").alias("ncol"),
        F.col("b.pixel_size._x").alias("dx"),
        F.col("b.pixel_size._y").alias("dy"),
    )


def write_stack(stack: DataFrame, path: str) -> None:
    stack.select(*STACK.names).write.csv(path, header=True)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by position; blanks around names and values do not matter."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def read_stack(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, STACK)


def write_extent(extent: DataFrame, path: str) -> None:
    extent.select(*(F.col(n.lower()).alias(n) for n in EXTENT.names)).write.csv(path, header=True)


def read_extent(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, EXTENT)


#: Rows of a compressed file of training rows, which one task reads.
TRAINING_ROWS = 500_000


def write_training(rows: DataFrame, path: str) -> None:
    """Headerless training rows as compressed text, a third of its size or less."""
    rows.write.option("maxRecordsPerFile", TRAINING_ROWS).csv(path, header=False, compression="gzip")


def read_training(spark: SparkSession, path: str, features: tuple[str, ...], label: str = "fire") -> DataFrame:
    """Headerless training rows: the features, then the label. A row with another number of columns is an error."""
    schema = T.StructType([*(T.StructField(f, T.DoubleType()) for f in features), T.StructField(label, T.DoubleType())])
    rows = spark.read.csv(path, schema=schema, header=False, mode="FAILFAST")
    return rows.withColumn(label, F.col(label).cast("int"))
