from pyspark.sql import functions as F

from scorchmap.functions.grid import map_to_pixel, utm_to_degrees
from scorchmap.functions.indices import feature_index, further_index, stored_index
from scorchmap.functions.quality import product_code, qa_code
from scorchmap.functions.scenes import date_parts, season_year


def test_dates(spark):
    given = ["2000-12-31", "2001-12-31", "2000-02-29", "1999-02-29", "2001-13-01", "1899-12-31", "2001/01/01", "2001-1-1", None]
    parts = date_parts("acq_date")
    rows = spark.createDataFrame([(g,) for g in given], "acq_date string").select(*(c.alias(n) for n, c in parts.items())).collect()
    assert [r.julian for r in rows] == [366, 365, 60, None, None, None, None, 1, None]
    assert [r.season for r in rows[:3]] == ["winter", "winter", "winter"]
    assert spark.createDataFrame([(1999, 12), (2000, 1)], "year int, month int").select(season_year().alias("s")).collect() == [(2000,), (2000,)]


def test_quality_order(spark):
    names = ["qa_fill", "qa_cloud", "qa_adjacent", "qa_shadow", "qa_snow", "qa_water"]
    rows = [tuple(int(k >= j) for k in range(6)) for j in range(7)] + [(0, 0, 1, 1, 0, 0)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    assert [r[0] for r in df.select(qa_code()).collect()] == [-9999, -7, -6, -5, -4, -3, 0, -6]
    assert [r[0] for r in df.select(qa_code("point")).collect()] == [-9999, -7, -6, -6, -4, -3, 0, -6]


def test_indices(spark):
    df = spark.createDataFrame([(0, 0, 0, 0), (100, 300, 200, -9999), (1, 3, 1, 1)], "b3 int, b4 int, b5 int, b7 int").withColumn("b1", F.lit(1)).withColumn("qa", F.lit(0))
    assert [r[0] for r in df.select(stored_index("ndvi")).collect()] == [0, 500, 500]
    assert [r[0] for r in df.select(stored_index("nbr")).collect()] == [0, -9999, 500]
    assert [r[0] for r in df.withColumn("qa", F.lit(-7)).select(feature_index("ndvi")).collect()] == [0.0, 500.0, 500.0]
    assert [r[0] for r in df.withColumn("qa", F.lit(-9999)).select(feature_index("ndvi")).collect()] == [0.0] * 3
    assert [r[0] for r in df.select(further_index("csi")).collect()] == [0.0, 1.5, 3.0]
    assert df.select(further_index("baim2")).collect()[1][0] == -9999.0


def test_product_codes(spark):
    df = spark.createDataFrame([(0.005, 0), (0.9949, 0), (0.5, -7), (0.5, -9999)], "p double, qa int")
    assert [r[0] for r in df.select(product_code(F.col("p"))).collect()] == [1, 99, -9998, -9999]


def test_places(spark):
    row = spark.range(1).select(*(c.alias(n) for n, c in zip(("x", "y"), map_to_pixel(F.lit(59.0), F.lit(-59.0), F.lit(0.0), F.lit(0.0), F.lit(30.0), F.lit(-30.0)), strict=True))).first()
    assert (row.x, row.y) == (1, 1)
    lat, lon = utm_to_degrees(F.lit(500000.0), F.lit(4649776.22482), F.lit(33))
    found = spark.range(1).select(lat.alias("a"), lon.alias("b")).first()
    assert abs(found.a - 42.0) < 1e-6 and abs(found.b - 15.0) < 1e-9


def test_dates_of_other_forms(spark):
    want = {
        "1999-1-5": (1999, 1, 5), " 1999-07-04T18:02:11.5Z": (1999, 7, 4), "2000-2-29 noon": (2000, 2, 29), "1999- 7- 4": (1999, 7, 4), "1999-07-123": (1999, 7, 12),
        "1999-2-29": None, "1999-13-1": None, "1999-0-1": None, "1999-1-0": None, "199-01-01": None, "19990704": None, "1999-07": None, "": None, "1999/07/04": None, "1999-07 -04": None,
    }
    parts = date_parts("acq_date")
    rows = spark.createDataFrame([(g,) for g in want], "acq_date string").select("acq_date", *(parts[n].alias(n) for n in ("year", "month", "day"))).collect()
    assert {r.acq_date: (r.year, r.month, r.day) if r.year is not None else None for r in rows} == want
