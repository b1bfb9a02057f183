import numpy as np
import pytest
from pyspark.sql import functions as F

from scorchmap.operators.features import FEATURES
from scorchmap.sources import metadata, rasters

XML = """<espa_metadata version="1.0"><global_metadata><satellite>LANDSAT_5</satellite><acquisition_date>1999-07-04</acquisition_date>
<wrs system="2" path="35" row="32"/><projection_information projection="UTM" units="meters"><corner_point location="UL" x="300000" y="4500000"/>
<corner_point location="LR" x="305970" y="4495530"/><grid_origin>CENTER</grid_origin><utm_proj_params><zone_code>13</zone_code></utm_proj_params></projection_information></global_metadata>
<bands><band product="toa_refl" name="toa_band6" nlines="1" nsamps="1"><pixel_size x="1" y="1" units="m"/></band>{band}</bands></espa_metadata>"""
BAND = '<band product="sr_refl" name="sr_band1" nlines="150" nsamps="200"><pixel_size x="30" y="30" units="m"/></band>'


def test_scene_xml(spark, tmp_path):
    for name, band in (("LT50350321999185XXX01.xml", BAND), ("bad.xml", ""), ("LT50350321999185XXX01.aux.xml", BAND)):
        (tmp_path / name).write_text(XML.format(band=band))
    rows = metadata.read_scene_xml(spark, f"file://{tmp_path}").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.scene_id, r.acq_date, r.path, r.row, r.nrow, r.ncol, r.dx, r.ul_x, r.lr_y, r.utm_zone, r.grid_origin) == ("LT50350321999185XXX01", "1999-07-04", 35, 32, 150, 200, 30.0, 300000.0, 4495530.0, 13, "CENTER")


def test_mtl(spark, tmp_path):
    (tmp_path / "A_MTL.txt").write_text('  DATA_TYPE = "L1T"\nGEOMETRIC_RMSE_MODEL = 4.5\nCLOUD_COVER = 12.0\nEND\n')
    (tmp_path / "B_MTL.txt").write_text("GROUP = X\n")
    got = {r.scene_id: (r.data_type, r.rmse, r.cloud_cover) for r in metadata.read_mtl(spark, f"file://{tmp_path}").collect()}
    assert got == {"A": ("L1T", 4.5, 12.0), "B": (None, None, None)}


def test_stack_and_extent(spark, tmp_path):
    (tmp_path / "stack.csv").write_text("file, year, season, month, day, julian, path, row, satellite, west, east, north, south, nrow, ncol, dx, dy, utm_zone\n/a.xml, 1999, summer, 7, 4, 185, 35, 32, LT5, 0, 1, 2, 3, 4, 5, 30, 30, 13\n")
    stack = metadata.read_stack(spark, f"file://{tmp_path}/stack.csv")
    assert stack.first().season == "summer"
    metadata.write_stack(stack, f"file://{tmp_path}/out")
    assert metadata.read_stack(spark, f"file://{tmp_path}/out").collect() == stack.collect()
    metadata.write_extent(stack, f"file://{tmp_path}/extent")
    assert tuple(metadata.read_extent(spark, f"file://{tmp_path}/extent").first()) == (0.0, 2.0, 1.0, 3.0)


def test_training_rows(spark, tmp_path):
    (tmp_path / "good.csv").write_text(",".join(["1"] * 50) + ",0\n")
    (tmp_path / "bad.csv").write_text(",".join(["1"] * 49) + ",0\n")
    assert metadata.read_training(spark, f"file://{tmp_path}/good.csv", FEATURES).first().fire == 0
    with pytest.raises(Exception, match="(?i)malformed"):
        metadata.read_training(spark, f"file://{tmp_path}/bad.csv", FEATURES).collect()


def raster(folder, name, data, more="", junk=b""):
    (folder / f"{name}.img").write_bytes(junk + data.tobytes())
    (folder / f"{name}.hdr").write_text(f"ENVI\nsamples = {data.shape[1]}\nlines   = {data.shape[0]}\n{more}")


def pixels(df):
    return {(r.name, r.y, r.x): r.value for r in df.collect()}


def test_envi(spark, tmp_path):
    data = np.arange(12, dtype="<i2").reshape(4, 3)
    raster(tmp_path, "p", data)
    got = rasters.read_envi(spark, f"file://{tmp_path}")
    assert pixels(got) == {("p", y, x): int(data[y, x]) for y in range(4) for x in range(3)}
    out = f"file://{tmp_path}/out"
    rasters.write_envi(got.where("value != 5").union(got.where("y = 3").withColumn("value", F.expr("value - 1S"))), out, 4, 3)
    back = pixels(rasters.read_envi(spark, out))
    assert len(back) == 12 and back["p", 1, 2] == -9999 and back["p", 3, 2] == 11
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["p.hdr", "p.img"]
    rasters.write_envi(got.withColumn("name", F.lit("q")), out, 5, 3)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["p.hdr", "p.img", "q.hdr", "q.img"]
    rasters.write_envi(got.withColumn("name", F.lit("r")), out, 4, 3, mode="overwrite")
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["r.hdr", "r.img"]
    assert rasters.read_envi(spark, out).where("name = 'none'").count() == 0


@pytest.mark.parametrize("place", ["-1 AS y", "4 AS y", "3 AS x"])
def test_a_failed_write_leaves_nothing(spark, tmp_path, place):
    rows = spark.range(12).selectExpr("concat('p', id % 4) AS name", "CAST(id % 4 AS INT) AS y", "CAST(id % 3 AS INT) AS x", "CAST(id AS SHORT) AS value")
    other = rows.limit(1).select("name", "value", *(F.expr(place if place.endswith(c) else c) for c in ("y", "x"))).select("name", "y", "x", "value")
    with pytest.raises(Exception, match="outside"):
        rasters.write_envi(rows.unionByName(other), f"file://{tmp_path}/wrong", 4, 3)
    assert list((tmp_path / "wrong").iterdir()) == []


def test_envi_headers(spark, tmp_path):
    data = np.array([[1, 2, 300], [4, 5, 6]])
    raster(tmp_path, "big", data.astype(">i2"), "byte order = 1\nheader offset = 7\ndata type = 2\nbands = 1\n", b"x" * 7)
    raster(tmp_path, "wide", data.astype("<i4") * 1000, "data type = 3\n")
    raster(tmp_path, "real", data.astype("<f4") / 2, "data type = 4\n")
    of = lambda name, value: {k[1:]: v for k, v in pixels(rasters.read_envi(spark, f"file://{tmp_path}", value).where(F.col("name") == name)).items()}
    assert of("big", "short") == of("big", "double") == {(y, x): int(data[y, x]) for y in range(2) for x in range(3)}
    assert of("wide", "int")[0, 2] == 300_000 and of("real", "double")[1, 1] == 2.5
    for name, value, said in (("wide", "short", "do not fit"), ("real", "int", "do not fit")):
        with pytest.raises(Exception, match=said):
            of(name, value)
    (tmp_path / "real.hdr").write_text("samples = 3\nlines = 5\ndata type = 4\n")
    with pytest.raises(Exception, match="do not make"):
        of("real", "double")
    for wrong, said in (("lines = 2\n", "no lines or samples"), ("lines = 2\nsamples = 3\nbands = 2\n", "2 bands"), ("lines = 2\nsamples = 3\ndata type = 6\n", "not known")):
        with pytest.raises(ValueError, match=said):
            rasters.parse_header(wrong)


class Counting(rasters.EnviReader):
    """Counts the bytes that are read, and the headers."""

    read_bytes = headers = 0

    def at(self, f, offset, n):
        self.read_bytes += n
        return super().at(f, offset, n)

    def header(self, store, base, name):
        self.headers += 1
        return super().header(store, base, name)


def test_a_filter_reads_its_lines_only(spark, tmp_path):
    data = (np.arange(200 * 50) % 30_000).astype("<i2").reshape(200, 50)
    for name in ("a", "b", "c"):
        raster(tmp_path, name, data)
    folder = f"file://{tmp_path}"
    ds = rasters.ds
    for filters, rows, headers in (
        ([ds.EqualTo(("name",), "b"), ds.EqualTo(("y",), 7)], 50, 1),
        ([ds.EqualTo(("name",), "b"), ds.EqualTo(("y",), 7), ds.EqualTo(("x",), 3)], 1, 1),
        ([ds.In(("name",), ("a", "c", "z")), ds.GreaterThan(("y",), 189), ds.LessThanOrEqual(("x",), 1)], 2 * 10 * 2, 2),
        ([ds.In(("y",), (3, 4, 9, 900)), ds.GreaterThanOrEqual(("y",), 4), ds.LessThan(("y",), 10_000)], 3 * 2 * 50, 3),
        ([ds.LessThan(("y",), 0)], 0, 3),
    ):
        reader = Counting(folder, "short", 1000)
        assert list(reader.pushFilters(filters)) == []
        parts = reader.partitions()
        batches = [b for p in parts for b in reader.read(p)]
        assert sum(b.num_rows for b in batches) == rows and reader.read_bytes == sum(p.n_bytes for p in parts) == 2 * rows and reader.headers == headers
        assert all(p.n_bytes <= 1000 for p in parts)
    left = [ds.EqualTo(("value",), 3), ds.Not(ds.EqualTo(("y",), 3)), ds.StringContains(("name",), "a")]
    assert list(Counting(folder, "short").pushFilters(left)) == left
    # a file is split, and what Spark pushes gives the same rows
    df = rasters.read_envi(spark, folder, partition_bytes=1000)
    assert df.rdd.getNumPartitions() == 60
    where = df.where("name IN ('a', 'c') AND y > 150 AND y <= 152 AND x = 9 AND value <> 1")
    assert where.rdd.getNumPartitions() == 1 and "BatchScan" in where._jdf.queryExecution().toString()
    assert pixels(where) == {(n, y, 9): int(data[y, 9]) for n in "ac" for y in (151, 152)}


def test_spots(spark, tmp_path):
    data = np.arange(300 * 40, dtype="<i4").reshape(300, 40)
    for name in ("a", "b"):
        raster(tmp_path, name, data * (1 if name == "a" else -1), "data type = 3\n")
    rows = [(k, "abz"[k % 3], k * 7 % 310 - 3, k * 11 % 43 - 1) for k in range(200)] + [(500, None, 1, 1), (501, "a", None, 1), (502, "a", 5, 5), (503, "a", 5, 5)]
    spots = spark.createDataFrame(rows, "id int, name string, y int, x int")
    want = {k: int(data[y, x]) * (1 if n == "a" else -1) for k, n, y, x in rows if n in ("a", "b") and y is not None and 0 <= y < 300 and 0 <= x < 40}
    assert {r.id: r.value for r in rasters.read_spots(spots, f"file://{tmp_path}", "int", lines=64).collect()} == want
    assert rasters.read_spots(spots.limit(0), f"file://{tmp_path}", "int").count() == 0


def test_a_raster_is_written_in_blocks(tmp_path, monkeypatch):
    """What a task holds does not grow with the lines of a raster."""
    import pyarrow as pa

    most = []

    class Seen(rasters._Raster):
        def put(self, y, x, value):
            super().put(y, x, value)
            most.append(self.block.nbytes)

    monkeypatch.setattr(rasters, "_Raster", Seen)
    monkeypatch.setattr(rasters, "BATCH_PIXELS", 64)
    for lines in (100, 10_000):
        most.clear()
        writer = rasters.EnviWriter(f"file://{tmp_path}/{lines}", lines, 16, False)
        y = np.arange(0, lines, 3, dtype=np.int32)
        batches = [pa.RecordBatch.from_arrays([pa.repeat(pa.scalar("p"), len(part)), pa.array(part), pa.array(part % 16), pa.array((part % 99).astype(np.int16))], ["name", "y", "x", "value"]) for part in np.array_split(y, 7)]
        message = writer.write(iter(batches))
        assert not (tmp_path / str(lines) / "p.img").exists()
        writer.commit([message, None])
        got = np.fromfile(tmp_path / str(lines) / "p.img", "<i2").reshape(lines, 16)
        assert (got[y, y % 16] == y % 99).all() and (got != -9999).sum() == len(y) and max(most) <= 64 * 2
    with pytest.raises(ValueError, match="several tasks"):
        writer.commit([message, message])


def test_products(spark, tmp_path):
    df = spark.range(3).select(F.lit(35).alias("path"), F.lit(32).alias("row"), (F.col("id") + 2000).alias("year"), F.col("id").alias("burned_area"))
    rasters.write_products(df, f"file://{tmp_path}/p")
    assert spark.read.parquet(f"file://{tmp_path}/p").where("year = 2001").count() == 1
