"""ENVI rasters of one band as rows of pixels, and back: a data source named envi, and reads at spots.

Reading: a raster is split into ranges of lines, so a file of any size is read by many tasks, each with its byte offsets. Filters on name,
y and x (equality, IN and comparisons with constants) decide which headers are read and which bytes: a line is one read, a spot another.
Files are opened with pyarrow (local, HDFS, S3 and Google stores); only headers and sizes are read while planning.

Writing: pixels sorted by raster, line and column go to the file as they come, a few lines in memory at a time. Files have temporary names until
all tasks are done, then get their own ones, header last; a failed or killed task, or a second attempt, leaves no raster behind.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from ..settings import FILL

#: Fixed values of the format: data types by their code. Those that fit into each type of value.
DTYPES = {1: "u1", 2: "i2", 3: "i4", 4: "f4", 5: "f8", 12: "u2"}
FITS = {"short": ("<i2", (1, 2)), "int": ("<i4", (1, 2, 3, 12)), "double": ("<f8", tuple(DTYPES))}
#: Bytes of a raster in a partition, pixels in a batch, and headers that are read at once while planning.
PARTITION_BYTES, BATCH_PIXELS, HEADER_READS = 32 << 20, 1 << 20, 16
_NO_END = 1 << 31


@dataclass(frozen=True)
class Header:
    lines: int
    samples: int
    code: int = 2
    big_endian: bool = False
    offset: int = 0

    @property
    def dtype(self) -> np.dtype:
        return np.dtype((">" if self.big_endian else "<") + DTYPES[self.code])

    @property
    def size(self) -> int:
        return self.offset + self.lines * self.samples * self.dtype.itemsize

    def at(self, line: int, sample: int = 0) -> int:
        return self.offset + (line * self.samples + sample) * self.dtype.itemsize


def parse_header(text: str, name: str = "header") -> Header:
    """Lines and samples must be there; the others default to one band of little-endian 16-bit numbers without an offset."""
    found = {k.lower(): v.strip() for k, v in re.findall(r"^[ \t]*([A-Za-z ]+?)[ \t]*=[ \t]*(.*)$", text, re.M)}
    number = lambda key, default=None: int(found.get(key, default))
    if "lines" not in found or "samples" not in found:
        raise ValueError(f"{name}: no lines or samples in the header")
    if number("bands", 1) != 1:
        raise ValueError(f"{name}: {found['bands']} bands; rasters of one band are read")
    if number("data type", 2) not in DTYPES:
        raise ValueError(f"{name}: data type {found['data type']} is not known")
    return Header(number("lines"), number("samples"), number("data type", 2), number("byte order", 0) == 1, number("header offset", 0))


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    store, base = fs.FileSystem.from_uri(folder)
    return store, base.rstrip("/")


@dataclass
class Lines(ds.InputPartition):
    """Ranges of lines of rasters: (name, header, first line, line after the last one, first sample, sample after the last one)."""

    ranges: list[tuple[str, Header, int, int, int, int]] = field(default_factory=list)

    @property
    def n_bytes(self) -> int:
        return sum((b - a) * (q - p) * h.dtype.itemsize for _, h, a, b, p, q in self.ranges)


@dataclass
class Wanted:
    """What filters leave of a coordinate: low <= value < high, and one of some."""

    low: int = 0
    high: int = _NO_END
    some: set | None = None

    def only(self, values: set) -> None:
        self.some = values if self.some is None else self.some & values

    def intervals(self, size: int) -> list[tuple[int, int]]:
        low, high = max(0, self.low), min(size, self.high)
        if self.some is None:
            return [(low, high)] if low < high else []
        out: list[tuple[int, int]] = []
        for v in sorted(v for v in self.some if low <= v < high):
            if out and out[-1][1] == v:
                out[-1] = (out[-1][0], v + 1)
            else:
                out.append((v, v + 1))
        return out


class EnviReader(ds.DataSourceReader):
    def __init__(self, folder: str, value: str, partition_bytes: int = PARTITION_BYTES):
        self.folder, self.value, self.partition_bytes = folder, value, partition_bytes
        self.names: set[str] | None = None
        self.place = {"y": Wanted(), "x": Wanted()}

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for f in filters:
            if not self._takes(f):
                yield f

    def _takes(self, f: ds.Filter) -> bool:
        column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if isinstance(f, ds.IsNotNull):
            return True  # there are no nulls
        if isinstance(f, (ds.EqualTo, ds.In)):
            values = set(f.value) if isinstance(f, ds.In) else {f.value}
            if column == "name":
                self.names = values if self.names is None else self.names & values
                return True
            if column in self.place and all(isinstance(v, int) for v in values):
                self.place[column].only(values)
                return True
        elif column in self.place and isinstance(getattr(f, "value", None), int):
            w = self.place[column]
            if isinstance(f, (ds.GreaterThan, ds.GreaterThanOrEqual)):
                w.low = max(w.low, f.value + isinstance(f, ds.GreaterThan))
                return True
            if isinstance(f, (ds.LessThan, ds.LessThanOrEqual)):
                w.high = min(w.high, f.value + isinstance(f, ds.LessThanOrEqual))
                return True
        return False

    def partitions(self) -> list[Lines]:
        store, base = _open(self.folder)
        sizes = {i.base_name: i.size for i in store.get_file_info(fs.FileSelector(base)) if i.is_file}
        names = sorted(n[:-4] for n in sizes if n.endswith(".hdr") and n[:-4] + ".img" in sizes)
        names = [n for n in names if self.names is None or n in self.names]
        with ThreadPoolExecutor(HEADER_READS) as pool:
            headers = list(pool.map(lambda n: self.header(store, base, n), names))
        out, room = [Lines()], self.partition_bytes
        for name, h in zip(names, headers, strict=True):
            if sizes[name + ".img"] != h.size:
                raise ValueError(f"{name}: {sizes[name + '.img']} bytes do not make {h.lines} lines of {h.samples} samples of {h.dtype.itemsize} bytes after {h.offset}")
            if h.code not in FITS[self.value][1]:
                raise ValueError(f"{name}: values of data type {h.code} do not fit into {self.value}")
            for p, q in self.place["x"].intervals(h.samples):
                width = (q - p) * h.dtype.itemsize
                for a, b in self.place["y"].intervals(h.lines):
                    while a < b:
                        n = min(b - a, max(1, room // width))
                        out[-1].ranges.append((name, h, a, a + n, p, q))
                        a, room = a + n, room - n * width
                        if room < width:
                            out.append(Lines())
                            room = self.partition_bytes
        return [p for p in out if p.ranges] or out[:1]

    def header(self, store: fs.FileSystem, base: str, name: str) -> Header:
        with store.open_input_stream(f"{base}/{name}.hdr") as f:
            return parse_header(f.read().decode("latin-1"), name)

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        store, base = _open(self.folder)
        opened, f = None, None
        for name, h, a, b, p, q in partition.ranges:
            if name != opened:
                if f is not None:
                    f.close()
                opened, f = name, store.open_input_file(f"{base}/{name}.img")
            step = max(1, BATCH_PIXELS // (q - p))
            for top in range(a, b, step):
                rows = range(top, min(b, top + step))
                if q - p == h.samples:
                    data = self.at(f, h.at(top), len(rows) * h.samples * h.dtype.itemsize)
                else:
                    data = b"".join(self.at(f, h.at(y, p), (q - p) * h.dtype.itemsize) for y in rows)
                value = np.frombuffer(data, h.dtype).astype(FITS[self.value][0])
                y, x = np.repeat(np.arange(rows.start, rows.stop, dtype=np.int32), q - p), np.tile(np.arange(p, q, dtype=np.int32), len(rows))
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(name), len(value)), pa.array(y), pa.array(x), pa.array(value)], ["name", "y", "x", "value"])
        if f is not None:
            f.close()

    def at(self, f: pa.NativeFile, offset: int, n: int) -> bytes:
        f.seek(offset)
        return f.read(n)


@dataclass
class Written(ds.WriterCommitMessage):
    """Where a task has left its rasters."""

    place: str
    names: list[str]


class EnviWriter(ds.DataSourceArrowWriter):
    """Rows (name, y, x, value) that come sorted; each raster in one task."""

    def __init__(self, folder: str, lines: int, samples: int, overwrite: bool):
        self.folder, self.lines, self.samples, self.overwrite = folder, lines, samples, overwrite
        self.attempts = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = _open(self.folder)
        place, raster, names = f"{base}/{self.attempts}/{uuid.uuid4().hex}", None, []
        store.create_dir(place, recursive=True)
        for batch in iterator:
            if not batch.num_rows:
                continue
            name = batch.column(0).to_numpy(zero_copy_only=False)
            y, x, value = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            cuts = np.flatnonzero(name[1:] != name[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(name)], strict=True):
                if raster is None or raster.name != name[a]:
                    if raster is not None:
                        raster.close()
                    if name[a] in names:
                        raise ValueError(f"{name[a]}: rows of a raster must follow each other")
                    raster = _Raster(store, place, name[a], self.lines, self.samples)
                    names.append(name[a])
                raster.put(y[a:b], x[a:b], value[a:b])
        if raster is not None:
            raster.close()
        return Written(place, names)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = _open(self.folder)
        done = [m for m in messages if m is not None]
        names = [n for m in done for n in m.names]
        if len(names) != len(set(names)):
            self.abort(messages)
            raise ValueError("a raster was written by several tasks: deal pixels by name first, as write_envi() does")
        if self.overwrite:
            old = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
            for i in sorted(old, key=lambda i: i.base_name.endswith(".img")):  # headers first, so that no reader sees half of a raster
                if i.is_file and i.base_name.endswith((".hdr", ".img")):
                    store.delete_file(i.path)
        with ThreadPoolExecutor(HEADER_READS) as pool:
            for kind in ("img", "hdr"):
                list(pool.map(lambda t, k=kind: store.move(f"{t[0]}/{t[1]}.{k}", f"{base}/{t[1]}.{k}"), [(m.place, n) for m in done for n in m.names]))
        self._clear(store, base)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_open(self.folder))

    def _clear(self, store: fs.FileSystem, base: str) -> None:
        if store.get_file_info(f"{base}/{self.attempts}").type != fs.FileType.NotFound:
            store.delete_dir(f"{base}/{self.attempts}")


class _Raster:
    """A file that grows line by line: blocks of lines are filled in memory and written once pixels of later ones come."""

    def __init__(self, store: fs.FileSystem, place: str, name: str, lines: int, samples: int):
        self.name, self.lines, self.samples = name, lines, samples
        self.step = max(1, BATCH_PIXELS // max(1, samples))
        self.top = 0
        self.block = self._blank()
        self.file = store.open_output_stream(f"{place}/{name}.img")
        header = f"ENVI\nsamples = {samples}\nlines   = {lines}\nbands   = 1\ndata type = 2\nbyte order = 0\ninterleave = bsq\n"
        with store.open_output_stream(f"{place}/{name}.hdr") as f:
            f.write(header.encode())

    def _blank(self) -> np.ndarray:
        return np.full(max(0, min(self.step, self.lines - self.top)) * self.samples, FILL, "<i2")

    def _flush(self) -> None:
        self.file.write(self.block.tobytes())
        self.top += self.step
        self.block = self._blank()

    def put(self, y: np.ndarray, x: np.ndarray, value: np.ndarray) -> None:
        wrong = np.flatnonzero((y < 0) | (y >= self.lines) | (x < 0) | (x >= self.samples))
        if len(wrong):
            raise ValueError(f"{self.name}: pixel {x[wrong[0]]} of line {y[wrong[0]]} is outside {self.lines} lines of {self.samples} samples")
        if y[0] < self.top:
            raise ValueError(f"{self.name}: lines do not come in order")
        while len(y):
            n = int(np.searchsorted(y, self.top + self.step))
            self.block[(y[:n].astype(np.int64) - self.top) * self.samples + x[:n]] = value[:n]
            y, x, value = y[n:], x[n:], value[n:]
            if len(y):
                self._flush()

    def close(self) -> None:
        while self.top < self.lines:
            self._flush()
        self.file.close()


class EnviSource(ds.DataSource):
    """Options: path; value (short, int or double) and partition_bytes for reading; lines and samples for writing."""

    @classmethod
    def name(cls) -> str:
        return "envi"

    def schema(self) -> str:
        return f"name string, y int, x int, value {self.options.get('value', 'short')}"

    def reader(self, schema: object) -> EnviReader:
        return EnviReader(self.options["path"], self.options.get("value", "short"), int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema: object, overwrite: bool) -> EnviWriter:
        return EnviWriter(self.options["path"], int(self.options["lines"]), int(self.options["samples"]), overwrite)


def _registered(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(EnviSource)
    return spark


def read_envi(spark: SparkSession, folder: str, value: str = "short", partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """name, y, x, value of all <name>.img with a <name>.hdr in a folder.

    A file whose size does not fit its header is an error, and so are values that do not fit into the type asked for.
    """
    return _registered(spark).read.format("envi").option("value", value).option("partition_bytes", partition_bytes).load(folder)


def write_envi(pixels: DataFrame, folder: str, lines: int, samples: int, mode: str = "append") -> None:
    """Writes one raster for each name of pixels (name, y, x, value), fill where there is no pixel.

    A pixel outside the raster is an error; of several values for a pixel the greatest stays. mode: append replaces rasters of the
    same names, overwrite all rasters of the folder.
    """
    _registered(pixels.sparkSession)
    rows = pixels.select("name", F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("value").cast("short").alias("value"))
    rows = rows.repartition("name").sortWithinPartitions("name", "y", "x", "value")
    rows.write.format("envi").option("lines", lines).option("samples", samples).mode(mode).save(folder)


def read_spots(spots: DataFrame, folder: str, value: str = "short", lines: int = 256) -> DataFrame:
    """spots (name, y, x and any other columns) that lie on a raster of a folder, with its value there.

    Spots are dealt by raster and block of lines and sorted, so that a task opens a raster once and reads forward; spots near each other are
    one read. Spots without a raster, or outside it, are left out.
    """
    kind = FITS[value][0]
    rows = spots.repartition("name", F.floor(F.col("y") / lines)).sortWithinPartitions("name", "y", "x")
    schema = f"{spots.select('*', F.lit(0).cast(value).alias('value'))._jdf.schema().toDDL()}"
    at_name, at_y, at_x = (spots.columns.index(c) for c in ("name", "y", "x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        reader, opened, f, h = EnviReader(folder, value), None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(at_name).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(names)], strict=True):
                if names[a] is None:
                    continue
                if names[a] != opened:
                    if f is not None:
                        f.close()
                    opened, f = names[a], None
                    found = store.get_file_info([f"{base}/{opened}.hdr", f"{base}/{opened}.img"])
                    if all(i.is_file for i in found):
                        h, f = reader.header(store, base, opened), store.open_input_file(f"{base}/{opened}.img")
                        if h.code not in FITS[value][1] or found[1].size != h.size:
                            raise ValueError(f"{opened}: {found[1].size} bytes of data type {h.code} do not fit its header or {value}")
                if f is None:
                    continue
                part = batch.slice(a, b - a)
                y, x = (part.column(k).cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for k in (at_y, at_x))
                inside = np.flatnonzero((y >= 0) & (y < h.lines) & (x >= 0) & (x < h.samples))
                if len(inside):
                    data = _gathered(reader, f, h, y[inside], x[inside]).astype(kind)
                    part = part.take(pa.array(inside))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data)], [*part.schema.names, "value"])
        if f is not None:
            f.close()

    return rows.mapInArrow(run, schema)


#: Bytes between two spots that are read over rather than skipped.
_GAP = 1 << 14


def _gathered(reader: EnviReader, f: pa.NativeFile, h: Header, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values at sorted spots."""
    size, at = h.dtype.itemsize, h.offset + (y * h.samples + x) * h.dtype.itemsize
    out = np.zeros(len(at), h.dtype)
    cuts = np.flatnonzero(np.diff(at) > _GAP) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
        data = np.frombuffer(reader.at(f, int(at[a]), int(at[b - 1] - at[a]) + size), h.dtype)
        out[a:b] = data[(at[a:b] - at[a]) // size]
    return out


def write_products(products: DataFrame, path: str) -> None:
    """Products of pixels, by path, row and year."""
    products.write.partitionBy("path", "row", "year").parquet(path)
