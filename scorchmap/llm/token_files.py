"""Flat token files: unsigned ids in a row, 64-bit document offsets, memory-mapped on reading.

Documents are range-partitioned by doc_id and sorted; each partition writes ``part-N.ids`` (16-bit ids where the vocabulary
allows it, else 32-bit, little-endian), ``part-N.offsets`` (64-bit: each document's first id in the file, and the end) and
``part-N.docs`` (64-bit doc_ids). A file appears under its name only when it is whole, so a task that is run again replaces
it with the same bytes. The number of ids before each file comes from prefix sums over one small row for each file.

The number of files follows the bytes of text. Null text counts as empty (just the end id). Rows that share a doc_id are ordered
by a hash of their text and may go to several files; a null doc_id is kept as the least 64-bit integer and comes first. An empty
table gives no files. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .encoding import append_id, as_batch, encoder
from .textops import by_bytes, text_bytes

_NO_ID = -(1 << 63)
_FILES = pa.schema([("file_no", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class _Writer:
    def __init__(self, uri: str, name: str):
        self.fs, folder = _place(uri)
        self.fs.create_dir(folder, recursive=True)
        context = TaskContext.get()
        self.names = [(f"{folder}/{name}.{kind}", f"{folder}/_{name}.{kind}.{context.taskAttemptId()}") for kind in ("ids", "offsets", "docs")]
        self.out = [self.fs.open_output_stream(part) for _, part in self.names]

    def write(self, *data: np.ndarray) -> None:
        for out, x in zip(self.out, data, strict=True):
            out.write(np.ascontiguousarray(x).data)

    def close(self) -> None:
        for out, (name, part) in zip(self.out, self.names, strict=True):
            out.close()
            self.fs.move(part, name)


FILE_BYTES = 64 << 20


def file_count(docs: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Files of about so many bytes of text, and one for each core at least."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // file_bytes))


def write_token_files(docs: DataFrame, uri: str, vocabulary: str, end_id: int, files: int, unit: str = "drop", dtype: str = "<u2") -> list[tuple[int, int, int, int]]:
    """Writes the files and returns the manifest: (file_no, n_docs, n_tokens, ids before it), one entry for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, out, n_docs, n_tokens = TaskContext.get().partitionId(), None, 0, 0
        for batch in by_bytes(batches):
            out = out or _Writer(uri, f"part-{number:06d}")
            ids, first = append_id(*encoder(vocabulary, unit).encode(*text_bytes(batch.column(1))), end_id)
            if len(ids) and int(ids.max()) > np.iinfo(dtype).max:
                raise ValueError(f"an id of {int(ids.max())} does not fit {dtype}")
            out.write(ids.astype(dtype), (first[:-1] + n_tokens).astype("<u8"), batch.column(0).fill_null(_NO_ID).to_numpy().astype("<i8"))
            n_docs, n_tokens = n_docs + batch.num_rows, n_tokens + len(ids)
        if out:
            out.write(np.zeros(0, dtype), np.array([n_tokens], "<u8"), np.zeros(0, "<i8"))
            out.close()
            yield as_batch({"file_no": [number], "n_docs": [n_docs], "n_tokens": [n_tokens]}, _FILES)

    order = [F.col("doc_id").asc_nulls_first(), F.col("mark").asc()]
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).repartitionByRange(files, *order).sortWithinPartitions(*order, F.col("text").asc_nulls_first()).drop("mark")
    rows = sorted(tuple(r) for r in ordered.mapInArrow(run, "file_no long, n_docs long, n_tokens long").collect())
    return [(*r, base) for r, base in zip(rows, accumulate((n for _, _, n in rows), initial=0), strict=False)]


class _Numbers:
    """A file's numbers: memory-mapped where the store is a mounted one, else read range by range."""

    def __init__(self, uri: str, name: str, dtype: str):
        store, folder = _place(uri)
        self.dtype, path = np.dtype(dtype), f"{folder}/{name}"
        self.size = store.get_file_info(path).size // self.dtype.itemsize
        self.whole = np.memmap(path, dtype, "r") if self.size and _mounted(store) else None
        self.file = None if self.whole is not None else store.open_input_file(path)

    def between(self, a: int, b: int) -> np.ndarray:
        if self.whole is not None:
            return self.whole[a:b]
        b = min(b, self.size)
        return np.frombuffer(self.file.read_at((b - a) * self.dtype.itemsize, a * self.dtype.itemsize), self.dtype)


def _mounted(store: fs.FileSystem) -> bool:
    return isinstance(store, fs.LocalFileSystem)


def read_token_files(spark: SparkSession, uri: str, manifest: list[tuple[int, int, int, int]], dtype: str = "<u2", block_tokens: int = 1 << 20, block_docs: int = 1 << 16) -> DataFrame:
    """One row for each document: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, offsets, docs = (_Numbers(uri, f"part-{number:06d}.{kind}", t) for kind, t in (("ids", dtype), ("offsets", "<u8"), ("docs", "<i8")))
                for low in range(0, docs.size, block_docs):
                    keys, at = docs.between(low, low + block_docs), offsets.between(low, low + block_docs + 1).astype(np.int64)
                    i = 0
                    while i < len(keys):
                        j = max(i + 1, int(np.searchsorted(at, at[i] + block_tokens, "right")) - 1)
                        flat = ids.between(at[i], at[j]).astype("<u4")
                        cut = (at[i : j + 1] - at[i]).tolist()
                        key = keys[i:j]
                        yield as_batch({"doc_id": pa.array(key, mask=key == _NO_ID), "start": base + at[i:j], "n_tokens": np.diff(at[i : j + 1]), "ids": [flat[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]}, _OUT)
                        i = j

    rows = spark.createDataFrame([(number, base) for number, _, _, base in manifest], "file_no long, base long")
    return rows.repartition(max(1, len(manifest)), "file_no").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
