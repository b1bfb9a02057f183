"""MinHash fingerprints of word shingles, neighbours in doc_id order, and near duplicates by signature bands.

A fingerprint is the least value of each of PERMUTATIONS universal hash permutations over a text's SHINGLE-word shingles
(fewer words make one shingle), 16 bits of each, in hex. A text without words has the fingerprint of all ones. Equal texts
have equal fingerprints; the share of equal components estimates the Jaccard similarity of the shingle sets.

Null text counts as empty. Rows are ordered by doc_id, then text; a null doc_id comes last. Repeated rows are documents of
their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .encoding import as_batch
from .ngram_join import Similarity, gram_sets, link_sets, named_sets, prefixes, sent_frequencies, set_names, with_components
from .textops import by_bytes, gram_starts, hash_spans, lower_ascii, mix, ngram_hashes, ranges, signed, text_bytes, word_spans

SHINGLE, PERMUTATIONS = 5, 256
_random = np.random.default_rng(97)
_A = _random.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_LEAST = -(1 << 63)


def signatures(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """16-bit components, one row for each document."""
    starts, ends, first = word_spans(buf, at)
    words = hash_spans(buf, starts, ends)
    count = np.diff(first)
    grams = ngram_hashes(words, SHINGLE)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    size = np.maximum(count - SHINGLE + 1, (count > 0).astype(np.int64))
    values = np.zeros(int(size.sum()), np.uint64)
    begin = np.cumsum(size) - size
    at_gram = gram_starts(first, SHINGLE)
    values[ranges(begin, np.where(count >= SHINGLE, size, 0))] = grams[at_gram]
    for d in short.tolist():
        values[begin[d]] = mix(ngram_hashes(words[first[d] : first[d + 1]], int(count[d])) + np.uint64(count[d]))[0]
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(count), PERMUTATIONS), 0xFFFF, np.uint16)
    some = np.flatnonzero(size)
    if len(some):
        bounds, held = begin[some], np.empty_like(x)
        for k in range(PERMUTATIONS):
            np.multiply(x, _A[k], out=held)
            np.add(held, _B[k], out=held)
            least = np.minimum.reduceat(held, bounds)
            out[some, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def in_hex(signature: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in signature.astype(">u2")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint for each row of docs(doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            yield as_batch({"doc_id": batch.column(0), "fingerprint": in_hex(signatures(*text_bytes(batch.column(1))))}, schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """docs(doc_id, text), sorted by descending doc_id within buckets (bucket, last, doc_id, text), each closed by a copy (last = 1) of
    the document after its last one; after the least document comes the greatest.

    Bucket bounds are approximate quantiles, so each text is shuffled once, and no bucket grows with the table.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(_LEAST)).alias("id"))
    # the least id of each bucket but the lowest; at most `buckets` numbers
    cuts = sorted(set(ids.agg(F.percentile_approx("id", [k / buckets for k in range(1, buckets)] or [0.5], 10_000)).first()[0] or []))
    bounds = np.array(cuts, np.int64)

    def number(batches: Iterator[pa.RecordBatch], follow: dict[int, tuple[int, int]] | None = None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).fill_null(_LEAST)
            bucket = np.searchsorted(bounds, key.to_numpy(), "right").astype(np.int64)
            if follow is None:
                yield pa.RecordBatch.from_arrays([key, pa.array(bucket)], ["id", "bucket"])
                continue
            own = [pa.array(bucket), pa.array(np.zeros(len(bucket), np.int32)), *batch.columns]
            yield pa.RecordBatch.from_arrays(own, ["bucket", "last", "doc_id", "text"])
            heads = np.flatnonzero(key.to_numpy() == np.array([follow[b][0] for b in bucket.tolist()], np.int64))
            if len(heads):
                part = batch.take(pa.array(heads))
                to = np.array([follow[b][1] for b in bucket[heads].tolist()], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(np.ones(len(to), np.int32)), *part.columns], ["bucket", "last", "doc_id", "text"])

    top = ids.mapInArrow(number, "id long, bucket long").groupBy("bucket").agg(F.max("id").alias("id"))
    tops = sorted(tuple(r) for r in top.collect())  # at most `buckets` rows
    # a bucket's greatest document follows the last one of the bucket above
    follow = {b: (head, tops[(k + 1) % len(tops)][0]) for k, (b, head) in enumerate(tops)}
    rows = docs.select("doc_id", "text").mapInArrow(lambda batches: number(batches, follow), "bucket long, last int, doc_id long, text string")
    rows = rows.repartition(F.col("bucket"))
    return rows.sortWithinPartitions("bucket", "last", F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last())


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _edited(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of each document, and the edited texts of all but the last: the latter half is replaced by the start of the next."""
    head = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    place = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))  # byte of each code point
    chars = np.diff(head[at])
    half = chars[:-1] // 2
    keep = place[head[at[:-2]] + chars[:-1] - half] - at[:-2]
    taken = place[head[at[1:-1]] + np.minimum(half, chars[1:])] - at[1:-1]
    begins = np.stack([at[:-2], at[1:-1]], 1).ravel()
    lengths = np.stack([keep, taken], 1).ravel()
    return chars, buf[ranges(begins, lengths)], np.concatenate([[0], np.cumsum(keep + taken)])


def edit_report(docs: DataFrame, buckets: int) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness."""

    def report(rows: pa.RecordBatch, after: pa.RecordBatch) -> pa.RecordBatch:
        """after: the row that follows."""
        buf, at = text_bytes(pa.concat_arrays([rows.column(3), after.column(3)]))
        own = signatures(buf, at)
        chars, text, cut = _edited(buf, at)
        edited, data, c = signatures(text, cut), text.tobytes(), cut.tolist()
        return as_batch(
            {
                "doc_id": rows.column(2),
                "n_chars": chars[:-1],
                "edited_sha256": [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(c, c[1:], strict=False)],
                "fingerprint": in_hex(own[:-1]),
                "edited_fingerprint": in_hex(edited),
                "near_edited": likeness(own[:-1], edited),
                "near_next": likeness(own[:-1], own[1:]),
            },
            _OUT,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row, which waits for the next one
        for batch in by_bytes(batches):
            rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()[0]
            bucket, last = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            edge = np.flatnonzero(np.diff(bucket)) + 1
            held = None
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(bucket)], strict=True):
                closed = np.flatnonzero(last[a:b])
                end = a + int(closed[0]) if len(closed) else b - 1  # the row that only follows
                if end > a:
                    yield report(rows.slice(a, end - a), rows.slice(end, 1))
                if b == len(bucket):
                    held = rows.slice(end, 1)

    return with_next(docs, buckets).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def near_duplicates(docs: DataFrame, percent: int = 80, bands: int = 32) -> DataFrame:
    """doc_id, n_shingles, component_id: documents whose signatures (of words with A-Z folded) share a band are joined in Spark, and
    their shingle sets' Jaccard similarity is verified once for each pair. Candidates are found with the probability that `bands`
    gives; what is found is exact.
    """
    how = Similarity(SHINGLE, percent)
    rows, schema = PERMUTATIONS // bands, pa.schema([("id", pa.int64()), ("low", pa.int64()), ("token", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            buf, at = text_bytes(batch.column(1))
            sig = signatures(lower_ascii(buf), at).astype(np.uint64)
            key = np.zeros((len(sig), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
            for k in range(rows):
                key = mix(key + sig[:, k::rows][:, :bands] * np.uint64(0x9E3779B97F4A7C15))
            low = set_names(gram_sets(batch.column(1), SHINGLE))
            yield as_batch({"id": batch.column(0), "low": signed(low), "token": list(key.view(np.int64))}, schema)

    docs = docs.select("doc_id", "text")
    sent = sent_frequencies(docs, how)
    sets = materialize(prefixes(docs, how, sent).drop("prefix").withColumn("row", F.monotonically_increasing_id()), "sets")
    named, ones = named_sets(sets)
    # a band says nothing of places in a set: positions that every filter lets pass
    keys = docs.mapInArrow(run, "id long, low long, token array<long>").dropDuplicates(["id", "low"]).join(ones.select("row", "id", "low", "n"), ["id", "low"])
    tokens = keys.select("row", "n", F.lit(0).alias("pos"), F.explode("token").alias("token"))
    return with_components(sets, named, link_sets(tokens, docs, ones, how, sent)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
