"""Removal of passages that repeat across documents, by repeated-phrase automata.

A window is ``window`` consecutive words of a document. A word is removed if a window over it also starts in a document with a
smaller doc_id; windows are judged on the input.

1. Candidates. Every window picks its least n-gram of ANCHOR words (its anchor), so equal windows have equal anchors. Windows whose
   anchor only one document has are ruled out.
2. Passages. The first document with an anchor owns its windows that pick it: no smaller document can have them. Runs of such
   windows are passages.
3. Automata. Windows are dealt over shards by their anchor: anchors go with the first document that has them, so that alike
   passages meet, and the anchors of a document whose passages are everywhere are parted again. Each shard's passages, cut
   into tiles of half a window, are compiled into one Aho-Corasick automaton whose letters are words; every window of a
   passage holds a whole tile. A shard has about SHARD_WORDS words.
4. Location. Each other document is streamed through the automata of its anchors' shards. Where a tile occurs, the windows
   around it are looked up among the shard's. A shard that many documents need is copied, and they are dealt over the copies.
5. The rest. Windows with a shared anchor that its first document does not have go another round among themselves: they are
   counted by hash, those of at least two documents are confirmed and owned by the first of them, and located like the others.

Documents with a null or empty text, or fewer words than a window, lose nothing. Rows with a null doc_id neither own nor lose
anything; rows that share a doc_id are compared with smaller ids only, and spans found in any of them hold for that id. An
empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize, release
from .encoding import as_batch
from .textops import by_bytes, gram_starts, hash_spans, ngram_hashes, ranges, signed, text_bytes, unsigned, word_spans

ANCHOR = 10
SHARD_WORDS = 400_000
#: Words for each anchor, about; anchor occurrences for which a first document's anchors stay together; those that one copy streams.
_WORDS_AN_ANCHOR, _TOGETHER, _COPY = 20, 1 << 18, 1 << 17
_PLACE = np.uint64((1 << 24) - 1)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buf, at = text_bytes(column)
    starts, ends, first = word_spans(buf, at)
    return hash_spans(buf, starts, ends), first, buf, starts, ends


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def anchors(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the place of each one's anchor, and the hashes of all n-grams of ANCHOR words."""
    at = gram_starts(first, window)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    grams = ngram_hashes(words, ANCHOR)
    place = np.empty(len(at), np.int64)
    step = 1 << 23
    for low in range(0, len(grams), step):  # places are told apart within 2**24 words
        here = (at >= low) & (at < low + step)
        part = grams[low : low + step + window]
        keys = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        if here.any():
            place[here] = (_sliding_min(keys, window - ANCHOR + 1)[at[here] - low] & _PLACE).astype(np.int64) + low
    return at, place, grams


def _anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """anchor, doc_id: each anchor of each document once."""
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            words, first, *_ = _words(batch.column(1))
            _, place, grams = anchors(words, first, window)
            place = np.unique(place)
            doc = np.searchsorted(first, place, "right") - 1
            yield as_batch({"anchor": signed(grams[place]), "doc_id": batch.column(0).take(pa.array(doc))}, schema)

    return docs.mapInArrow(run, "anchor long, doc_id long")


def _known_anchors(anchor: np.ndarray, doc: np.ndarray, known: pa.Array) -> np.ndarray:
    """For each anchor of each document, its index in that document's list of known ones (flat), or -1. known: lists of structs."""
    cut, values = known.offsets.to_numpy(), unsigned(known.values.field("anchor").to_numpy(zero_copy_only=False))
    out = np.full(len(anchor), -1)
    bounds = np.searchsorted(doc, np.arange(len(known) + 1))
    for d in np.unique(doc).tolist():
        mine = values[cut[d] : cut[d + 1]]
        order = np.argsort(mine)
        x = anchor[bounds[d] : bounds[d + 1]]
        place = order[np.minimum(np.searchsorted(mine, x, sorter=order), len(mine) - 1)]
        out[bounds[d] : bounds[d + 1]] = np.where(mine[place] == x, place + cut[d], -1)
    return out


def _window_rows(candidates: DataFrame, window: int) -> DataFrame:
    schema = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            words, first, *_ = _words(batch.column(2))
            at, place, grams = anchors(words, first, window)
            chosen, which = np.unique(place, return_inverse=True)
            good = _known_anchors(grams[chosen], np.searchsorted(first, chosen, "right") - 1, batch.column(3)) >= 0
            hashes, at = ngram_hashes(words, window), at[good[which]]
            doc = np.searchsorted(first, at, "right") - 1
            yield as_batch({"hash": signed(hashes[at]), "doc_id": batch.column(0).take(pa.array(doc))}, schema)

    return candidates.mapInArrow(run, "hash long, doc_id long")


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    if not len(x):
        return x, x
    new = np.flatnonzero(np.diff(x) != 1) + 1
    return x[np.concatenate([[0], new])], x[np.concatenate([new - 1, [len(x) - 1]])]


def _passages(candidates: DataFrame, window: int) -> DataFrame:
    """owner, shard, copies, text of passages: runs of windows in one shard that their document owns.

    candidates: doc_id, start, text, anchors and, where counts have said it, hashes of the windows that it owns; else it owns
    those whose anchor it has first.
    """
    schema = pa.schema([("owner", pa.int64()), ("shard", pa.int64()), ("copies", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            words, first, buf, starts, ends = _words(batch.column(2))
            at, place, grams = anchors(words, first, window)
            hashes, data = ngram_hashes(words, window), buf.tobytes()
            chosen, which = np.unique(place, return_inverse=True)
            known = _known_anchors(grams[chosen], np.searchsorted(first, chosen, "right") - 1, batch.column(3))[which]
            values = batch.column(3).values
            shard, copies, own = (values.field(f).to_numpy(zero_copy_only=False) for f in ("shard", "copies", "own"))
            out: dict[str, list] = {f.name: [] for f in schema}
            for d, owner in enumerate(batch.column(0).to_pylist()):
                k = slice(*np.searchsorted(at, [first[d], first[d + 1]]))
                if batch.num_columns > 4:
                    mine = np.isin(hashes[at[k]], unsigned(batch.column(4)[d].values.to_numpy(zero_copy_only=False))) & (known[k] >= 0)
                else:
                    mine = (known[k] >= 0) & own[known[k]]
                mine = np.flatnonzero(mine) + k.start
                for s in np.unique(shard[known[mine]]).tolist():
                    here = mine[shard[known[mine]] == s]
                    low, high = _runs(at[here])
                    for a, b in zip(low.tolist(), high.tolist(), strict=True):
                        out["owner"].append(owner)
                        out["shard"].append(s)
                        out["copies"].append(int(copies[known[here[0]]]))
                        out["text"].append(data[starts[a] : ends[b + window - 1]].decode())
            yield as_batch(out, schema)

    return candidates.mapInArrow(run, "owner long, shard long, copies long, text string")


class PhraseAutomaton:
    """The passages of a shard as an Aho-Corasick automaton over words, with the owner of each of their windows."""

    def __init__(self, owners: np.ndarray, texts: pa.Array, window: int):
        import ahocorasick

        self.window, self.tile = window, window // 2
        words, first, *_ = _words(texts)
        at, place, grams = anchors(words, first, window)
        self.anchors = np.unique(grams[place])
        hashes, owner = ngram_hashes(words, window)[at], owners[np.searchsorted(first, at, "right") - 1]
        order = np.lexsort((owner, hashes))
        self.hashes, self.owners = hashes[order], owner[order]
        letters = self.letters(words)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            for k in range(a, b - self.tile + 1, self.tile):
                self.automaton.add_word(letters[k : k + self.tile])
        self.automaton.make_automaton()

    @staticmethod
    def letters(words: np.ndarray) -> str:
        """One character for each word; that different words may share one costs time only, as windows are looked up whole."""
        return (words % np.uint64(0xF0000) + np.uint64(0x10000)).astype("<u4").tobytes().decode("utf-32-le")

    def covered(self, doc_ids: np.ndarray, starts: np.ndarray, texts: pa.Array) -> tuple[list[list[tuple[int, int]]], list[list[tuple[int, str]]]]:
        """For each document (from word start on), the word spans covered by windows that a smaller doc_id owns, and the stretches
        (first word, text) of windows with an anchor of the shard that the shard does not have."""
        words, first, buf, word_starts, word_ends = _words(texts)
        hashes, letters, data = ngram_hashes(words, self.window), self.letters(words), buf.tobytes()
        windows, place, grams = anchors(words, first, self.window)
        shared = np.isin(grams[place], self.anchors)
        spans, rest = [], []
        for d, begin, a, b in zip(doc_ids.tolist(), starts.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
            ends = np.array([e for e, _ in self.automaton.iter(letters[a:b])], np.int64) + a + 1
            near = np.zeros(b - a + 2, np.int64)  # windows that hold a tile: from tile end - window to tile start
            np.add.at(near, np.maximum(ends - self.window, a) - a, 1)
            np.add.at(near, ends - self.tile - a + 1, -1)
            at = np.flatnonzero(np.cumsum(near)[: max(0, b - a - self.window + 1)]) + a
            slot = np.searchsorted(self.hashes, hashes[at])
            found = slot < len(self.hashes)
            found[found] = self.hashes[slot[found]] == hashes[at[found]]
            known = at[found]
            low, high = _runs(known[self.owners[slot[found]] < d] - a + begin)
            spans.append(merged(list(zip(low.tolist(), (high + self.window).tolist(), strict=True))))
            k = slice(*np.searchsorted(windows, [a, b]))
            low, high = _runs(np.setdiff1d(windows[k][shared[k]], known, assume_unique=True))
            rest.append([(x - a + begin, data[word_starts[x] : word_ends[y + self.window - 1]].decode()) for x, y in zip(low.tolist(), high.tolist(), strict=True)])
        return spans, rest


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _locate(passages: DataFrame, candidates: DataFrame, window: int, rest: bool) -> DataFrame:
    """doc_id, spans, rest (stretches of windows that no passage has) of documents that have any; a document comes once for each shard."""
    named = passages.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), F.col("owner").alias("doc_id"), F.lit(0).cast("long").alias("start"), "text")
    others = F.filter("anchors", lambda a: ~a["own"])
    places = F.array_distinct(F.transform(others, lambda a: F.struct(a["shard"].alias("shard"), a["copies"].alias("copies"))))
    texts = candidates.select("doc_id", "start", "text", F.inline(places)).select("shard", F.pmod(F.xxhash64("doc_id"), "copies").alias("copy"), F.lit(1).alias("kind"), "doc_id", "start", "text")
    rows = named.unionByName(texts).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind", "doc_id")
    stretch = pa.list_(pa.struct([("start", pa.int64()), ("text", pa.string())]))
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("rest", stretch)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, automaton = None, None
        for batch in by_bytes(batches):
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
            edge = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edge, edge[1:], strict=False):
                part, (shard, copy, kind) = batch.slice(a, b - a), key[:, a].tolist()
                if (shard, copy) != now:
                    now, held, automaton = (shard, copy), [], None
                if kind == 0:
                    held.append(part)
                    continue
                if automaton is None and held:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    automaton, held = PhraseAutomaton(whole.column(3).to_numpy(), whole.column(5), window), []
                if automaton:
                    spans, more = automaton.covered(part.column(3).to_numpy(), part.column(4).to_numpy(), part.column(5))
                    some = [k for k in range(part.num_rows) if spans[k] or rest and more[k]]
                    yield as_batch({"doc_id": part.column(3).take(pa.array(some, pa.int64())), "spans": [[{"a": x, "b": y} for x, y in spans[k]] for k in some], "rest": [[{"start": x, "text": t} for x, t in more[k]] if rest else [] for k in some]}, schema)

    return rows.mapInArrow(run, "doc_id long, spans array<struct<a: long, b: long>>, rest array<struct<start: long, text: string>>")


def _candidates(texts: DataFrame, window: int) -> DataFrame:
    """doc_id, start, text, anchors of the texts (doc_id, start, text) that share anchors with other documents."""
    pairs = materialize(_anchor_rows(texts.select("doc_id", "text"), window), "anchors")
    shared = materialize(_placed(pairs), "shared")
    each = F.struct("anchor", "shard", "copies", (F.col("doc_id") == F.col("first")).alias("own"))
    known = pairs.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set(each).alias("anchors"))  # bounded by the document
    out = materialize(texts.join(known, "doc_id").select("doc_id", "start", "text", "anchors"), "candidates")
    release(pairs, shared)
    return out


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, spans: the word spans [a, b) of docs(doc_id, text) that are covered by windows of smaller doc_ids, for documents that have any."""
    texts = docs.where("doc_id is not null").select("doc_id", F.lit(0).cast("long").alias("start"), "text")
    candidates = _candidates(texts, window)
    found = materialize(_locate(_passages(candidates, window), candidates, window, rest=True), "spans")
    release(candidates)
    candidates = _candidates(found.select("doc_id", F.inline("rest")), window)
    recurring = _window_rows(candidates, window).groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("y")).where("doc_id < y")
    owned = recurring.groupBy("doc_id").agg(F.collect_list("hash").alias("hashes"))  # bounded by the document
    passages = materialize(_passages(candidates.join(owned, "doc_id").select("doc_id", "start", "text", "anchors", "hashes"), window), "passages")
    everyone = candidates.withColumn("anchors", F.transform("anchors", lambda a: a.withField("own", F.lit(False))))
    more = materialize(_locate(passages, everyone, window, rest=False), "spans")
    release(candidates, passages)
    spans = found.where(F.size("spans") > 0).select("doc_id", "spans").unionByName(more.select("doc_id", "spans"))
    return spans.groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _placed(pairs: DataFrame) -> DataFrame:
    """anchor, first (document), shard, copies of the anchors that at least two documents have."""
    shared = pairs.groupBy("anchor").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("times")).where("first < last")
    shared = materialize(shared.drop("last"), "shared")
    shards = max(1, -(-shared.count() * _WORDS_AN_ANCHOR // SHARD_WORDS))
    parts = shared.groupBy("first").agg(F.floor(F.sum("times") / _TOGETHER + 1).alias("parts"))
    shard = F.pmod(F.xxhash64("first", F.pmod(F.xxhash64("anchor"), "parts")), F.lit(shards)).cast("long")
    dealt = shared.join(parts, "first").select("anchor", "first", "times", shard.alias("shard"))
    copies = dealt.groupBy("shard").agg(F.floor(F.sum("times") / _COPY + 1).cast("long").alias("copies"))
    return dealt.join(copies, "shard").select("anchor", "first", "shard", "copies")


def kept_words(text: str | None, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Words, removed words, and the kept ones joined by a space."""
    buf, at = text_bytes(pa.array([text], pa.string()))
    starts, ends, _ = word_spans(buf, at)
    keep = np.ones(len(starts), bool)
    for a, b in spans:
        keep[a:b] = False
    k = np.flatnonzero(keep)
    lengths = ends[k] - starts[k] + 1  # with the separator after each word, which becomes a space
    padded = np.append(buf, np.uint8(0x20))
    out = padded[ranges(starts[k], lengths)]
    out[np.cumsum(lengths) - 1] = 0x20
    return len(starts), len(starts) - len(k), out[:-1].tobytes().decode()


def remove_repeats(docs: DataFrame, window: int = 50, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The same rows and columns; texts with repeated passages become their kept words joined by a space, the others stay as they are."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    k_text, k_key = docs.columns.index(text), docs.columns.index(key)
    plain = docs.toDF(*names)
    spans = repeated_spans(plain.select(F.col(names[k_key]).alias("doc_id"), F.col(names[k_text]).alias("text")), window)
    joined = plain.join(spans.select(F.col("doc_id").alias("key"), "spans"), F.col(names[k_key]) == F.col("key"), "left").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, names[k_text]):
            columns = batch.columns[:-1]
            spans = batch.columns[-1].to_pylist()
            if any(spans):
                columns[k_text] = pa.array([kept_words(t, [(x["a"], x["b"]) for x in s])[2] if s else t for t, s in zip(columns[k_text].to_pylist(), spans, strict=True)], columns[k_text].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, T.StructType(list(plain.schema))).toDF(*docs.columns)


def removal_report(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by a space), for each row of docs(doc_id, text)."""
    docs = docs.select("doc_id", "text")
    joined = docs.join(repeated_spans(docs, window), "doc_id", "left")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            rows = [kept_words(t, [(x["a"], x["b"]) for x in s or ()]) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            n_words, n_removed, kept = zip(*rows, strict=True)
            yield as_batch({"doc_id": batch.column(0), "n_words": list(n_words), "n_removed": list(n_removed), "kept": list(kept)}, schema)

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
