"""A class-based bigram language model: Brown's exchange clustering, class transitions and word emissions.

P(text) is the product over its words and the end of P(class | class before) * P(word | class).

* All words of the training texts are counted in Spark. The CLUSTERED most frequent ones are assigned to CLASSES classes by
  exchange: each word in turn moves to the class that makes the class bigrams likeliest, until a round moves few words. That
  needs the bigrams among them only, at most CLUSTERED squared numbers.
* All other words that occur ENOUGH times take the class that makes their neighbours' classes likeliest: for the next EXTENDED
  words from counts in the driver, for those after them from counts grouped by word in Spark. Words that occur less often, unseen
  ones included, share one class, and the end of a text is a class of its own.
* Counts and classes of at most FREQUENT words are sent to all tasks; those of the others come by a join on the words, so nothing
  that is broadcast grows with the corpus. The rare words of a text are joined, not the frequent ones, so no key is hot.

Null text counts as empty: the end only. A null doc_id is a training row. Repeated rows count as often as they come and are
scored each on its own; without training rows all words are unseen ones. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, release
from .encoding import as_batch
from .textops import by_bytes, hash_spans, lower_ascii, ranges, signed, text_bytes, unsigned, word_spans

CLASSES, CLUSTERED, EXTENDED, FREQUENT = 64, 1024, 8192, 1 << 19
ENOUGH = 5
PRIOR_TYPES = 0.1
_PRIOR_MOVES = 5.0
_CHUNK_TOKENS = 1 << 22
#: The end of a text.
END = np.uint64(0x5851F42D4C957F2D)


def held_out(doc_id: str = "doc_id", folds: int = 10):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each followed by END, and each text's first token (one more at the end)."""
    buf, at = text_bytes(column)
    starts, ends, first = word_spans(buf, at)
    words = hash_spans(lower_ascii(buf), starts, ends)
    new = first + np.arange(len(first))
    out = np.full(len(words) + len(column), END, np.uint64)
    out[ranges(new[:-1], np.diff(first))] = words
    return out, new


def _tallied(texts: DataFrame, keys: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """key, n: how often keys(tokens, first) gives each number, over all texts."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in by_bytes(batches):
            held.append(keys(*tokens(batch.column(0))))
            size += len(held[-1])
            if size >= _CHUNK_TOKENS:
                yield tally(held)
                held, size = [], 0
        if held:
            yield tally(held)

    def tally(held: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(held), return_counts=True)
        return as_batch({"key": key.view(np.int64), "n": n}, schema)

    return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def numbered(words: np.ndarray, known: np.ndarray, number: np.ndarray, other: int) -> np.ndarray:
    """The number of each word that is in known (sorted), else other."""
    if not len(known):
        return np.full(len(words), other)
    place = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[place] == words, number[place], other)


def before(x: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """The value before each token; start at the first one of a text."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first[:-1]] = start
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, fixed: int, classes: int, rounds: int = 12) -> np.ndarray:
    """Classes of words by exchange clustering. bigrams[i, j]: word i is followed by word j.

    The last `fixed` words keep classes of their own, which come after the others.
    """
    size = len(bigrams)
    free = size - fixed
    of = np.concatenate([np.arange(free) % classes, classes + np.arange(fixed)])
    k = classes + fixed
    out_of, into = np.zeros((size, k)), np.zeros((k, size))
    np.add.at(out_of.T, of, bigrams.T)
    np.add.at(into, of, bigrams)
    pairs = np.zeros((k, k))
    np.add.at(pairs, of, out_of)
    total = pairs.sum(axis=1)
    for _ in range(rounds):
        moved = 0
        for w in range(free):
            r, s, own, n, a = out_of[w].copy(), into[:, w].copy(), bigrams[w, w], out_of[w].sum(), of[w]
            if not n:
                continue
            # without w: its row and column leave class a
            pairs[a] -= r
            pairs[:, a] -= s
            pairs[a, a] += own
            total[a] -= n
            r[a] -= own
            s[a] -= own
            p = pairs[:classes]
            gain = (_xlogx(p + r) - _xlogx(p)).sum(axis=1)
            q = pairs[:, :classes]
            gain += (_xlogx(q + s[:, None]) - _xlogx(q)).sum(axis=0)
            d, i = np.diagonal(pairs)[:classes], np.arange(classes)
            gain += _xlogx(d + r[i] + s[i] + own) - _xlogx(d + r[i]) - _xlogx(d + s[i]) + _xlogx(d)
            gain -= 2 * (_xlogx(total[:classes] + n) - _xlogx(total[:classes]))
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            pairs[b] += r
            pairs[:, b] += s
            pairs[b, b] += own
            total[b] += n
            if b != a:
                moved += 1
                of[w] = b
                row, column = bigrams[w], bigrams[:, w]
                into[a] -= row
                into[b] += row
                out_of[:, a] -= column
                out_of[:, b] += column
        if moved <= size // 200:
            break
    return of


@dataclass
class Model:
    """words: the frequent ones' hashes, sorted; their counts and classes. Class numbers: 0 .. CLASSES - 1, then the end, then the rest."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    n_tokens: int
    n_types: int
    log_moves: np.ndarray
    log_mass: np.ndarray

    @property
    def rest(self) -> int:
        return CLASSES + 1


def _most_frequent(counts: DataFrame, most: int) -> list[np.ndarray]:
    """Hashes, counts and further columns of at most so many words, most frequent first: all those above some count."""
    step = F.floor(F.log("n") * 64).alias("step")  # a few thousand steps at any size
    sizes = {r.step: r.words for r in counts.groupBy(step).agg(F.count("*").alias("words")).collect()}
    least, have = 1 << 62, 0
    for n in sorted(sizes, reverse=True):
        if (have := have + sizes[n]) > most:
            break
        least = n
    rows = counts.where(step >= least).toArrow()
    word, *rest = (c.to_numpy() for c in rows.columns)
    word = unsigned(word)
    order = np.lexsort((word, -rest[0]))
    return [c[order] for c in (word, *rest)]


def _classed(texts: DataFrame, known: np.ndarray, rank: np.ndarray, group: np.ndarray, value: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """key, class of each word beside the known ones (sorted, with ranks, and the class of each rank) that occurs ENOUGH times.

    value: of each class for words with these counts of the classes before and after them.
    """
    groups, buckets = CLASSES + 2, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = texts.sparkSession.sparkContext.broadcast((known, rank, group))
    dealt, classed = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("codes", pa.binary())]), pa.schema([("key", pa.int64()), ("class", pa.int32())])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in by_bytes(batches):
            words, first = tokens(batch.column(0))
            known, rank, group = sent.value
            x = numbered(words, known, rank, len(group))
            c = np.append(group, CLASSES + 1)[x]
            own = np.flatnonzero(x == len(group))
            held.append((words[own], (before(c, first, CLASSES)[own] * groups + np.append(c[1:], CLASSES)[own]).astype(np.uint16)))
            size += len(own)
            if size >= _CHUNK_TOKENS // 4:
                yield deal(held)
                held, size = [], 0
        if size:
            yield deal(held)

    def deal(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, codes = (np.concatenate(x) for x in zip(*held, strict=True))
        bucket = (keys % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keys, codes = keys[order], codes[order]
        names, cut = np.unique(bucket[order], return_index=True)
        parts = list(zip(cut.tolist(), [*cut[1:].tolist(), len(keys)], strict=True))
        return as_batch({"bucket": names, "keys": [keys[a:b].tobytes() for a, b in parts], "codes": [codes[a:b].tobytes() for a, b in parts]}, dealt)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b"".join(batch.column(1).to_pylist()), b"".join(batch.column(2).to_pylist())) for batch in batches]
        keys, codes = np.frombuffer(b"".join(k for k, _ in held), np.uint64), np.frombuffer(b"".join(c for _, c in held), np.uint16)
        order = np.argsort(keys)
        keys, codes = keys[order], codes[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(keys)))
        first, n = first[n >= ENOUGH], n[n >= ENOUGH]
        for a in range(0, len(first), 4096):
            f, m = first[a : a + 4096], n[a : a + 4096]
            code, row = codes[ranges(f, m)], np.repeat(np.arange(len(f)), m) * groups
            left, right = (np.bincount(row + c, minlength=len(f) * groups).reshape(-1, groups) for c in (code // groups, code % groups))
            yield as_batch({"key": signed(keys[f]), "class": value(left, right).argmax(axis=1).astype(np.int32)}, classed)

    rows = texts.select("text").mapInArrow(around, "bucket int, keys binary, codes binary").repartition(buckets, "bucket")
    return rows.mapInArrow(assign, "key long, class int")


_PLACED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("own", pa.float64()), ("seq", pa.binary()), ("rare", pa.list_(pa.int64()))])
_LATER = 255


def _placed(docs: DataFrame, words: np.ndarray, counts: np.ndarray, classes: np.ndarray, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each text's classes, a byte each (_LATER: of a word in rare, in order), and found: key, n and class of those words that are in the table.

    Also the written table that this reads. words (sorted) are sent to all tasks, with their counts and classes.
    """
    sent = docs.sparkSession.sparkContext.broadcast((words, np.log10(counts + PRIOR_TYPES), classes.astype(np.uint8)))  # at most FREQUENT words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, logs, classes = sent.value
        row = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches):
            words, first = tokens(batch.column(1))
            place = np.minimum(np.searchsorted(known_words, words), max(0, len(known_words) - 1))
            known = known_words[place] == words if len(known_words) else np.zeros(len(words), bool)
            c, own = np.full(len(words), _LATER, np.uint8), np.zeros(len(words))
            c[known], own[known] = classes[place[known]], logs[place[known]]
            rare = np.flatnonzero(~known)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, first).astype(np.int32)), pa.array(signed(words[rare])))
            seq = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(first.astype(np.int32).tobytes()), pa.py_buffer(c.tobytes())])
            sums = [np.add.reduceat(x, first[:-1]) for x in (known.astype(np.int64), own)]
            yield as_batch({"row": np.arange(row, row + batch.num_rows), "doc_id": batch.column(0), "n_tokens": np.diff(first), "n_known": sums[0], "own": sums[1], "seq": seq, "rare": lists}, _PLACED)
            row += batch.num_rows

    rows = docs.select("doc_id", "text").mapInArrow(run, "row long, doc_id long, n_tokens long, n_known long, own double, seq binary, rare array<long>")
    rows = materialize(rows, "placed")
    keys = rows.select("row", F.explode(F.array_distinct("rare")).alias("key"))
    found = keys.join(table, "key").groupBy("row").agg(F.collect_list(F.struct("key", "n", "class")).alias("found"))
    return rows.join(found, "row", "left").drop("row"), rows


def _filled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all tokens of a batch of _placed(), each text's first token, and the place and count of each looked up one."""
    first = np.concatenate([[0], np.cumsum(batch.column("n_tokens").to_numpy())])
    c = np.frombuffer(b"".join(batch.column("seq").to_pylist()), np.uint8).astype(np.int64)
    at = np.flatnonzero(c == _LATER)
    n = np.zeros(len(at), np.int64)
    c[at] = CLASSES + 1
    key, times, group = (x.to_numpy(zero_copy_only=False) for x in batch.column("found").flatten().flatten())
    if len(key) and len(at):
        rare = batch.column("rare").flatten().to_numpy()
        key, one = np.unique(key, return_index=True)
        place = np.minimum(np.searchsorted(key, rare), len(key) - 1)
        same = key[place] == rare
        n[same], c[at[same]] = times[one][place[same]], group[one][place[same]]
    return c, first, at, n


def train(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the counts and classes of all words (key: hash, n, class) in a written table."""
    sc = texts.sparkSession.sparkContext
    counts = materialize(_tallied(texts, lambda words, first: words), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words, n = _most_frequent(counts, FREQUENT)
    inner = words != END
    ranked = words[inner]

    def table(k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k most frequent words, sorted, with their ranks; END has rank k."""
        known = np.append(ranked[:k], END)
        order = np.argsort(known)
        return known[order], order

    k = min(CLUSTERED, len(ranked))
    sent = sc.broadcast(table(k))
    side = k + 2  # the words, the end, all others

    def bigram(words: np.ndarray, first: np.ndarray) -> np.ndarray:
        x = numbered(words, *sent.value, k + 1)
        return before(x, first, k) * side + x

    bigrams = np.zeros(side * side)
    rows = _tallied(texts, bigram).toArrow()  # at most (CLUSTERED + 2) squared numbers
    bigrams[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    bigrams = bigrams.reshape(side, side)
    of = exchange(bigrams, 2, CLASSES)
    groups = CLASSES + 2
    pairs = np.zeros((groups, groups))
    np.add.at(pairs, (of[:, None], of[None, :]), bigrams)

    more = ranked[k : k + EXTENDED]
    m = len(more)
    wide = sc.broadcast((*table(k + m), np.concatenate([of[:k], np.full(m, CLASSES + 1), [CLASSES]])))

    def neighbours(words: np.ndarray, first: np.ndarray) -> np.ndarray:
        known, rank, group = wide.value
        x = numbered(words, known, rank, k + m + 1)
        c = np.append(group, CLASSES + 1)[x]
        left = before(c, first, CLASSES)
        right = np.append(c[1:], CLASSES)
        own = np.flatnonzero((x >= k) & (x < k + m))
        return np.concatenate([((x[own] - k) * 2 + s) * groups + y[own] for s, y in ((0, left), (1, right))])

    near = np.zeros(m * 2 * groups)
    if m:
        rows = _tallied(texts, neighbours).toArrow()  # at most 2 * EXTENDED * (CLASSES + 2) numbers
        near[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    near = near.reshape(m, 2, groups)
    onward = np.log((pairs + 0.5) / (pairs.sum(axis=1, keepdims=True) + 0.5 * groups))
    mass = np.log(pairs.sum(axis=0) + 1)

    def value(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return right @ onward.T[:, :CLASSES] + left @ onward[:, :CLASSES] - left.sum(axis=1, keepdims=True) * mass[:CLASSES]

    group = np.concatenate([of[:k], value(near[:, 0], near[:, 1]).argmax(axis=1) if m else np.zeros(0, np.int64), [CLASSES]])
    top = texts.sparkSession.createDataFrame(pa.table({"key": signed(np.append(ranked[: k + m], END)), "class": group.astype(np.int32)}))
    classed = top.unionByName(_classed(texts, *table(k + m), group, value))
    written = materialize(counts.join(classed, "key", "left").select("key", "n", F.coalesce("class", F.lit(CLASSES + 1)).alias("class")), "words")
    words, n, classes = _most_frequent(written, FREQUENT)
    order = np.argsort(words)
    words, n, classes = words[order], n[order], classes[order]

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(groups * groups, np.int64)
        for batch in batches:
            c, first, _, _ = _filled(batch)
            if len(c):
                seen += np.bincount(before(c, first, CLASSES) * groups + c, minlength=groups * groups)
        yield as_batch({"key": np.flatnonzero(seen), "n": seen[seen > 0]}, pa.schema([("key", pa.int64()), ("n", pa.int64())]))

    flat = np.zeros(groups * groups)
    placed, read = _placed(texts.select(F.lit(0).cast("long").alias("doc_id"), "text"), words, n, classes, written.where(F.col("class") <= CLASSES))
    rows = placed.mapInArrow(moves, "key long, n long").groupBy("key").agg(F.sum("n")).toArrow()
    flat[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    release(read, counts)
    flat = flat.reshape(groups, groups)
    share = (flat.sum(axis=0) + 1) / (flat.sum() + groups)
    log_moves = np.log10((flat + _PRIOR_MOVES * share) / (flat.sum(axis=1, keepdims=True) + _PRIOR_MOVES))
    in_class, types = np.zeros(groups), np.zeros(groups)
    for r in written.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        in_class[r["class"]], types[r["class"]] = r.n, r.types
    types[-1] += 1  # for all unseen words
    return Model(words, n, classes, total[0], total[1], log_moves, np.log10(np.maximum(in_class + PRIOR_TYPES * types, 1e-9))), written


_SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score (unigrams), score (the model's log10 probability), perplexity for each row of docs(doc_id, text)."""
    placed, _ = _placed(docs, model.words, model.counts, model.classes, counts)
    all_mass = np.log10(model.n_tokens + PRIOR_TYPES * (model.n_types + 1))
    log_moves, log_mass = model.log_moves, model.log_mass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            c, first, at, n = _filled(batch)
            row = np.searchsorted(first, at, side="right") - 1
            own = batch.column("own").to_numpy() + np.bincount(row, np.log10(n + PRIOR_TYPES), batch.num_rows)
            known = batch.column("n_known").to_numpy() + np.bincount(row, n > 0, batch.num_rows).astype(np.int64)
            full = own + np.add.reduceat(log_moves[before(c, first, CLASSES), c] - log_mass[c], first[:-1])
            size = batch.column("n_tokens")
            yield as_batch({"doc_id": batch.column("doc_id"), "n_tokens": size, "n_known": known, "base_score": own - size.to_numpy() * all_mass, "score": full}, _SCORED)

    out = placed.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
