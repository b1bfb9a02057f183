"""Set-similarity join of documents on word n-grams, and its components.

Documents become sets of n-gram hashes. By one order of all n-grams (rare first: those found in many documents of a chunk come
last, by their count; the others go by how rare their words are, then by hash) a set's prefix is so long that two sets of
enough Jaccard similarity share an n-gram in their prefixes. Sets are joined on prefix n-grams, and pairs go through

* the length filter: sizes must be close enough,
* the positional filter: what comes after a shared n-gram in both sets bounds their overlap,
* the suffix filter: bits tell for hash ranges whether a set has an odd number of n-grams there; ranges where two sets differ bound
  their overlap (with few ranges in the join, with more of them for its pairs),

before their whole sets are intersected, once for each pair. Equal sets count as one from the start, so groups of copies cost one
set.

A bucket (the sets that share a prefix n-gram) of more than DENSE sets is not turned into pairs. Such buckets become groups, those of
the same sets one group. A group has a core, n-grams that more than half of its sets have, and a set is seen as its residual:
what it has more or less than the core. Two sets differ in their residuals less twice what the residuals share. So

* sets whose residuals are small enough together are linked without a look: one edge to the set with the smallest residual, measured
  against its size, for each such set,
* all others must share residual n-grams, and the same prefix join runs on these: first what is not in the core, rare first, then what
  is; short residuals are compared at once.

Its dense buckets become groups again. After LEVELS such rounds what is still dense is enumerated in full: sets that are alike in
LEVELS ways and far from each other in others. So up to there a set is in at most DENSE pairs for each n-gram of its prefix.

Null and empty texts have an empty set and link with nothing. A doc_id with several texts stands for all of them; equal rows give
equal results. Rows with a null doc_id link with nothing and have no component. Further columns are ignored. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..storage import materialize, release
from .encoding import as_batch
from .textops import by_bytes, give_back, hash_spans, lower_ascii, mix, ngram_hashes, signed, text_bytes, unsigned, word_spans

#: Words of 64 bits of a set's parities, in the join of buckets and (WIDE) for its pairs; sets in a bucket that is turned into pairs; rounds by core and residual.
PARITY, WIDE, DENSE, LEVELS = 8, 64, 128, 4
#: Rows of a few numbers (and n-grams of cores) that are sent to all tasks at most; beyond, tables are joined by shuffling.
MAX_NAMED = 1 << 18
#: Most frequent n-grams and words that are broadcast; all others count as rare. It changes the speed, never the result.
MAX_FREQUENT, MAX_WORDS = 1 << 18, 1 << 16
#: An n-gram is counted as frequent if it is in so many documents of a chunk of so many n-grams.
_CHUNK_GRAMS, _CHUNK_DOCS = 1 << 21, 3
#: A word is counted if it is so often in a chunk; how rare it is, is kept in sixteenths of a bit.
_CHUNK_WORDS, _RAREST = 32, 20 * 16

_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("parity", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))])


@dataclass(frozen=True)
class Similarity:
    """Sets link if percent * union <= 100 * intersection; grams: words in an n-gram."""

    grams: int = 4
    percent: int = 85

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1 if n else 0

    def overlap(self, a: str, b: str):
        """The least intersection of two linked sets, from columns of their sizes."""
        return F.ceil(self.percent * (F.col(a) + F.col(b)) / (100 + self.percent) - 1e-9)

    def alike_in_size(self, a: str, b: str):
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)


@dataclass
class Frequencies:
    """Hashes (sorted) and document counts of frequent n-grams; hashes (sorted) and rareness of frequent words."""

    grams: np.ndarray
    counts: np.ndarray
    words: np.ndarray
    rareness: np.ndarray


def _looked_up(x: np.ndarray, known: np.ndarray, value: np.ndarray, other: int) -> np.ndarray:
    if not len(known):
        return np.full(len(x), other)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return np.where(known[at] == x, value[at], other)


def gram_sets(column: pa.Array, grams: int, seen: list[np.ndarray] | None = None, frequencies: Frequencies | None = None) -> list:
    """Each document's distinct n-gram hashes, sorted; fewer words make one n-gram. Hashes of words are added to seen.

    With frequencies: pairs of a set and its n-grams' places in the order of all n-grams (count, then rareness; equal ones by hash).
    """
    buf, at = text_bytes(column)
    starts, ends, first = word_spans(buf, at)
    words = hash_spans(lower_ascii(buf), starts, ends)
    if seen is not None:
        seen.append(words)
    whole = ngram_hashes(words, grams)
    if frequencies is not None:
        rare = np.concatenate([[0], np.cumsum(_looked_up(words, frequencies.words, frequencies.rareness, _RAREST))])
        order = (_looked_up(whole, frequencies.grams, frequencies.counts, 0) << 16) - (rare[grams:] - rare[:-grams])[: len(whole)] if len(whole) else np.zeros(0, np.int64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = b - a
        if n >= grams:
            s, one = np.unique(whole[a : b - grams + 1], return_index=True)
            place = order[a : b - grams + 1][one] if frequencies is not None else None
        else:
            s = mix(ngram_hashes(words[a:b], n) + np.uint64(n)) if n else whole[:0]
            place = np.zeros(len(s), np.int64)
        out.append(s if frequencies is None else (s, place))
    return out


def frequencies(docs: DataFrame, grams: int) -> Frequencies:
    """What is frequent, from counts within chunks of all documents."""
    schema = pa.schema([("word", pa.bool_()), ("hash", pa.int64()), ("n", pa.int64())])

    def count(parts: list[np.ndarray], word: bool, least: int) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(parts), return_counts=True)
        keep = n >= least
        return as_batch({"word": np.full(int(keep.sum()), word), "hash": signed(found[keep]), "n": n[keep]}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, size = [], [], 0
        for batch in by_bytes(batches):
            held += gram_sets(batch.column(0), grams, words)
            size += sum(map(len, held[-batch.num_rows :]))
            if size >= _CHUNK_GRAMS:
                yield count(held, False, _CHUNK_DOCS)
                yield count(words, True, _CHUNK_WORDS)
                held, words, size = [], [], 0
        if held:
            yield count(held, False, _CHUNK_DOCS)
            yield count(words, True, _CHUNK_WORDS)
        del held, words
        give_back()

    rows = materialize(docs.select("text").mapInArrow(run, "word boolean, hash long, n long").groupBy("word", "hash").agg(F.sum("n").alias("n")), "frequent")
    found = []
    for word, most in ((False, MAX_FREQUENT), (True, MAX_WORDS)):
        top = rows.where(F.col("word") == word).orderBy(F.desc("n"), "hash").limit(most).select("hash", "n").toArrow()
        hashes, n = unsigned(top.column(0).to_numpy()), top.column(1).to_numpy()
        order = np.argsort(hashes)
        found += [hashes[order], n[order]]
    total = max(1, int(found[3].sum()))
    rareness = np.minimum(np.round(-16 * np.log2(found[3] / total)), _RAREST).astype(np.int64)
    return Frequencies(found[0], found[1], found[2], rareness)


def set_names(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name of each set."""
    return np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)


def parities(s: np.ndarray, size: int = PARITY) -> np.ndarray:
    """For each of 64 * size hash ranges, a bit for an odd number of n-grams of the set."""
    n = np.bincount((s >> np.uint64(64 - (64 * size).bit_length() + 1)).astype(np.int64), minlength=64 * size)
    return np.packbits((n & 1).astype(np.uint8)).view(np.int64)


def sent_frequencies(docs: DataFrame, how: Similarity) -> Broadcast:
    """What the order of all n-grams rests on, in all tasks: at most MAX_FREQUENT and MAX_WORDS entries."""
    return docs.sparkSession.sparkContext.broadcast(frequencies(docs, how.grams))


def prefixes(docs: DataFrame, how: Similarity, sent: Broadcast) -> DataFrame:
    """doc_id, n (set size), low and high (128 bits that name the set), parity, prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            sets, low, high, parity, prefix = [], [], [], [], []
            for s, place in gram_sets(batch.column(1), how.grams, frequencies=sent.value):
                m = mix(s)
                sets.append(s)
                low.append(m.sum(dtype=np.uint64))
                high.append(mix(m + np.uint64(1)).sum(dtype=np.uint64))
                parity.append(parities(s))
                prefix.append(signed(s[np.argsort(place, kind="stable")[: how.prefix(len(s))]] if len(s) else s))
            yield as_batch({"doc_id": batch.column(0), "n": np.array([len(s) for s in sets]), "low": signed(np.array(low, np.uint64)), "high": signed(np.array(high, np.uint64)), "parity": parity, "prefix": prefix}, _SETS)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, low long, high long, parity array<long>, prefix array<long>")


def _sent(rows: DataFrame) -> DataFrame:
    """Rows of a few numbers, for a join to which they are sent if they are few enough."""
    return F.broadcast(rows) if rows.limit(MAX_NAMED + 1).count() <= MAX_NAMED else rows


def whole_sets(docs: DataFrame, ids: DataFrame, grams: int, sent: Broadcast) -> DataFrame:
    """id, low (names the set among those of the id), parity, wide (a longer parity), grams (in the order of all n-grams) of the documents in ids(id)."""
    schema = pa.schema([("id", pa.int64()), ("low", pa.int64()), ("parity", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            found = gram_sets(batch.column(1), grams, frequencies=sent.value)
            sets, ordered = [s for s, _ in found], [signed(s[np.argsort(place, kind="stable")]) for s, place in found]
            yield as_batch({"id": batch.column(0), "low": signed(set_names(sets)), "parity": [parities(s) for s in sets], "wide": [parities(s, WIDE) for s in sets], "grams": ordered}, schema)

    some = docs.select("doc_id", "text").join(_sent(ids), F.col("doc_id") == F.col("id"), "left_semi")
    return some.mapInArrow(run, "id long, low long, parity array<long>, wide array<long>, grams array<long>")


#: A pair is made at the first of its shared n-grams, as far as the first HEADS that a set shares with any other tell.
HEADS = 4


def bucketed(tokens: DataFrame, how: Similarity) -> DataFrame:
    """row, n and found: (pos, token, c) of the n-grams of a set's prefix that c > 1 sets have, in order.

    tokens: row (names the set), n, pos, token.
    """
    shared = tokens.groupBy("token").agg(F.count("*").alias("c"), F.min("n").alias("least")).where("c > 1")
    # a set that is too far from the shortest one of its bucket is too far from all
    rows = tokens.join(shared, "token").where(F.col("n") - F.col("pos") >= how.overlap("n", "least"))
    return rows.groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("pos", "token", F.col("c").cast("int").alias("c")))).alias("found"))  # bounded by the set


def _heads(found: str = "found"):
    return F.transform(F.slice(found, 1, HEADS), lambda x: x["token"])


def _side(rows: DataFrame, name: str, keys: list[str]) -> DataFrame:
    return rows.select(*keys, *(F.col(c).alias(f"{name}_{c}") for c in rows.columns if c not in keys))


def _not_sooner():
    heads = [F.slice(F.col(f"{p}_heads"), 1, F.least(F.col(f"{p}_before"), F.size(f"{p}_heads"))) for p in "ab"]
    return ~F.coalesce(F.arrays_overlap(*heads), F.lit(False))


def _same_bucket(rows: DataFrame, keys: list[str], condition) -> DataFrame:
    """a_id > b_id of pairs of rows with equal keys, repeats allowed."""
    return _side(rows, "a", keys).join(_side(rows, "b", keys), keys).where((F.col("a_id") > F.col("b_id")) & condition & _not_sooner())


def _by_parity(how: Similarity):
    """The suffix filter: two linked sets differ in few n-grams, and so in few parities."""
    apart = F.aggregate(F.zip_with("a_parity", "b_parity", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return (100 + how.percent) * apart <= (100 - how.percent) * (F.col("a_n") + F.col("b_n"))


def first_pairs(found: DataFrame, how: Similarity, by_parity: bool = True) -> DataFrame:
    """a, b: likely pairs from buckets of at most DENSE sets. found: see bucketed(), with id, and with parity if pairs are told apart by it."""
    own = ["id", "n", *(["parity"] if by_parity else [])]
    rows = found.select(*own, _heads().alias("heads"), F.posexplode("found").alias("before", "x"))
    rows = rows.where(F.col("x.c") <= DENSE).select(*own, "heads", "before", F.col("x.pos").alias("pos"), F.col("x.token").alias("token"))
    rest = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
    fit = how.alike_in_size("a_n", "b_n") & (rest >= how.overlap("a_n", "b_n"))
    pairs = _same_bucket(rows, ["token"], fit & _by_parity(how) if by_parity else fit)
    return pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def _groups(found: DataFrame, keys: list[str]) -> DataFrame:
    """group, id, low (a written table): buckets of more than DENSE sets, those of the same sets as one. found: keys, id, low, found."""
    dense = found.withColumn("found", F.filter("found", lambda x: x["c"] > DENSE)).where(F.size("found") > 0)
    # a set's largest bucket leads it; a bucket goes to where most of its sets are led
    lead = F.array_max(F.transform("found", lambda x: F.struct(x["c"].alias("c"), x["token"].alias("token"))))["token"]
    rows = materialize(dense.select(*keys, "id", "low", lead.alias("lead"), F.explode(F.transform("found", lambda x: x["token"])).alias("token")), "dense")
    to = rows.groupBy(*keys, "token", "lead").agg(F.count("*").alias("c")).groupBy(*keys, "token").agg(F.max_by("lead", F.struct("c", "lead")).alias("to"))
    out = materialize(rows.join(to, [*keys, "token"]).select(F.xxhash64(*keys, "to").alias("group"), "id", "low").distinct(), "groups")
    release(rows)
    return out


def _cores(members: DataFrame) -> DataFrame:
    """group, core: n-grams that more than half of a group's sets have, as far as they are in the majority of a chunk of its sets.

    An n-gram of the majority of all is in that of some chunk, so only those are counted. A core that lacks one costs time only.
    """
    schema = pa.schema([("group", pa.int64()), ("size", pa.int64()), ("tokens", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            cut, grams = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy(zero_copy_only=False)
            for g, a, b in zip(batch.column(0).to_pylist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                held.setdefault(g, []).append(grams[a:b])
                size += b - a
                if size >= _CHUNK_GRAMS:
                    yield majority(held)
                    held, size = {}, 0
        if held:
            yield majority(held)

    def majority(held: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        out: dict[str, list] = {f.name: [] for f in schema}
        for g, sets in held.items():
            token, n = np.unique(np.concatenate(sets), return_counts=True)
            most = 2 * n > len(sets)
            for name, value in zip(out, (g, len(sets), token[most], n[most]), strict=True):
                out[name].append(value)
        return as_batch(out, schema)

    rows = materialize(members.select("group", "grams").mapInArrow(run, "group long, size long, tokens array<long>, counts array<long>"), "majorities")
    sizes = rows.groupBy("group").agg(F.sum("size").alias("size"))
    each = rows.select("group", F.explode(F.arrays_zip("tokens", "counts")).alias("x")).groupBy("group", F.col("x.tokens").alias("token")).agg(F.sum("x.counts").alias("c"))
    # a core is at most twice as long as its sets on average
    out = materialize(each.join(sizes, "group").where("2 * c > size").groupBy("group").agg(F.sort_array(F.collect_list("token")).alias("core")), "cores")
    release(rows)
    return out


#: Residuals of at most so many n-grams are compared in the join itself, others by parity and later as whole sets.
SHORT = 64


def _residual_round(groups: DataFrame, sets: DataFrame, how: Similarity, last: bool) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Links (a, b) within groups, likely pairs (a, b), and the groups of what is still dense (None: nothing).

    groups: group, id, low; sets: see whole_sets(). With A = 100 + percent, B = 100 - percent and the margin A * |residual| - B * n of
    each set, two sets link where the sum of their margins is at most 2 * A times the number of n-grams that their residuals share.
    """
    more, less = 100 + how.percent, 100 - how.percent
    members = materialize(sets.drop("wide").join(_sent(groups), ["id", "low"]), "members")
    cores = _cores(members)
    few = (cores.agg(F.sum(F.size("core"))).first()[0] or 0) <= MAX_NAMED
    core = F.coalesce("core", F.array().cast("array<long>"))
    # in order: what is not in the core, rare first, then what is
    residual = F.concat(F.array_except("grams", core), F.array_except(core, "grams"))
    rows = members.join(F.broadcast(cores) if few else cores, "group", "left").select("group", "id", "low", "parity", F.size("grams").cast("long").alias("n"), residual.alias("residual"))
    residuals = materialize(rows.withColumn("margin", more * F.size("residual").cast("long") - less * F.col("n")), "residuals")
    hubs = residuals.groupBy("group").agg(F.min(F.struct("margin", "id")).alias("hub"))
    rows = residuals.join(hubs, "group").withColumn("near", F.col("margin") + F.col("hub.margin") <= 0)
    links = rows.where(F.col("near") & (F.col("id") != F.col("hub.id"))).select(F.col("id").alias("a"), F.col("hub.id").alias("b"))
    # at least so many residual n-grams are shared with any partner, by the least margin that one has and by what a partner can have;
    # two sets that are near need no look, so partners of a near set have a margin above that of the hub with its sign changed
    most = less * F.ceil(100 * F.col("n") / how.percent)
    shared = lambda least: F.greatest(F.lit(1), F.ceil((F.col("margin") + least) / (2 * more) - 1e-9), F.ceil((F.col("margin") - most) / more - 1e-9))
    with_far = shared(-F.col("hub.margin"))
    need = F.when(F.col("near"), with_far).otherwise(shared(F.col("hub.margin")))
    prefix = F.slice("residual", 1, (F.size("residual") - need + 1).cast("int"))
    placed = rows.where(F.size("residual") >= need).select("group", "id", "low", "margin", "near", (F.size("residual") - with_far).alias("last"), F.posexplode(prefix).alias("pos", "token"))
    # what comes after the last place by which two sets that are not near can meet serves to meet near ones only
    placed = materialize(placed.withColumn("deep", ~F.col("near") & (F.col("pos") > F.col("last"))).drop("last"), "placed")
    near, far, high = F.count_if(F.col("near")), F.count_if(~F.col("near")), F.count_if(~F.col("near") & ~F.col("deep"))
    # c: the size of a bucket of as many pairs
    pairs = F.ceil(F.sqrt(2 * near * far + high * high)).cast("int")
    buckets = placed.groupBy("group", "token").agg(pairs.alias("c"), near.alias("nears"), far.alias("fars"), high.alias("highs")).where("fars > 0 and (nears > 0 or highs > 1)")
    meets = F.when(F.col("near"), F.col("fars") > 0).when(F.col("deep"), F.col("nears") > 0).otherwise((F.col("nears") > 0) | (F.col("highs") > 1))
    found = placed.join(buckets, ["group", "token"]).where(meets).groupBy("group", "id", "low", "margin", "near").agg(F.sort_array(F.collect_list(F.struct("pos", "token", "c"))).alias("found"))
    found = materialize(found, "found")
    own = rows.select("group", "id", "low", "n", "parity", F.size("residual").cast("long").alias("size"), F.when(F.size("residual") <= SHORT, F.col("residual")).alias("short"))
    held = found.join(own, ["group", "id", "low"]).drop("low").withColumn("heads", _heads()).select("*", F.posexplode("found").alias("before", "x")).drop("found")
    held = held.where(F.lit(True) if last else F.col("x.c") <= DENSE).withColumns({"pos": F.col("x.pos"), "token": F.col("x.token")}).drop("x")
    both = F.col("a_margin") + F.col("b_margin")
    rest = F.least(F.col("a_size") - F.col("a_pos"), F.col("b_size") - F.col("b_pos"))
    alike = F.when(F.col("a_short").isNotNull() & F.col("b_short").isNotNull(), both <= 2 * more * F.size(F.array_intersect("a_short", "b_short"))).otherwise(_by_parity(how))
    fit = ~(F.col("a_near") & F.col("b_near")) & how.alike_in_size("a_n", "b_n") & (both <= 2 * more * rest) & alike
    pairs = materialize(_same_bucket(held, ["group", "token"], fit).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct(), "pairs")
    links = materialize(links.distinct(), "links")
    onward = None if last else _groups(found, ["group"])
    release(members, cores, residuals, placed, found)
    return links, pairs, onward


def link_sets(tokens: DataFrame, docs: DataFrame, ones: DataFrame, how: Similarity, sent: Broadcast, prune: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Links (a, b) of sets. tokens: see bucketed(); docs: the texts of their ids; ones: row, id, low, parity.

    prune: takes the pairs of buckets (a, b) and leaves the likely ones; without it, they are told apart by parity.
    """
    names = ones.select("row", "id", "low", *(["parity"] if prune is None else []))
    found = materialize(bucketed(tokens, how).join(names, "row").drop("row"), "buckets")
    pairs = first_pairs(found, how, prune is None)
    pairs = materialize(pairs if prune is None else prune(pairs), "pairs")
    groups = _groups(found, [])
    ids = materialize(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).unionByName(groups.select("id")).distinct(), "ids")
    sets = materialize(whole_sets(docs, ids, how.grams, sent), "whole")
    if sets.count() != sets.select("id", "low").distinct().count():  # repeated rows
        sets = materialize(sets.dropDuplicates(["id", "low"]), "whole")
    links, level, written = None, 0, [found, pairs, ids, sets]
    while not groups.isEmpty():
        level += 1
        new, likely, onward = _residual_round(groups, sets, how, level == LEVELS)
        links = new if links is None else links.unionByName(new)
        pairs = pairs.unionByName(likely)
        written += [groups, likely]
        if onward is None:
            break
        groups = onward
    pairs = materialize(pairs.distinct(), "pairs")
    written.append(pairs)
    # longer parities tell most pairs of long sets apart, so that few whole sets travel
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("wide").alias(f"{side}_parity"), F.size("grams").cast("long").alias(f"{side}_n")), side)
    pairs = materialize(pairs.where(_by_parity(how)).select("a", "b").distinct(), "pairs")
    written.append(pairs)
    both = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = sets.join(_sent(both), "id", "left_semi")  # others have been seen in groups only
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("grams").alias(f"{side}_grams")), side)
    common = F.size(F.array_intersect("a_grams", "b_grams")).cast("long")
    verified = materialize(pairs.where(100 * common >= how.percent * (F.size("a_grams") + F.size("b_grams") - common)).select("a", "b"), "links")
    release(*written)
    return verified if links is None else verified.unionByName(links)


def named_sets(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of a written table of prefixes() with unique numbers in row: a written table of each set with id, the least doc_id that has it, and
    one of its rows; and these rows whole.
    """
    some = sets.where("n > 0 and doc_id is not null").groupBy("low", "high", "n").agg(F.min(F.struct("doc_id", "row")).alias("x"))
    named = materialize(some.select("low", "high", "n", F.col("x.doc_id").alias("id"), "x.row"), "named")
    return named, sets.join(named.select("row"), "row", "left_semi").withColumnRenamed("doc_id", "id")


def similarity_components(docs: DataFrame, how: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links) for each row of docs(doc_id, text)."""
    docs = docs.select("doc_id", "text")
    sent = sent_frequencies(docs, how)
    sets = materialize(prefixes(docs, how, sent).withColumn("row", F.monotonically_increasing_id()), "sets")
    named, ones = named_sets(sets)
    tokens = ones.select("row", "n", F.posexplode("prefix").alias("pos", "token"))
    links = link_sets(tokens, docs, ones, how, sent)
    return with_components(sets, named, links).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def with_components(sets: DataFrame, named: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, n, component_id of each row of sets. links: of ids in named. Deletes sets and named, see named_sets()."""
    key = F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id"))
    rows = materialize(sets.select("doc_id", "n", "low", "high").join(named.drop("row"), ["low", "high", "n"], "left").select("doc_id", "n", key.alias("id")), "named-rows")
    release(sets, named)
    several = rows.groupBy("doc_id").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x != y").select("doc_id")
    same = rows.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    labels = connected_components(links.unionByName(same))
    return rows.join(labels, "id", "left").select("doc_id", "n", F.coalesce("component", "id").alias("component_id"))
