"""The text operators against brute force on a small corpus with copies, near copies, shared passages, nulls and odd texts."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorchmap.llm import brown_lm, chat, decontaminate, fingerprints, ngram_join, packing, substring_dedup, token_counts, token_files, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BPE, BYTE_BPE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


def corpus():
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choices("abcdéñ", k=rnd.randint(2, 6))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    passage, base = text(60), text(90).split()
    docs = [text(rnd.randint(1, 160)) for _ in range(40)]
    docs += [docs[3], docs[3], docs[5].upper()]
    for _ in range(12):
        copy = list(base)
        copy[rnd.randrange(90)] = "edit"
        docs.append(" ".join(copy))
    docs += [f"{text(20)} {passage}\n{text(15)}" for _ in range(5)]
    docs += [passage, " ".join(passage.split()[:50]), " ".join(passage.split()[:49]), "", " ", None, "one", "one two three", "\t x  \n", "it's <|endoftext|> A  b  c　 d", text(9000)]
    return list(enumerate(docs))


DOCS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "x", "y", None, "z") for k, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, anchor string, n long, bucket string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id < 0")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_token_counts(docs, empty):
    t = Tokenizer.from_file(BYTE_BPE)
    got = by_id(token_counts.count_tokens(docs, BYTE_BPE))
    for k, x in DOCS:
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len((x or "").encode()), n, n > 1024)
    assert token_counts.count_tokens(empty, BYTE_BPE).count() == 0


def test_random_texts_encode_like_the_library():
    import pyarrow as pa

    from scorchmap.llm.encoding import encoder
    from scorchmap.llm.textops import text_bytes

    rnd = random.Random(2)
    parts = list(" \n\t'.,|<>aAbsStTéÉ 　́ 12ñ日\u0085-ßİ") + ["'s", "'re", "<|endoftext|>", "<|ENDOFTEXT|>", "  "]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(1500)]
    for path, kind in ((BYTE_BPE, "lead"), (WORD_BPE, "drop")):
        e = encoder(path, kind)
        for i in range(0, len(texts), 50):
            ids, first = e.encode(*text_bytes(pa.array(texts[i : i + 50])))
            for k, want in enumerate(e.tokenizer.encode_batch(texts[i : i + 50], add_special_tokens=False)):
                assert ids[first[k] : first[k + 1]].tolist() == want.ids, texts[i + k]


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40)])
def test_packing(docs, empty, limits):
    t = Tokenizer.from_file(WORD_BPE)
    ids = {k: [*t.encode(x or "", add_special_tokens=False).ids, 1] for k, x in DOCS}
    marked = docs.withColumn("prompt", (F.col("doc_id") % 7).cast("int"))
    rows = packing.pack_documents(marked, WORD_BPE, 1, limits, loss_from="prompt").collect()
    sequences, pieces = {}, {}
    for r in rows:
        assert list(struct.unpack(f"<{r.length}I", r.ids)) == ids[r.doc_id][r.start : r.start + r.length]
        assert r.loss_tokens == sum(k >= r.doc_id % 7 for k in range(r.start, r.start + r.length)) and r.doc_tokens == len(ids[r.doc_id])
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.loss_tokens))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for k, p in pieces.items():
        assert [s for s, _ in sorted(p)] == [sum(n for s, n in p if s < a) for a, _ in sorted(p)] and sum(n for _, n in p) == len(ids[k])
    assert pieces.keys() == ids.keys()
    for s in sequences.values():
        s.sort()
        n = sum(x[1] for x in s)
        assert [x[0] for x in s] == [sum(y[1] for y in s[:k]) for k in range(len(s))]
        assert n <= limits.tokens and len(s) <= limits.segments and sum(x[2] for x in s) <= limits.loss_tokens
        assert n == limits.tokens or n & (n - 1) == 0
    assert packing.pack_documents(empty, WORD_BPE, 1).count() == 0


def test_token_files(spark, docs, empty, tmp_path):
    t = Tokenizer.from_file(WORD_BPE)
    uri = f"file://{tmp_path}/files"
    manifest = token_files.write_token_files(docs, uri, WORD_BPE, 2, 4)
    got = by_id(token_files.read_token_files(spark, uri, manifest, block_tokens=100))
    at = 0
    for k, x in DOCS:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        assert (got[k].start, got[k].n_tokens, zlib.crc32(got[k].ids)) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert token_files.write_token_files(empty, f"{uri}2", WORD_BPE, 2, 4) == []
    assert token_files.read_token_files(spark, f"{uri}2", []).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        token_files.write_token_files(docs, f"{uri}3", WORD_BPE, 2, 4, dtype="<u1")


def test_words_that_collide_under_simple_hashes(spark):
    """Thue-Morse words and their opposites: sums of powers modulo 2**64 cannot tell those of 1024 letters apart."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    turned = str.maketrans("ab", "ba")
    texts = [f"x {w} y" for n in (1024, 2048) for w in (word[:n], word[:n].translate(turned))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for vocabulary, rows in ((BYTE_BPE, token_counts.count_tokens(df, BYTE_BPE)), (WORD_BPE, packing.pack_documents(df, WORD_BPE, 1).groupBy("doc_id").agg((F.sum("length") - 1).alias("n_tokens")))):
        t = Tokenizer.from_file(vocabulary)
        assert {r.doc_id: r.n_tokens for r in rows.collect()} == {k: len(t.encode(x, add_special_tokens=False).ids) for k, x in enumerate(texts)}
    assert len({r.fingerprint for r in fingerprints.fingerprint(df).collect()}) == 4
    assert [r.component_id for r in ngram_join.similarity_components(df).orderBy("doc_id").collect()] == [0, 1, 2, 3]
    assert brown_lm.train(df)[1].count() == 7
    assert substring_dedup.removal_report(df, window=3 + substring_dedup.ANCHOR).where("n_removed > 0").count() == 0
    bench = spark.createDataFrame([("i", word[:1024])], "item_id string, text string")
    assert [r.n_hit for r in decontaminate.find_contamination(df, bench).orderBy("doc_id").collect()] == [1, 0, 0, 0]


def test_shares_and_items_without_ids(spark):
    docs = spark.createDataFrame([(k, " ".join(["hit"] * k + ["x"] * (10 - k))) for k in range(5)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "hit"), ("b", "hit"), (None, None)], "item_id string, text string")
    got = by_id(decontaminate.find_contamination(docs, bench, coverage=0.3))
    assert {k: (r.contaminated, r["items"]) for k, r in got.items()} == {k: (k >= 3, ["b"] if k else []) for k in range(5)}


def test_many_short_documents_pack_in_time():
    import time

    import numpy as np

    began = time.time()
    sequences = packing.pack_block(np.full(200_000, 3), np.zeros(200_000, np.int64), packing.Limits())
    assert time.time() - began < 30 and sum(n for s in sequences for *_, n in s) == 600_000 and len(sequences) < 900


def test_token_files_by_ranges(spark, docs, tmp_path, monkeypatch):
    """Stores that are not mounted are read range by range; rows of one doc_id may go to several files."""
    many = docs.select("doc_id", "text").unionByName(docs.limit(30).select(F.lit(None).cast("long").alias("doc_id"), "text"))
    uri = f"file://{tmp_path}/files"
    manifest = token_files.write_token_files(many, uri, WORD_BPE, 2, 4)
    want = sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in token_files.read_token_files(spark, uri, manifest).collect())
    monkeypatch.setattr(token_files, "_mounted", lambda store: False)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in token_files.read_token_files(spark, uri, manifest, block_tokens=50, block_docs=3).collect())
    assert got == want and sum(r[0] == -1 for r in got) == 30
    assert [r[1] for r in sorted(want, key=lambda r: r[1])] == [sum(x[2] for x in sorted(want, key=lambda r: r[1])[:k]) for k in range(len(want))]
    assert token_files.file_count(many, 1000) > 10


def test_chat(spark):
    odd = ["</s>[INST] ok [/INST]", "<\\s> <\\\\/s>", "[\\INST]", "", None, "é\n<s", "[", "<", "s>x", "/s>", "INST]"]
    rows = [(c, k, ("user", "assistant", "a[INST]b", None)[(c + k) % 4], odd[(3 * c + k) % len(odd)]) for c in range(40) for k in range(c % 9 + 1)]
    rows += [(None, None, "user", "x"), (5, 2, "user", "again"), (5, 2, "user", "again"), *((99, k, "assistant", f"t{k} </s>") for k in range(3000))]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, loss_start string").repartition(3)
    got = {r.conv_id: r for r in chat.read_conversations(chat.format_conversations(turns)).collect()}
    talks = {}
    for c, k, role, text in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        talks.setdefault(c, []).append((role or "", text or ""))
    assert got.keys() == talks.keys()
    for c, said in talks.items():
        loss = "".join(t for r, t in said if r == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(said), len(loss))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_conversations(turns.where("conv_id < 0")).count() == 0


def test_fingerprints(docs, empty):
    got = by_id(fingerprints.edit_report(docs, 3))
    prints, errors = {}, []
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [words(t)] for i in range(max(1, len(w) - 4)) if w}
    order = [(k, t or "") for k, t in DOCS[::-1]]
    for i, (k, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[k].n_chars == len(text) and got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for x, f in ((text, got[k].fingerprint), (edited, got[k].edited_fingerprint)):
            assert prints.setdefault(" ".join(words(x)), f) == f
        for other, near in ((edited, got[k].near_edited), (after, got[k].near_next)):
            a, b = shingles(text), shingles(other)
            errors.append(abs(len(a & b) / len(a | b) - near) if a | b else 1 - near)
    assert max(errors) < 0.15 and sum(errors) / len(errors) < 0.03
    assert fingerprints.edit_report(empty, 3).count() == 0
    assert [r.near_next for r in fingerprints.edit_report(docs.where("doc_id = 4"), 3).collect()] == [1.0]


def brute_components(sets, percent):
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in sets}


def grams(text, n):
    w = words(lower(text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.mark.parametrize("how", [ngram_join.Similarity(4, 85), ngram_join.Similarity(2, 60)])
def test_ngram_join(docs, empty, how):
    sets = {k: grams(t, how.grams) for k, t in DOCS}
    want = brute_components(sets, how.percent)
    got = by_id(ngram_join.similarity_components(docs, how))
    assert {k: (got[k].n_shingles, got[k].component_id) for k in sets} == {k: (len(sets[k]), want[k]) for k in sets}


def test_ngram_join_of_nothing(empty):
    assert ngram_join.similarity_components(empty).count() == 0


def test_near_duplicates(docs):
    want = brute_components({k: grams(t, 5) for k, t in DOCS}, 80)
    assert {r.doc_id: r.component_id for r in fingerprints.near_duplicates(docs).collect()} == want


def brute_removal(window):
    seen, out = {}, {}
    for k, t in DOCS:
        w = words(t)
        own = {tuple(w[a : a + window]) for a in range(len(w) - window + 1)}
        gone = {i for a in range(len(w) - window + 1) if tuple(w[a : a + window]) in seen for i in range(a, a + window)}
        out[k] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
        seen |= dict.fromkeys(own)
    return out


@pytest.mark.parametrize("settings", [{}, {"SHARD_WORDS": 300, "_TOGETHER": 8, "_COPY": 16}])
def test_substring_dedup(docs, empty, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(substring_dedup, name, value)
    got = by_id(substring_dedup.removal_report(docs, 50))
    assert {k: (r.n_words, r.n_removed, r.kept) for k, r in got.items()} == brute_removal(50)


def test_substring_dedup_keeps_columns(docs, empty):
    kept = substring_dedup.remove_repeats(docs, 50)
    assert kept.columns == docs.columns
    want = {k: n[2] if n[1] else t for (k, t), n in zip(DOCS, brute_removal(50).values(), strict=True)}
    assert {r.doc_id: r.text for r in kept.collect()} == want
    assert substring_dedup.removal_report(empty).count() == 0


@pytest.mark.parametrize("most", [1 << 25, 300])
def test_decontamination(spark, docs, empty, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MAX_ITEM_BYTES", most)
    token = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    taken = [token.findall(lower(t or "")) for _, t in DOCS]
    items = [("a", " ".join(taken[3][:20])), (" b", " ".join(taken[50][5:40]).upper()), ("c", "one, TWO three"), ("d", None), ("e", ""), ("f", taken[8][0] if taken[8] else "q"), ("g", " ".join(taken[56][20:75])), ("g", "edit")]
    windows = {}
    for i, t in items:
        w = token.findall(lower(t or ""))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = by_id(decontaminate.find_contamination(docs, bench))
    dirty = set()
    for (k, _), w in zip(DOCS, taken, strict=True):
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit |= set(range(a, a + n))
                    found |= windows[tuple(w[a : a + n])]
        bad = bool(hit) and 20 * len(hit) >= len(w)
        dirty |= {k} if bad else set()
        assert (got[k].n_words, got[k].n_hit, got[k]["items"], got[k].contaminated) == (len(w), len(hit), sorted(found), bad), k
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id: r.text for r in kept.collect()} == {k: t for k, t in DOCS if k not in dirty}
    assert decontaminate.find_contamination(empty, bench).count() == 0 and decontaminate.find_contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_decontamination_cuts_long_spans(spark):
    docs = spark.createDataFrame([(1, "aa bb, cc dd ee ff " + " ".join(f"w{k}" for k in range(200)))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "bb cc dd ee")], "item_id long, text string")
    assert decontaminate.decontaminate(docs, bench, window=3, span=3).first().text.startswith("aa  ff w0")


def test_language_model(docs, empty):
    train = docs.where(~brown_lm.held_out())
    model, counts = brown_lm.train(train)
    got = by_id(brown_lm.score(docs, model, counts))
    tokens = {k: [*words(lower(t or "")), None] for k, t in DOCS}
    c = Counter(w for k in tokens if zlib.crc32(str(k).encode()) % 10 for w in tokens[k])
    total = sum(c.values())
    for k, t in tokens.items():
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1))) for w in t)
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(t), sum(c[w] > 0 for w in t), total)
        assert abs(got[k].base_score - base) < 1e-6 * abs(base) and got[k].score < 0
    # moves out of each class, and words of each class, are distributions
    assert abs((10.0**model.log_moves).sum(axis=1) - 1).max() < 1e-9
    nothing, none = brown_lm.train(empty)
    assert brown_lm.score(docs, nothing, none).where("n_known > 0").count() == 0


@pytest.mark.parametrize("settings", [{}, {"FREQUENT": 200, "CLUSTERED": 64, "EXTENDED": 64}])
def test_language_model_score(docs, monkeypatch, settings):
    """The score from the classes that words have got: transitions and emissions counted by hand."""
    import numpy as np

    from scorchmap.llm.textops import signed

    for name, value in settings.items():
        monkeypatch.setattr(brown_lm, name, value)
    model, table = brown_lm.train(docs.where(~brown_lm.held_out()))
    got = by_id(brown_lm.score(docs, model, table))
    of = {r.key: r["class"] for r in table.collect()}
    end, rest, groups = brown_lm.CLASSES, brown_lm.CLASSES + 1, brown_lm.CLASSES + 2
    key = lambda w: int(signed(brown_lm.tokens(pa.array([w]))[0][:1])[0])
    names = {w: key(w) for w in {w for _, t in DOCS for w in words(lower(t or ""))}}
    assert len(set(names.values())) == len(names)
    texts = {k: [*words(lower(t or "")), None] for k, t in DOCS}
    train = [k for k in texts if zlib.crc32(str(k).encode()) % 10]
    c = Counter(w for k in train for w in texts[k])
    cls = lambda w: end if w is None else of.get(names[w], rest)
    assert all(of[names[w]] < brown_lm.CLASSES for w in c if w is not None and c[w] >= brown_lm.ENOUGH and len(of) > brown_lm.CLUSTERED + brown_lm.EXTENDED)
    moves, mass, types = np.zeros((groups, groups)), np.zeros(groups), np.zeros(groups)
    for k in train:
        line = [end, *map(cls, texts[k])]
        for a, b in zip(line, line[1:], strict=False):
            moves[a, b] += 1
    for w, n in c.items():
        mass[cls(w)] += n
        types[cls(w)] += 1
    types[rest] += 1
    share = (moves.sum(axis=0) + 1) / (moves.sum() + groups)
    for k, t in texts.items():
        line = [end, *map(cls, t)]
        p = [(moves[a, b] + 5 * share[b]) / (moves[a].sum() + 5) * (c[w] + 0.1) / (mass[b] + 0.1 * types[b]) for a, b, w in zip(line, line[1:], t, strict=False)]
        assert abs(got[k].score - sum(map(math.log10, p))) < 1e-6 * abs(got[k].score), k


def test_language_model_with_rare_words_joined(docs, monkeypatch):
    train = docs.where(~brown_lm.held_out())
    want = by_id(brown_lm.score(docs, *brown_lm.train(train)))
    monkeypatch.setattr(brown_lm, "FREQUENT", 300)
    monkeypatch.setattr(brown_lm, "CLUSTERED", 64)
    monkeypatch.setattr(brown_lm, "EXTENDED", 64)
    got = by_id(brown_lm.score(docs, *brown_lm.train(train)))
    assert all(abs(got[k].base_score - want[k].base_score) < 1e-9 * abs(want[k].base_score) and got[k].n_known == want[k].n_known for k in want)


def test_exchange_finds_classes():
    import numpy as np

    rnd = np.random.default_rng(1)
    n = np.zeros((20, 20))
    for _ in range(4000):  # even words are followed by odd ones
        a, b = rnd.integers(0, 10, 2)
        n[2 * a, 2 * b + 1] += 1
        n[2 * b + 1, 2 * rnd.integers(0, 10)] += 1
    of = brown_lm.exchange(n, 0, 2)
    assert len({*of[::2]}) == 1 and len({*of[1::2]}) == 1 and of[0] != of[1]


def test_toxicity(spark, empty):
    rnd = random.Random(4)
    bad = ["vile", "scumbag", "rotten", "filthy"]
    plain = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(900):
        toxic = int(k % 6 == 0)
        w = rnd.choices(plain, k=rnd.randint(20, 200))
        for b in rnd.sample(bad, 2) if toxic else []:
            w.insert(rnd.randrange(len(w)), b)
        rows.append((k, " ".join(w), toxic))
    rows += [(900, None, None), (901, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    labels = df.select("doc_id", "toxic")
    model = toxicity.fit(df.drop("toxic"), labels.where(~toxicity.held_out()))
    scored = {r.doc_id: r for r in toxicity.score(df.drop("toxic"), model).collect()}
    test = [r for r in rows[:900] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(scored[k].predicted == t for k, _, t in test) >= 0.97 * len(test)
    assert scored[900].score == scored[901].score < 0.5
    assert toxicity.reject_toxic(df, model).where("toxic = 1").count() <= 5
    few = toxicity.fit(df.drop("toxic"), labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(df, few).collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_weighs_classes_by_what_the_sample_leaves_out():
    import numpy as np

    rng, none = np.random.default_rng(5), np.zeros(0)
    rows = []
    for k in range(60):
        w = rng.random(8)
        rows.append((np.arange(8), w / np.sqrt((w * w).sum()), k, int(k % 4 == 0)))
    model = toxicity.Model(np.arange(8, dtype=np.uint64), np.ones(8), 1.0, 0.0, None, none, none, none, none, (none, none))
    stands = {0: 340.0, 1: 43.0}  # as if the label table were far larger than the sample
    model = toxicity._indexed(model, rows, stands, 0.1)
    votes, entry, cosine = model.votes(model.index.entries)
    for k, (_, w, _, _) in enumerate(rows):
        near = sorted(((float(w @ v), j) for j, (_, v, _, _) in enumerate(rows)), reverse=True)[: toxicity.NEIGHBOURS]
        by = [(c * c / (1.05 - c), rows[j][3]) for c, j in near]
        want = (sum(x * stands[1] for x, label in by if label) + 0.25 * model.prior) / (sum(x * stands[label] for x, label in by) + 0.25)
        assert abs(votes[k] - want) < 1e-9 and entry[k] == k and abs(cosine[k] - 1) < 1e-9


def test_language_model_gives_rare_words_classes(spark, monkeypatch):
    monkeypatch.setattr(brown_lm, "CLUSTERED", 8)
    monkeypatch.setattr(brown_lm, "EXTENDED", 8)
    monkeypatch.setattr(brown_lm, "FREQUENT", 40)
    rnd = random.Random(6)
    odd, even = ([f"{c}{k}" for k in range(60)] for c in "oe")  # in turn, also the words far beyond the first 16
    pick = lambda words: words[min(59, int(rnd.expovariate(0.05)))]
    docs = spark.createDataFrame([(k, " ".join(pick((odd, even)[i % 2]) for i in range(20))) for k in range(400)] + [(400, "once")], "doc_id long, text string")
    model, counts = brown_lm.train(docs)
    table = counts.collect()
    assert all((r["class"] < brown_lm.CLASSES) == (r.n >= brown_lm.ENOUGH) for r in table if r.key != brown_lm.END.astype("int64"))
    assert len(model.words) <= 40 < sum(r.n >= brown_lm.ENOUGH for r in table)
    assert brown_lm.score(docs, model, counts).where("score > base_score").count() >= 390
