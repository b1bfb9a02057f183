"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_path
from . import align, brown_lm, chat, decontaminate, fill_in_middle, fingerprints, minhash_dedup, ngram_join, packing, substring_dedup, token_counts, token_files, toxicity


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.removal_report(_table(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "evidence", "evidence_cosine")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # several a task, so that tasks are alike
    return fingerprints.edit_report(_table(spark, sf_dir, "documents"), buckets)


def fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op3_fingerprints that SQL can express."""
    return op3_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def near_duplicates_by_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of fingerprints: bands of signatures, joined and verified."""
    return fingerprints.near_duplicates(_table(spark, sf_dir, "documents"), percent=80)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), limit=1024)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(f"SELECT -1L conv_id, 0L turn, 'user' role, {said} text UNION ALL SELECT -1L, 1L, 'assistant', {said}")
    return chat.read_conversations(chat.format_conversations(talks.unionByName(extra)))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri, docs = new_path(spark, "token-files"), _table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, uri, _vocabulary("word_bpe_49k.json"), end_id=2, files=token_files.file_count(docs))
    read = token_files.read_token_files(spark, uri, manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model, counts = brown_lm.train(docs.where(~brown_lm.held_out()))
    return brown_lm.score(docs, model, counts).select("doc_id", brown_lm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(_table(spark, sf_dir, "documents"), ngram_join.Similarity(grams=4, percent=85))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=13, coverage=0.05)
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), ngram_join.Similarity(grams=2, percent=80))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align.align(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"), fill_in_middle.Options(seed=1, percent=90, spm_percent=20))
    digest = {"output_sha256": F.sha2(F.col("output").cast("binary"), 256), "restored_sha256": F.sha2(fill_in_middle.restore().cast("binary"), 256)}
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *(c.alias(n) for n, c in digest.items()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_fingerprints": op3_fingerprints,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_token_files": op7_token_files,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_fill_in_middle": op13_fill_in_middle,
    "fingerprint_edits": fingerprint_edits,
    "near_duplicates_by_fingerprint": near_duplicates_by_fingerprint,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN, _ALNUM = r"'[^\x20\x09-\x0D]+'", r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_OP1 = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_PLAIN}) AS w FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS p FROM d WHERE len(w) >= 50) x),
own AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, q FROM (SELECT win.doc_id, unnest(generate_series(p, p + 49)) AS q FROM win JOIN own ON win.h = own.h WHERE first < win.doc_id) x),
word AS (SELECT doc_id, unnest(w) AS t, unnest(generate_series(1, len(w))) AS q FROM d),
kept AS (SELECT word.doc_id, count(gone.q) AS n, string_agg(t, ' ' ORDER BY word.q) FILTER (gone.q IS NULL) AS s FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.q = gone.q GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

_ESCAPED = r"regexp_replace(coalesce({}, ''), '([<\[])(\\*(?:/?INST\]|/?s>))', '\1\\\2', 'g')"
_OP6 = f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(13 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


def _components_sql(grams: int, percent: int) -> str:
    return f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_PLAIN}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + {grams - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - {grams - 1}, 1))) AS p FROM d WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT f.b, r.root FROM r JOIN f ON r.id = f.a WHERE r.root < f.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(root) FROM r WHERE r.id = d.doc_id) AS component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id"""


_OP10 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS k FROM (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark) x WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT item, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM i) x),
grams AS (SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d JOIN (SELECT DISTINCT k FROM win) l ON len(w) >= k) x),
hit AS (SELECT doc_id, p, grams.k, item FROM grams JOIN win ON grams.k = win.k AND grams.g = win.g),
word AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM hit) x GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hit) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(item.n, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(word.n, 0) > 0 AND 20 * coalesce(word.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN word ON d.doc_id = word.doc_id LEFT JOIN item ON d.doc_id = item.doc_id"""

_EDITS = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
e AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS n FROM d)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(substr(t, 1, length(t) - length(t) // 2) || substr(n, 1, length(t) // 2)) AS edited_sha256 FROM e"""

_H = [f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)" for k in range(4)]
_OP13 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT *, least({_H[0]} % (len(w) + 1), {_H[1]} % (len(w) + 1)) AS low, greatest({_H[0]} % (len(w) + 1), {_H[1]} % (len(w) + 1)) AS high,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_H[2]} % 100 >= 90 THEN 'plain' WHEN {_H[3]} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, t, len(w) AS n, form, array_to_string(w[1:low], '') AS a, array_to_string(w[low + 1:high], '') AS b, array_to_string(w[high + 1:], '') AS z FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

#: The others rest on tokenizers, trained models or hash permutations, which SQL cannot express.
ORACLES: dict[str, str] = {
    "op1_substring_dedup": _OP1,
    "op6_chat_formatting": _OP6,
    "op9_ngram_jaccard_join": _components_sql(4, 85),
    "op10_decontamination": _OP10,
    "op11_minhash_dedup": f"SELECT *, doc_id = component_id AS kept FROM ({_components_sql(2, 80)}) c",
    "op13_fill_in_middle": _OP13,
    "fingerprint_edits": _EDITS,
    "near_duplicates_by_fingerprint": _components_sql(5, 80),
}
