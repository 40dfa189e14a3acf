"""The operators over their whole tables, and SQL for the same rows where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import (
    bytebpe, chat, decontaminate, langid, metricjoin, pathjoin, periods, quality, repair, rules, secrets, substrings, wordcount
)
from tabulon.llm.shared import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Cosine of linked embeddings.
NEAR = 0.93
PROBE = "</s>[INST] ok [/INST]"


def hex_digest(text):
    return F.sha2(text.cast("binary"), 256)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    read = chat.read_chats(chat.format_chats(turns.unionByName(probe)))
    lines = F.flatten(
        F.transform("blocks", lambda b: F.transform(b["texts"], lambda t: F.concat(b["role"], F.lit("\n"), t, F.lit("\n"))))
    )
    return read.select(
        "conv_id",
        F.size(lines).cast("long").alias("n_turns"),
        hex_digest(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        hex_digest(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("blocks").cast("long").alias("n_blocks"),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, words = secrets.fitted(docs)
    return secrets.scan(docs, model, words).where("is_secret").select("doc_id", "start", "length", "score")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profile = langid.learn(docs.where(~langid.held_out()))
    found = langid.identify(docs, profile)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents")).select(
        "row.doc_id",
        *[f"m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed",
        "kept",
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.token_counts(table(spark, sf_dir, "documents"), WORD_BPE)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pathjoin.linked(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.where(~quality.held_out()))
    found = quality.scored(docs, model)
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", hex_digest(F.col("kept")).alias("kept_sha256"))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where the texts that the contract of op11 names repeat a stretch of their words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    sized = chosen.where("h is null or size(words) <= 0 or h % 10 <> 0").select("doc_id", "text")
    repeated = chosen.where("h % 10 = 0 and size(words) > 0").withColumn("a", (g % n).cast("int"))
    repeated = repeated.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    a, p = F.col("a"), F.col("p")
    source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
    again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(F.col("words"), source(i)))
    return sized.unionByName(repeated.select("doc_id", F.array_join(again, " ").alias("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(planted(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digests = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        hex_digest(F.array_join(lines, "")).alias("runs_sha256"),
        hex_digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
    return digests.select(
        "doc_id",
        "n_runs",
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.expr("1000 * best.n / -best.p")).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metricjoin.linked(table(spark, sf_dir, "embeddings"), NEAR)


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the damage that the contract of op13 names."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    drawn = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], drawn.alias("h"))
    rows = rows.where("h <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found, rows = repair.repair(damaged(turns))
    digests = repair.joined_digests(rows)
    every = turns.select(F.struct("conv_id").alias("k")).distinct()
    out = every
    for part in (found, digests):
        out = out.join(part.select(F.struct("conv_id").alias("k"), *part.columns[1:]), "k", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        F.col("k.conv_id").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", hex_digest(F.lit(""))).alias("repaired_sha256"),
    )


SQL_CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}'))
), safe AS (
  SELECT *, replace(replace(replace(role, '~', '~0'), '<|', '<~1|'), '|', '~2') AS r,
    replace(replace(text, '~', '~0'), '<|', '<~1|') AS t,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM turns
), pieces AS (
  SELECT *, before IS NULL OR before <> role AS opens FROM safe
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(t) + CASE WHEN opens THEN 16 + length(r) ELSE 8 END)::BIGINT AS formatted_chars,
  count(*) FILTER (opens) AS n_blocks
FROM pieces GROUP BY conv_id
"""

_STOPS = ", ".join(f"'{w}'" for w in rules.STOP_FORMS)
SQL_RULES = f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS body,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM split
), spans AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 4], ' ')) AS n FROM grams
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM spans WHERE n > 1) GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    len(list_filter(words, lambda w: w IN ({_STOPS}))) AS n_stop_words,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN repeats USING (doc_id)
), failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2 AND 14 AND n_symbols / word_chars <= 0.1
  AND n_stop_words / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.3 AND n_words / n_lines >= 2 AS kept
FROM failed
"""


def queries():
    named = (
        op1_chat_format, op2_secret_scan, op3_benchmark_decontamination, op4_byte_bpe, op5_language_id,
        op6_quality_rules, op7_token_counts, op8_ngram_jaccard_join, op9_quality_classifier, op10_substring_dedup,
        op11_periodic_runs, op12_embedding_near_dedup, op13_conversation_repair,
    )
    return {f.__name__: f for f in named}


def oracle_sql():
    return {"op1_chat_format": SQL_CHAT, "op6_quality_rules": SQL_RULES}
