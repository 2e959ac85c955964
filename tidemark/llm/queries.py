"""The text operators applied to whole tables, and their SQL where SQL can say it.

Each query gets its rows from its operator and derives from them the columns
that are compared: digests, counts and numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    decontaminate,
    exact_dedup,
    language,
    pieces,
    quality,
    runs,
    sharding,
    simhash,
    substrings,
    tokens,
    toxicity,
    warc,
)
from tidemark.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts ahead of and after personal data and secrets are redacted."""
    counted = tokens.count_tokens(_table(spark, sf_dir, "documents"))
    return tokens.apply_edits(tokens.with_redactions(counted)).select(
        "doc_id",
        "tokens_before",
        "n_edits",
        "n_tokens",
        "encoded_chars",
        F.sha2("text", 256).alias("text_sha256"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(_table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id",
        F.size("ids").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        "chunks",
        "intact",
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.classify(docs, labels).withColumn("kept", ~F.col("rejected"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    contents = language.dictionaries(docs.where(~F.col("held_out")))
    found = language.identify(docs.select("doc_id", "text"), contents)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_counts(_table(spark, sf_dir, "documents"))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where in a tenth of the documents the words from some
    place on repeat with a period that the document's number gives."""
    number = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(number % 10 == 0, F.lit(False))
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    size = F.size("words").cast("bigint")
    listed = (
        docs.select("doc_id", "text", words.alias("words"), F.floor(number / 10).alias("g"))
        .withColumn("a", F.when(size > 0, F.col("g") % size))
        .withColumn("p", 1 + F.floor((size - F.col("a")) / (3 + F.col("g") % 8)))
    )
    at = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    planted = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get(F.col("words"), at(i))).otherwise(w))
    return listed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_period(_table(spark, sf_dir, "documents")))
    return found.withColumn("best", runs.longest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        runs.digest_of_runs(F.col("runs")).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = toxicity.classify(docs, labels, ~toxicity.held_out())
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "vote", "evidence")


_QUERIES = (
    op1_token_counts,
    op2_sentencepiece,
    op3_quality,
    op4_simhash_dedup,
    op5_language_id,
    op6_substring_dedup,
    op7_exact_dedup,
    op8_sharding,
    op9_warc,
    op10_decontamination,
    op11_alignment,
    op12_periodic_runs,
    op13_toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# Words and windows of the substring query; a window's place in the corpus is
# its document and its first word.
_WINDOWS = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS content
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS start FROM texts)),
repeats AS (
  SELECT doc_id, start FROM windows
  QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, start) > 1),
removed AS (
  SELECT DISTINCT doc_id, start + unnest(generate_series(0, 19)) AS place FROM repeats),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS content, count(*) AS n
  FROM placed ANTI JOIN removed USING (doc_id, place) GROUP BY doc_id)
SELECT t.doc_id, len(t.words) AS n_words, len(t.words) - coalesce(k.n, 0) AS n_removed,
       sha256(coalesce(k.content, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)"""

_WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
largest AS (SELECT payload, max(page_id) AS last_id FROM payloads GROUP BY payload)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM payloads JOIN largest USING (payload)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_substring_dedup": _WINDOWS,
        "op9_warc": _WARC,
        "op7_exact_dedup": f"""
WITH folded AS (SELECT doc_id, {_FOLDED} AS content FROM documents),
classes AS (SELECT content, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY content)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM folded JOIN classes USING (content)""",
    }
