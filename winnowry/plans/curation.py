"""Cleaning flow: every step as its own query, then the whole of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.config import CleanRules
from winnowry.functions import languages, scoring, text
from winnowry.operators import cleaning, runs, training
from winnowry.plans import oracle as o
from winnowry.plans.registry import query, r6
from winnowry.sources import tables

TIGHT = CleanRules(max_per_language=100)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized samples before any label: a pure projection of the documents."""
    return cleaning.normalize_samples(tables.samples_from_documents(spark, sf_dir, scored=False))


def labelled(samples: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels joined once texts are cut and duplicates gone."""
    labels = tables.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"), F.col("quality").cast("double").alias("label"))
    return samples.join(labels, "pos", "left").withColumn("quality_score", F.coalesce("label", F.lit(0.0))).drop("label")


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.deduplicate(normalized(spark, sf_dir), ["pos"])


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.judge(labelled(deduplicated(spark, sf_dir), spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str, rules: CleanRules = CleanRules()) -> DataFrame:
    """Load, normalize, deduplicate, filter and balance."""
    kept = cleaning.keep_good(judged(spark, sf_dir))
    return cleaning.balance_by_language(kept, ["pos"], rules)


@query("p1_normalize_text", f"""
WITH {o.NORMALIZED}
SELECT pos, instruction, context, md5(response) AS response_md5, CAST(length(response) AS BIGINT) AS response_chars
FROM norm""")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir).select(
        "pos", "instruction", "context", F.md5("response").alias("response_md5"),
        F.length("response").cast("bigint").alias("response_chars"))


@query("p2_char_entropy", f"""
WITH {o.NORMALIZED}, {o.entropy_of("norm")}
SELECT pos, round(entropy, 6) AS entropy FROM entropies""")
def char_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir).select("pos", r6(text.char_entropy(F.col("response"))).alias("entropy"))


@query("a5_char_frequency", f"""
WITH {o.NORMALIZED}
SELECT pos, c AS char, CAST(count(*) AS BIGINT) AS n
FROM (SELECT pos, unnest(string_split(response, '')) AS c FROM norm) GROUP BY pos, c""")
def char_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir).select("pos", F.inline(text.char_counts(F.col("response"))))


@query("p3_detect_language", f"""
WITH {o.NORMALIZED}, {o.languages_of("norm")} SELECT pos, language FROM languages""")
def detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir).select("pos", languages.detect_language(F.col("response")).alias("language"))


@query("p5_toxic_hits", f"""
WITH {o.SAMPLES} SELECT pos, {o.TOXIC} AS toxic FROM samples""")
def toxic_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = tables.samples_from_documents(spark, sf_dir, scored=False)
    return samples.select("pos", text.is_toxic(F.col("response")).alias("toxic"))


@query("p6_format_valid", f"""
WITH {o.PAIRS} SELECT conv_id, turn, {o.VALID} AS valid FROM pairs""")
def format_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = tables.samples_from_conversations(spark, sf_dir)
    return pairs.select("conv_id", "turn", text.valid_format(F.col("instruction"), F.col("response")).alias("valid"))


@query("p7_quality_score", f"""
WITH {o.NORMALIZED}, {o.entropy_of("norm")}, {o.languages_of("norm")}, {o.quality_of("norm")}
SELECT pos, round(quality, 6) AS quality FROM qualities""")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = labelled(normalized(spark, sf_dir), spark, sf_dir)
    res = F.col("response")
    score = scoring.quality_score(
        F.col("quality_score"), F.col("instruction"), F.col("context"), res,
        text.char_entropy(res), languages.detect_language(res))
    return n.select("pos", r6(score).alias("quality"))


@query("p14_content_keys", f"""
WITH {o.NORMALIZED} SELECT pos, sha256(instruction || response) AS content_key FROM norm""")
def content_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir).select(
        "pos", text.content_key(F.col("instruction"), F.col("response")).alias("content_key"))


@query("a1_dedupe_exact", f"""
WITH {o.DEDUPED} SELECT pos, content_key FROM deduped""")
def dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(spark, sf_dir).select("pos", "content_key")


@query("f4_filter_samples", f"""
WITH {o.JUDGED}
SELECT pos, language AS detected_language, round(quality, 6) AS quality_score, round(entropy, 6) AS response_entropy
FROM judged WHERE reject_reason IS NULL""")
def filter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.keep_good(judged(spark, sf_dir))
    return kept.select("pos", "detected_language", r6("quality_score").alias("quality_score"),
                       r6("response_entropy").alias("response_entropy"))


@query("f4_reject_reasons", f"""
WITH {o.JUDGED} SELECT pos, coalesce(reject_reason, 'kept') AS reason FROM judged""")
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select("pos", F.coalesce("reject_reason", F.lit("kept")).alias("reason"))


@query("w1_balance_by_language", f"""
WITH {o.JUDGED}, {o.balanced(100)}
SELECT pos, language AS detected_language, round(quality, 6) AS quality_score FROM balanced""")
def balance_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, TIGHT).select("pos", "detected_language", r6("quality_score").alias("quality_score"))


@query("k1_sort_quality", f"""
WITH {o.JUDGED}, {o.balanced(1000)}
SELECT pos, round(quality, 6) AS quality_score FROM balanced ORDER BY quality DESC, pos""")
def sort_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaned(spark, sf_dir)
    return cleaning.sort_by_quality(kept, ["pos"]).select("pos", r6("quality_score").alias("quality_score"))


@query("a2_clean_stats", f"""
WITH {o.JUDGED}, {o.balanced(1000)},
parts AS (SELECT language, count(*) AS n, sum(quality) AS q, sum(length(response)) AS c FROM balanced GROUP BY language),
total AS (SELECT sum(n) AS n, sum(q) / sum(n) AS q, sum(c) / sum(n) AS c FROM parts)
SELECT p.language, CAST(p.n AS BIGINT) AS language_samples, CAST(t.n AS BIGINT) AS total_samples,
       round(t.q, 6) AS avg_quality_score, round(t.c, 6) AS avg_response_length
FROM parts p CROSS JOIN total t""")
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cleaning.cleaning_stats(cleaned(spark, sf_dir))
    return stats.select(
        F.explode("language_distribution").alias("language", "language_samples"), "total_samples",
        r6("avg_quality_score").alias("avg_quality_score"), r6("avg_response_length").alias("avg_response_length"))


@query("a3_stage_funnel", f"""
WITH {o.JUDGED}, {o.balanced(100)}
SELECT 'loaded' AS stage, count(*) AS rows FROM documents
UNION ALL SELECT 'deduped', count(*) FROM deduped
UNION ALL SELECT 'filtered', count(*) FROM judged WHERE reject_reason IS NULL
UNION ALL SELECT 'balanced', count(*) FROM balanced""")
def stage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = tables.table(spark, sf_dir, "documents")
    return cleaning.stage_funnel(loaded, judged(spark, sf_dir), TIGHT)


@query("a4_reject_counts", f"""
WITH {o.JUDGED}
SELECT coalesce(reject_reason, 'kept') AS reason, count(*) AS rows FROM judged GROUP BY 1""")
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rejection_counts(judged(spark, sf_dir))


_SECRET = "(" + " OR ".join(
    f"regexp_matches(response, {o.quote('(?i)' + p)})" for p, _ in o.fv.SECRET_PATTERNS) + ")"


@query("a4_cleaning_counters", f"""
WITH {o.JUDGED},
flags AS (SELECT reject_reason, {_SECRET} AS secret FROM judged)
SELECT 'raw_written' AS counter, count(*) AS value FROM documents
UNION ALL SELECT 'rejected_dedupe', (SELECT count(*) FROM documents) - (SELECT count(*) FROM judged)
UNION ALL SELECT 'rejected_schema', count(*) FROM flags WHERE reject_reason = 'format'
UNION ALL SELECT 'rejected_secret', count(*) FROM flags WHERE coalesce(reject_reason, '') <> 'format' AND secret
UNION ALL SELECT 'validated_ok', count(*) FROM flags WHERE reject_reason IS NULL AND NOT secret""")
def cleaning_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_counters(tables.table(spark, sf_dir, "documents"), judged(spark, sf_dir))


@query("a13_dataset_info", f"""
WITH {o.JUDGED}, {o.balanced(1000)},
parts AS (SELECT language, count(*) AS n, count(*) FILTER (WHERE pos % 20 <> 0) AS train, max(pos) AS m
          FROM balanced GROUP BY language),
total AS (SELECT sum(n) AS n, sum(train) AS train, max(m) AS m FROM parts)
SELECT p.language, CAST(p.n AS BIGINT) AS language_rows, (SELECT count(*) FROM documents) AS raw_rows,
       CAST(t.n AS BIGINT) AS clean_rows, CAST(t.train AS BIGINT) AS train_rows,
       CAST(t.n - t.train AS BIGINT) AS validation_rows, t.m AS last_updated
FROM parts p CROSS JOIN total t""")
def dataset_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = (F.col("pos") % 20) * 500
    clean = training.split_validation(cleaned(spark, sf_dir), bucket).withColumn("updated_at", F.col("pos"))
    info = runs.dataset_info(tables.table(spark, sf_dir, "documents"), clean)
    return info.select(
        F.explode("languages").alias("language", "language_rows"), "raw_rows", "clean_rows", "train_rows",
        "validation_rows", "last_updated")


@query("p15_sft_text", f"""
WITH {o.PAIRS},
cut AS (SELECT conv_id, turn, {o.strip("instruction")} AS i, {o.strip("context")} AS c, {o.strip("response")} AS r
        FROM pairs),
formatted AS (
  SELECT conv_id, turn, CASE WHEN c <> '' THEN '### Context:' || chr(10) || c || chr(10) || chr(10) ELSE '' END
    || '### Instruction:' || chr(10) || i || chr(10) || chr(10) || '### Response:' || chr(10) || r AS t
  FROM cut WHERE i <> '' AND r <> ''
)
SELECT conv_id, turn, md5(CASE WHEN ends_with(t, '</s>') THEN t ELSE t || '</s>' END) AS text_md5 FROM formatted""")
def sft_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = training.format_training_text(tables.samples_from_conversations(spark, sf_dir))
    return formatted.select("conv_id", "turn", F.md5("text").alias("text_md5"))


@query("f5_nonempty_text", f"""
WITH {o.PAIRS}
SELECT count(*) AS pairs, count(*) FILTER (WHERE {o.strip("instruction")} <> '' AND {o.strip("response")} <> '') AS kept
FROM pairs""")
def nonempty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = tables.samples_from_conversations(spark, sf_dir)
    body = text.sft_text(F.col("instruction"), F.col("context"), F.col("response"))
    return pairs.agg(F.count("*").alias("pairs"), F.count_if(F.length(body) > 0).alias("kept"))


@query("r1_train_val_split", f"""
WITH {o.PAIRS}
SELECT conv_id, turn, CASE WHEN ((conv_id * 31 + turn * 7) % 100) * 100 < 500 THEN 'validation' ELSE 'train' END AS split
FROM pairs""")
def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = ((F.col("conv_id") * 31 + F.col("turn") * 7) % 100) * 100
    pairs = tables.samples_from_conversations(spark, sf_dir)
    return training.split_validation(pairs, bucket).select("conv_id", "turn", "split")


@query("r2_row_count_gate", f"""
WITH {o.JUDGED}, {o.balanced(1000)}
SELECT least(count(*), 200) AS rows_seen, count(*) >= 200 AS passed FROM balanced""")
def row_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.has_at_least(cleaned(spark, sf_dir), 200)


@query("p37_response_extraction", f"""
WITH {o.PAIRS},
t AS (SELECT conv_id, turn, '### Instruction:' || chr(10) || instruction || chr(10) || '### Response:' || chr(10)
             || response || CASE WHEN turn % 2 = 0 THEN '### Response: again' ELSE '' END AS full_text FROM pairs)
SELECT conv_id, turn, md5({o.strip("string_split(full_text, '### Response:')[2]")}) AS answer_md5 FROM t""")
def response_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = tables.samples_from_conversations(spark, sf_dir)
    again = F.when(F.col("turn") % 2 == 0, F.lit("### Response: again")).otherwise(F.lit(""))
    full = F.concat(F.lit("### Instruction:\n"), F.col("instruction"), F.lit("\n### Response:\n"),
                    F.col("response"), again)
    return pairs.select("conv_id", "turn", F.md5(text.extract_response(full)).alias("answer_md5"))
