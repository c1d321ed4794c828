"""Normalize, deduplicate, judge, balance and summarize samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.config import CleanRules
from winnowry.functions import languages, scoring, text
from winnowry.operators.ranking import first_per_group, top_n_by_threshold

KEY = "content_key"


def normalize_samples(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    fields = {c: text.normalize_text(F.col(c), rules.max_chars) for c in ("instruction", "context", "response")}
    return df.withColumns(fields)


def deduplicate(df: DataFrame, order: list[str]) -> DataFrame:
    """First sample per content key in input order.  Adds the key column."""
    keyed = df.withColumn(KEY, text.content_key(F.col("instruction"), F.col("response")))
    return first_per_group(keyed, [KEY], [F.col(c) for c in order])


def _cheap_reason(rules: CleanRules) -> Column:
    """First failing rule among those that need no scoring."""
    ins, res = F.col("instruction"), F.col("response")
    total = F.length(ins) + F.length(res)
    return (
        F.when(~text.valid_format(ins, res, rules.min_field_chars), F.lit("format"))
        .when(text.is_toxic(res, rules.toxic_words), F.lit("toxic"))
        .when(~total.between(rules.min_chars, rules.max_chars), F.lit("length"))
    )


def judge(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Add response_entropy, detected_language, quality_score and reject_reason.

    Costly scores are computed only for rows the cheap rules let through (others hand no text
    on), and through a one-element ``inline``: filters on the result then stay above it, so no
    score is evaluated a second time inside a pushed-down predicate.
    """
    res = F.col("response")
    alive = F.col("_cheap").isNull()
    scores = F.struct(
        F.when(alive, F.col("_entropy")).alias("response_entropy"),
        F.when(alive, languages.detect_language(res, rules.language_patterns)).alias("detected_language"),
    )
    cheap = F.inline(F.array(F.struct(_cheap_reason(rules).alias("_cheap"))))
    base = df.withColumnRenamed("quality_score", "_base").select("*", cheap)
    measured = base.withColumn("_entropy", text.char_entropy(F.when(alive, res)))
    scored = measured.select("*", F.inline(F.array(scores))).drop("_entropy")
    quality = scoring.quality_score(
        F.col("_base"), F.col("instruction"), F.col("context"), res,
        F.col("response_entropy"), F.col("detected_language"),
    )
    with_quality = scored.withColumn("quality_score", F.when(alive, quality))
    late = F.when(F.col("quality_score") < rules.min_quality, F.lit("quality")).when(
        F.col("response_entropy") < rules.min_entropy, F.lit("entropy"))
    return with_quality.withColumn("reject_reason", F.coalesce(F.col("_cheap"), late)).drop("_cheap", "_base")


def keep_good(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def filter_samples(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    return keep_good(judge(df, rules))


def balance_by_language(df: DataFrame, order: list[str], rules: CleanRules = CleanRules()) -> DataFrame:
    """Best samples of each detected language, ties by input order."""
    return top_n_by_threshold(df, "detected_language", "quality_score", order, rules.max_per_language)


def sort_by_quality(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(F.col("quality_score").desc(), *order)


def cleaning_stats(df: DataFrame) -> DataFrame:
    """One row: count, mean quality, language counts, mean response length.

    Rolls up per language first; the second step sees one row per language.
    """
    language = F.coalesce(F.col("detected_language"), F.lit("unknown"))
    per_language = df.groupBy(language.alias("language")).agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce(F.col("quality_score"), F.lit(0.0))).alias("quality"),
        F.sum(F.length(F.coalesce(F.col("response"), F.lit("")))).alias("chars"),
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_language.agg(
        total.alias("total_samples"),
        F.when(total > 0, F.sum("quality") / total).otherwise(F.lit(0.0)).alias("avg_quality_score"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("language", "n")))).alias("language_distribution"),
        F.when(total > 0, F.sum("chars") / total).otherwise(F.lit(0.0)).alias("avg_response_length"),
    )


def stage_funnel(loaded: DataFrame, judged: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Row counts after load, dedupe, filter and balance.

    The balanced count is the sum of capped language counts, so no row is ranked for it.
    ``loaded`` is only counted, which lets the scan read no column of it.
    """
    per_language = judged.groupBy("detected_language").agg(
        F.count("*").alias("deduped"), F.count_if(F.col("reject_reason").isNull()).alias("kept"))
    counts = per_language.agg(
        F.sum("deduped").alias("deduped"), F.sum("kept").alias("filtered"),
        F.sum(F.least(F.col("kept"), F.lit(rules.max_per_language))).alias("balanced"),
    )
    rows = counts.unpivot([], ["deduped", "filtered", "balanced"], "stage", "rows")
    return loaded.agg(F.count("*").alias("rows")).select(F.lit("loaded").alias("stage"), "rows").unionByName(
        rows.select("stage", F.coalesce("rows", F.lit(0)).alias("rows")))


def rejection_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


def cleaning_counters(normalized: DataFrame, judged: DataFrame) -> DataFrame:
    """Counter view of a cleaning run: written, rejected by schema, secret or dedupe, validated.

    A sample counts once: schema before secret, secret before the remaining rules.
    """
    secret = F.size(text.secret_hits(F.col("response"))) > 0
    unique = judged.agg(
        F.count("*").alias("unique_rows"),
        F.count_if(F.col("reject_reason") == "format").alias("rejected_schema"),
        F.count_if(F.coalesce(F.col("reject_reason") != "format", F.lit(True)) & secret).alias("rejected_secret"),
        F.count_if(F.col("reject_reason").isNull() & ~secret).alias("validated_ok"),
    )
    written = normalized.agg(F.count("*").alias("raw_written"))
    both = written.unionByName(unique, allowMissingColumns=True)
    total = both.agg(*[F.max(c).alias(c) for c in both.columns])
    wide = total.withColumn("rejected_dedupe", F.col("raw_written") - F.col("unique_rows")).drop("unique_rows")
    return wide.unpivot([], wide.columns, "counter", "value")
