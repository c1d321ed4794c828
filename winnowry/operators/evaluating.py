"""Responses against tasks, and rollups of the results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.functions import evaluation as ev

CATEGORIES = ("python", "cpp", "instruction")


def check_code(responses: DataFrame, tasks: DataFrame) -> DataFrame:
    """Expected-pattern and syntax checks of code responses, one row per response."""
    joined = responses.join(tasks, "task_id")
    parsed = joined.withColumn("syntax_valid", ev.python_parses(F.col("response")))
    return parsed.withColumns({
        "passed": ev.pattern_hit(F.col("response"), F.col("expected")),
        "runnable": F.col("syntax_valid") & ev.has_test_function(F.col("response")),
    })


def check_counts(answers: DataFrame) -> DataFrame:
    """Totals and passed checks per round and category of responses that carry their task's fields.

    Code passes by its expected pattern, an instruction by its keywords and its length.
    """
    res, told = F.col("response"), F.col("category") == "instruction"
    keyword = ev.keyword_match(res, F.col("keywords"))
    length = ev.length_ok(res, F.col("expected_length")["min"], F.col("expected_length")["max"])
    passed = F.when(told, keyword & length).otherwise(ev.pattern_hit(res, F.col("expected")))
    return answers.groupBy("round", "category").agg(
        F.count("*").alias("total"), F.count_if(passed).alias("passed"),
        F.count_if(~told & ev.has_test_function(res)).alias("has_test"),
        F.count_if(told & keyword).alias("keyword_match"), F.count_if(told & length).alias("length_appropriate"))


def check_instructions(responses: DataFrame, tasks: DataFrame) -> DataFrame:
    """Keyword and length checks of instruction responses, one row per response."""
    joined = responses.join(tasks, "task_id")
    keyword = ev.keyword_match(F.col("response"), F.col("keywords"))
    length = ev.length_ok(F.col("response"), F.col("expected_length")["min"], F.col("expected_length")["max"])
    return joined.withColumns({"keyword_match": keyword, "length_ok": length}).withColumn(
        "passed", F.col("keyword_match") & F.col("length_ok"))


def pass_rate(passed: Column, total: Column) -> Column:
    return F.when(total > 0, passed / total).otherwise(F.lit(0.0))


def rollup_results(checked: DataFrame, flags: tuple = ("passed",)) -> DataFrame:
    """Counts per round and category plus one ``overall`` row per round, in one pass."""
    counts = [F.count_if(F.col(f)).alias(f) for f in flags]
    rolled = checked.rollup("round", "category").agg(
        F.grouping_id().alias("_level"), F.count("*").alias("total"), *counts)
    named = rolled.filter(F.col("_level") < 3).withColumn(
        "category", F.when(F.col("_level") == 1, F.lit("overall")).otherwise(F.col("category")))
    return named.withColumn("pass_rate", pass_rate(F.col("passed"), F.col("total"))).drop("_level")


def result_documents(checked: DataFrame) -> DataFrame:
    """One wide result per round."""
    aggs = []
    for c in CATEGORIES:
        mine = F.col("category") == c
        aggs += [F.count_if(mine).alias(f"{c}_total"), F.count_if(mine & F.col("passed")).alias(f"{c}_passed")]
    wide = checked.filter(F.col("category").isin(*CATEGORIES)).groupBy("round").agg(*aggs)
    total = sum((F.col(f"{c}_total") for c in CATEGORIES), F.lit(0))
    passed = sum((F.col(f"{c}_passed") for c in CATEGORIES), F.lit(0))
    rates = {f"{c}_pass_rate": pass_rate(F.col(f"{c}_passed"), F.col(f"{c}_total")) for c in CATEGORIES}
    return wide.withColumns({"status": F.lit("success"), "overall_score": pass_rate(passed, total), **rates})


def rounds_summary(results: DataFrame) -> DataFrame:
    """Rounds by status, the latest round by number, and the best score."""
    per_status = results.groupBy("status").agg(
        F.count("*").alias("rounds"), F.max(F.struct("round", "overall_score")).alias("_latest"),
        F.max("overall_score").alias("best_score"))
    return per_status.select(
        "status", "rounds", F.col("_latest.round").alias("latest_round"),
        F.col("_latest.overall_score").alias("latest_score"), "best_score")


def latest_result(results: DataFrame) -> DataFrame:
    """The single latest result, by numeric round."""
    return results.orderBy(F.col("round").desc()).limit(1)


def unpivot_metrics(df: DataFrame, ids: list[str], metrics: list[str] | None = None) -> DataFrame:
    """(ids, metric, value) of the numeric columns; other columns are left out."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    names = metrics or [n for n, t in df.dtypes if t in numeric and n not in ids]
    typed = df.select(*ids, *[F.col(n).cast("double").alias(n) for n in names])
    return typed.unpivot(ids, names, "metric", "value")
