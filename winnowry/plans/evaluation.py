"""Evaluation of responses and rollups of the results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.functions import evaluation as ev
from winnowry.operators import evaluating
from winnowry.plans import oracle as o
from winnowry.plans.registry import query, r6
from winnowry.session import scratch
from winnowry.sources import tables

_MATCH = ("len(list_filter(keywords, lambda k: contains(lower(response), lower(k)))) >= len(keywords) // 2")


@query("j6_p40_instruction_checks", f"""
WITH {o.TASKS}, c AS (SELECT pos, {_MATCH} AS keyword_match, length(response) BETWEEN 20 AND 2000 AS length_ok FROM answers)
SELECT pos, keyword_match, length_ok, keyword_match AND length_ok AS passed FROM c""")
def instruction_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluating.check_instructions(tables.eval_responses(spark, sf_dir), tables.eval_tasks(spark, sf_dir))
    return out.select("pos", "keyword_match", "length_ok", "passed")


@query("p38_expected_pattern", f"""
WITH {o.TASKS} SELECT pos, contains(response, expected) AS passed, contains(response, 'def test_') AS has_test FROM answers""")
def expected_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = tables.eval_responses(spark, sf_dir).join(tables.eval_tasks(spark, sf_dir), "task_id")
    return joined.select(
        "pos", ev.pattern_hit(F.col("response"), F.col("expected")).alias("passed"),
        ev.has_test_function(F.col("response")).alias("has_test"))


def _as_code(text: Column) -> Column:
    """Prose bent into lines that carry indents, comments and function names."""
    return F.replace(F.replace(text, F.lit(", "), F.lit("\n    def ")), F.lit(". "), F.lit("\n  # "))


@query("p36_code_metrics", f"""
WITH c AS (SELECT doc_id, replace(replace(text, ', ', chr(10) || '    def '), '. ', chr(10) || '  # ') AS code FROM documents),
l AS (SELECT doc_id, unnest(string_split(code, chr(10))) AS line FROM c),
lines AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE starts_with({o.strip("line")}, '#') OR contains(line, '//')) AS comments
          FROM l GROUP BY doc_id),
ind AS (SELECT doc_id, length(line) - length(regexp_replace(line, '^{o.SPACES}+', '')) AS w FROM l WHERE {o.strip("line")} <> ''),
widths AS (SELECT doc_id, w, count(*) AS k FROM ind WHERE w > 0 GROUP BY doc_id, w),
shares AS (SELECT doc_id, max(k) * 1.0 / sum(k) AS share FROM widths GROUP BY doc_id),
names AS (SELECT doc_id, unnest(regexp_extract_all(code, 'def\\s+([a-zA-Z_][a-zA-Z0-9_]*)', 1)) AS name FROM c),
snake AS (SELECT doc_id, count(*) FILTER (WHERE contains(name, '_') OR (name = lower(name) AND regexp_matches(name, '[a-z]'))) * 1.0 / count(*) AS score
          FROM names GROUP BY doc_id)
SELECT c.doc_id, lines.n AS line_count, CAST(length(code) AS BIGINT) AS char_count, round(comments * 1.0 / lines.n, 6) AS comment_ratio,
       round(coalesce(share, 0.0), 6) AS indentation_consistency, round(coalesce(score, 0.0), 6) AS naming_convention_score
FROM c JOIN lines USING (doc_id) LEFT JOIN shares USING (doc_id) LEFT JOIN snake USING (doc_id)""")
def code_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", _as_code(F.col("text")).alias("code"))
    metrics = ev.code_metrics(F.col("code"))
    rounded = [(r6(c) if n.endswith(("ratio", "consistency", "score")) else c).alias(n) for n, c in metrics.items()]
    return docs.select("doc_id", *rounded)


@query("a9_eval_rollup", f"""
WITH {o.CHECKS}
SELECT round, CASE WHEN grouping(category) = 1 THEN 'overall' ELSE category END AS category, count(*) AS total,
       count(*) FILTER (WHERE passed) AS passed, round(count(*) FILTER (WHERE passed) * 1.0 / count(*), 6) AS pass_rate
FROM checks GROUP BY GROUPING SETS ((round, category), (round))""")
def eval_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluating.rollup_results(tables.eval_checks(spark, sf_dir)).withColumn("pass_rate", r6("pass_rate"))


_RESULTS = o.CHECKS + """,
counts AS (
  SELECT round, count(*) AS n, count(*) FILTER (WHERE passed) AS p,
    count(*) FILTER (WHERE category = 'python') AS python_total, count(*) FILTER (WHERE category = 'python' AND passed) AS python_passed,
    count(*) FILTER (WHERE category = 'cpp') AS cpp_total, count(*) FILTER (WHERE category = 'cpp' AND passed) AS cpp_passed,
    count(*) FILTER (WHERE category = 'instruction') AS instruction_total,
    count(*) FILTER (WHERE category = 'instruction' AND passed) AS instruction_passed
  FROM checks GROUP BY round),
results AS (SELECT *, 'success' AS status, p * 1.0 / n AS overall_score FROM counts)"""


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluating.result_documents(tables.eval_checks(spark, sf_dir))


@query("a9_result_documents", f"""
WITH {_RESULTS}
SELECT round, python_total, python_passed, cpp_total, cpp_passed, instruction_total, instruction_passed, status,
       round(overall_score, 6) AS overall_score,
       round(CASE WHEN python_total > 0 THEN python_passed * 1.0 / python_total ELSE 0.0 END, 6) AS python_pass_rate,
       round(CASE WHEN cpp_total > 0 THEN cpp_passed * 1.0 / cpp_total ELSE 0.0 END, 6) AS cpp_pass_rate,
       round(CASE WHEN instruction_total > 0 THEN instruction_passed * 1.0 / instruction_total ELSE 0.0 END, 6) AS instruction_pass_rate
FROM results""")
def result_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _results(spark, sf_dir)
    return out.withColumns({c: r6(c) for c in out.columns if c.endswith(("score", "rate"))})


_MIXED = _RESULTS + """,
mixed AS (SELECT round, CASE WHEN round % 7 = 0 THEN 'model_not_available' ELSE status END AS status,
                 CASE WHEN round % 7 = 0 THEN 0.0 ELSE overall_score END AS overall_score FROM results)"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.col("round") % 7 == 0
    return _results(spark, sf_dir).select(
        "round", F.when(missing, F.lit("model_not_available")).otherwise(F.col("status")).alias("status"),
        F.when(missing, 0.0).otherwise(F.col("overall_score")).alias("overall_score"))


@query("a10_rounds_summary", f"""
WITH {_MIXED}
SELECT status, count(*) AS rounds, max(round) AS latest_round, round(arg_max(overall_score, round), 6) AS latest_score,
       round(max(overall_score), 6) AS best_score FROM mixed GROUP BY status""")
def rounds_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluating.rounds_summary(_mixed(spark, sf_dir))
    return out.withColumns({"latest_score": r6("latest_score"), "best_score": r6("best_score")})


@query("a10_latest_result", f"""
WITH {_MIXED} SELECT round, status, round(overall_score, 6) AS overall_score FROM mixed ORDER BY round DESC LIMIT 1""")
def latest_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluating.latest_result(_mixed(spark, sf_dir)).withColumn("overall_score", r6("overall_score"))


@query("a12_f9_metric_unpivot", f"""
WITH {_RESULTS},
d AS (SELECT round, CAST(python_total AS DOUBLE) AS python_total, CAST(python_passed AS DOUBLE) AS python_passed,
             CAST(cpp_total AS DOUBLE) AS cpp_total, CAST(cpp_passed AS DOUBLE) AS cpp_passed,
             CAST(instruction_total AS DOUBLE) AS instruction_total, CAST(instruction_passed AS DOUBLE) AS instruction_passed,
             CAST(round(overall_score, 6) AS DOUBLE) AS overall_score FROM results)
SELECT round, metric, value FROM d UNPIVOT (value FOR metric IN (python_total, python_passed, cpp_total, cpp_passed,
       instruction_total, instruction_passed, overall_score))""")
def metric_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _results(spark, sf_dir).drop("python_pass_rate", "cpp_pass_rate", "instruction_pass_rate")
    return evaluating.unpivot_metrics(wide, ["round"]).withColumn("value", r6("value"))


@query("a9_checks_by_category", f"""
WITH {o.TASKS}, c AS (
  SELECT pos % 5 AS round, CASE pos % 3 WHEN 0 THEN 'python' WHEN 1 THEN 'cpp' ELSE 'instruction' END AS category,
    contains(response, expected) AS hit, contains(response, 'def test_') AS has_test,
    {_MATCH} AS keyword_match, length(response) BETWEEN 20 AND 2000 AS length_ok FROM answers)
SELECT round, category, count(*) AS total,
  count(*) FILTER (CASE WHEN category = 'instruction' THEN keyword_match AND length_ok ELSE hit END) AS passed,
  count(*) FILTER (category <> 'instruction' AND has_test) AS has_test,
  count(*) FILTER (category = 'instruction' AND keyword_match) AS keyword_match,
  count(*) FILTER (category = 'instruction' AND length_ok) AS length_appropriate
FROM c GROUP BY 1, 2""")
def checks_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses joined to their tasks, checked by category, counted per round, written by round and read back."""
    joined = tables.eval_responses(spark, sf_dir).join(tables.eval_tasks(spark, sf_dir), "task_id")
    category = tables.pick(evaluating.CATEGORIES, F.col("pos") % 3)
    counts = evaluating.check_counts(joined.withColumns({"round": F.col("pos") % 5, "category": category}))
    path = scratch(spark, "checks")
    counts.write.partitionBy("round").parquet(path)
    return spark.read.parquet(path).withColumn("round", F.col("round").cast("bigint")).select(counts.columns)
