"""Log analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.functions import logs as fl
from winnowry.functions import status as st
from winnowry.operators import loglines, runs
from winnowry.plans.registry import query, r6
from winnowry.sources import tables

_K = "CAST(json_extract(props, '$.k') AS BIGINT)"
_LINES = f"""
base AS (SELECT user_id AS source, event_id AS pos, event_type, {_K} AS k FROM events),
lines AS (
  SELECT *, event_id_mod AS step, CASE WHEN k % 2 = 0 THEN 500 ELSE 2000 END AS total,
    CASE event_type
      WHEN 'click' THEN ' 10%|#         | ' || event_id_mod || '/' || CASE WHEN k % 2 = 0 THEN 500 ELSE 2000 END
           || ' [04:21<35:18,  0.' || lpad(CAST(k AS VARCHAR), 2, '0') || 's/it]'
      WHEN 'view' THEN '{{''loss'': ''0.' || lpad(CAST(k AS VARCHAR), 2, '0') || ''', ''learning_rate'': ''2e-0' || (k % 9 + 1) || '''}}'
      WHEN 'purchase' THEN 'INFO Round ' || (k % 10) || '/10 Step ' || event_id_mod || '/' || CASE WHEN k % 2 = 0 THEN 500 ELSE 2000 END
      WHEN 'error' THEN 'ERROR worker failed with code ' || k
      ELSE 'warning: trainable params: 1,' || lpad(CAST(k AS VARCHAR), 3, '0') || ',000 || all params: 7,'
           || lpad(CAST(k AS VARCHAR), 3, '0') || ',000' END AS line
  FROM (SELECT *, pos % 500 AS event_id_mod FROM base)
)"""
_SEVERITY = ("CASE WHEN contains(upper(line), 'ERROR') THEN 'ERROR' WHEN contains(upper(line), 'WARNING') THEN 'WARNING' "
             "WHEN contains(upper(line), 'INFO') THEN 'INFO' WHEN contains(upper(line), 'DEBUG') THEN 'DEBUG' ELSE 'OTHER' END")


def _tail(n: int, table: str = "lines") -> str:
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY pos DESC) AS rn FROM {table}),
recent AS (SELECT * FROM ranked WHERE rn <= {n})"""


@query("p29_severity_counts", f"WITH {_LINES} SELECT source, {_SEVERITY} AS severity, count(*) AS lines FROM lines GROUP BY 1, 2")
def severity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.training_log(spark, sf_dir)
    return lines.groupBy("source", fl.severity(F.col("line")).alias("severity")).agg(F.count("*").alias("lines"))


@query("f8_level_filter", f"WITH {_LINES} SELECT source, pos, line FROM lines WHERE {_SEVERITY} = 'WARNING'")
def level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.training_log(spark, sf_dir).filter(fl.severity(F.col("line")) == "WARNING")


@query("p30_log_metrics", f"""
WITH {_LINES}
SELECT source, pos,
  CAST(CASE WHEN event_type = 'click' THEN step ELSE -1 END AS BIGINT) AS bar_step,
  CAST(CASE WHEN event_type = 'click' THEN total ELSE -1 END AS BIGINT) AS bar_total,
  CASE WHEN event_type = 'click' THEN k / 100.0 ELSE -1.0 END AS sec_per_it,
  CAST(CASE WHEN event_type = 'purchase' THEN k % 10 ELSE -1 END AS BIGINT) AS round,
  CAST(CASE WHEN event_type = 'purchase' THEN 10 ELSE -1 END AS BIGINT) AS rounds,
  CAST(CASE WHEN event_type = 'purchase' THEN step ELSE -1 END AS BIGINT) AS step,
  CAST(CASE WHEN event_type = 'purchase' THEN total ELSE -1 END AS BIGINT) AS steps,
  CASE WHEN event_type = 'view' THEN k / 100.0 ELSE -1.0 END AS loss,
  CASE WHEN event_type = 'view' THEN CAST('2e-0' || (k % 9 + 1) AS DOUBLE) ELSE -1.0 END AS learning_rate,
  CAST(CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'error') THEN 1000000 + k * 1000 ELSE -1 END AS BIGINT) AS trainable_params,
  CAST(CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'error') THEN 7000000 + k * 1000 ELSE -1 END AS BIGINT) AS total_params
FROM lines""")
def log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = loglines.with_training_metrics(tables.training_log(spark, sf_dir)).drop("line")
    return m.na.fill(-1)


@query("f7_training_lines", f"""
WITH {_LINES}, planted AS (
  SELECT source, pos, event_type, CASE WHEN source % 7 = 0 AND event_type IN ('click', 'view', 'purchase') THEN 'waiting ' || pos ELSE line END AS line
  FROM lines), {_tail(25, "planted")},
h AS (SELECT *, source % 7 <> 0 AND event_type IN ('click', 'view', 'purchase') AS hit FROM recent),
a AS (SELECT *, max(CAST(hit AS INTEGER)) OVER (PARTITION BY source) AS any_hit FROM h)
SELECT source, pos, line FROM a WHERE hit OR any_hit = 0""")
def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 25 lines of each source; every seventh source has no training line and keeps them all."""
    lines = tables.training_log(spark, sf_dir)
    other = F.col("line").startswith("ERROR") | F.col("line").startswith("warning")
    planted = lines.withColumn("line", F.when((F.col("source") % 7 != 0) | other, F.col("line")).otherwise(
        F.concat(F.lit("waiting "), F.col("pos").cast("string"))))
    return loglines.training_lines(loglines.tail(planted, 25, ["source"]))


@query("k3_tail_lines", f"WITH {_LINES} SELECT source, pos, line FROM lines ORDER BY pos DESC LIMIT 300")
def tail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loglines.tail(tables.training_log(spark, sf_dir), 300)


@query("k3_tail_per_source", f"WITH {_LINES}, {_tail(25)} SELECT source, pos, line FROM recent")
def tail_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loglines.tail(tables.training_log(spark, sf_dir), 25, ["source"])


@query("w4_progress_pick", f"""
WITH {_LINES}, {_tail(100)},
bars AS (SELECT *, [500, 999, 0][source % 3 + 1] AS wanted FROM recent WHERE event_type = 'click'),
picked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY
      CASE WHEN total = wanted THEN 0 ELSE 1 END,
      CASE WHEN total = wanted THEN 0 ELSE -total END,
      CASE WHEN total = wanted OR wanted = 0 THEN -pos ELSE pos END) AS place FROM bars)
SELECT source, CAST(total AS BIGINT) AS total_steps, CAST(step AS BIGINT) AS training_step,
       round(CASE WHEN k > 0 THEN 1.0 / (k / 100.0) ELSE 0.0 END, 6) AS training_speed FROM picked WHERE place = 1""")
def progress_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = loglines.with_training_metrics(loglines.tail(tables.training_log(spark, sf_dir), 100, ["source"]))
    wanted = tables.pick((500, 999, None), F.col("source") % 3)
    out = loglines.pick_progress(recent.withColumn("configured_total", wanted))
    return out.withColumn("training_speed", r6("training_speed"))


@query("w6_loss_history", f"""
WITH {_LINES},
l AS (SELECT source, pos, k / 100.0 AS loss, row_number() OVER (PARTITION BY source ORDER BY pos DESC) AS rn,
             first_value(k / 100.0) OVER (PARTITION BY source ORDER BY pos DESC) AS current_loss
      FROM lines WHERE event_type = 'view'),
kept AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY pos) AS i FROM l WHERE rn <= 100)
SELECT source, i - 1 AS i, loss, current_loss FROM kept""")
def loss_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = loglines.loss_history(loglines.with_training_metrics(tables.training_log(spark, sf_dir)))
    return history.select("source", "current_loss", F.posexplode("losses").alias("i", "loss")).withColumn(
        "i", F.col("i").cast("bigint"))


@query("p31_generation_log", f"""
WITH lines AS (SELECT user_id AS source, event_id AS pos, event_type, {_K} AS k FROM events), {_tail(50)}
SELECT source, coalesce(max(CASE WHEN event_type = 'error' THEN 'generating' END), '') AS stage,
  CAST(coalesce(arg_max(k, pos) FILTER (WHERE event_type = 'view'), -1) AS BIGINT) AS generated,
  CAST(coalesce(arg_max(1000 + k, pos) FILTER (WHERE event_type = 'click' AND k % 2 = 0), -1) AS BIGINT) AS prompt_tokens,
  CAST(coalesce(arg_max(k, pos) FILTER (WHERE event_type = 'click' AND k % 2 = 1), -1) AS BIGINT) AS completion_tokens,
  CAST(coalesce(arg_max(2000 + k, pos) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase', 'error')), -1) AS BIGINT) AS total_tokens,
  CAST(coalesce(arg_max(k, pos) FILTER (WHERE event_type = 'purchase'), -1) AS BIGINT) AS requests
FROM recent GROUP BY source""")
def generation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = loglines.tail(tables.generation_log(spark, sf_dir), 50, ["source"])
    metrics = fl.generation_metrics(F.col("line"))
    out = loglines.latest_values(recent.withColumns(metrics), list(metrics))
    return out.na.fill(-1).na.fill("")


@query("p32_parallel_log", f"""
WITH lines AS (SELECT user_id AS source, event_id AS pos, event_type, {_K} AS k FROM events), {_tail(300)},
done AS (SELECT source, max(pos) AS p, arg_max(k * 3, pos) AS n FROM recent WHERE event_type = 'purchase' GROUP BY source),
peak AS (SELECT r.source, max(r.k * 9) AS n FROM recent r LEFT JOIN done d ON d.source = r.source
         WHERE r.event_type = 'click' AND r.pos >= coalesce(d.p, -1) GROUP BY r.source)
SELECT r.source,
  arg_max(CASE event_type WHEN 'click' THEN 'generate' WHEN 'view' THEN 'generate' WHEN 'purchase' THEN 'done'
               WHEN 'error' THEN 'search' ELSE 'scrape' END, pos) AS stage,
  CAST(coalesce(arg_max(k, pos) FILTER (WHERE event_type IN ('click', 'purchase')), 0) AS BIGINT) AS processed_files,
  CAST(coalesce(arg_max(CASE WHEN event_type = 'click' THEN 100 ELSE k END, pos)
       FILTER (WHERE event_type IN ('click', 'view', 'purchase')), 0) AS BIGINT) AS total_files,
  CAST(greatest(coalesce(max(done.n), 0), coalesce(max(peak.n), 0)) AS BIGINT) AS samples_generated
FROM recent r LEFT JOIN done ON done.source = r.source LEFT JOIN peak ON peak.source = r.source GROUP BY r.source""")
def parallel_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = loglines.tail(tables.parallel_log(spark, sf_dir), 300, ["source"])
    return loglines.parallel_progress(recent)


@query("j8_status_from_logs", f"""
WITH {_LINES},
m AS (SELECT source, arg_max(step, pos) FILTER (WHERE event_type = 'purchase') AS step,
             arg_max(total, pos) FILTER (WHERE event_type = 'purchase') AS steps FROM lines GROUP BY source),
j AS (SELECT c_custkey AS run_id, CASE WHEN m.step > 0 THEN m.step ELSE c_nationkey END AS step,
             CASE WHEN m.steps > 0 THEN m.steps ELSE 500 END AS steps FROM customer LEFT JOIN m ON m.source = c_custkey)
SELECT run_id, CAST(step AS BIGINT) AS step, CAST(steps AS BIGINT) AS steps, round(step * 1.0 / steps * 100, 6) AS progress_percent FROM j""")
def status_from_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = loglines.with_training_metrics(tables.training_log(spark, sf_dir))
    derived = loglines.latest_values(metrics, ["step", "steps"]).withColumnRenamed("source", "run_id")
    base = tables.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("run_id"), F.col("c_nationkey").cast("bigint").alias("step"),
        F.lit(500).cast("bigint").alias("steps"))
    out = runs.overlay_positive(base, derived, ["step", "steps"])
    return out.withColumn("progress_percent", r6(st.percent(F.col("step"), F.col("steps"))))
