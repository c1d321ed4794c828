"""Streams driven to completion over table-derived files, each with the SQL of its batch twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.operators import folds, pricing
from winnowry.plans import oracle as o
from winnowry.plans.registry import query, r6
from winnowry.plans.telemetry import _DELTAS, _FOLDED, _price_values, fv
from winnowry.session import scratch
from winnowry.sources import byte_tail, tables, writers
from winnowry.streaming import rates, state, tail, versions

DELTA_SCHEMA = "run_id bigint, pos bigint, model string, counters_delta map<string,double>, usage_delta map<string,double>"
FILES_PER_BATCH = 8


def finish(writer, checkpoint: str) -> None:
    tail.start(writer, checkpoint).awaitTermination()


def in_drops(df: DataFrame, path: str, catch_up: Callable[[], None], time: str = "ts") -> None:
    """Three drops of JSON files of rising time, rows without one first; after each the stream resumes and catches up."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    span = df.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    lo, hi = span["lo"] or 0, span["hi"] or 0
    first, second = lo + (hi - lo) // 3, lo + (hi - lo) * 2 // 3
    for part in (at.isNull() | (at <= first), (at > first) & (at <= second), at > second):
        df.filter(part).write.mode("append").json(path)
        catch_up()


@query("t1_event_tail", f"""
WITH {o.EVENTS} SELECT pos, run_id, event_type, level, message FROM ev""")
def event_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving as files with broken lines among them."""
    session, root = tail.stream_session(spark), scratch(spark, "t1")
    ev = tables.events(spark, sf_dir).select("pos", F.col("run_id"), "event_type", "level", "message", "ts")
    lines = ev.select(F.explode(F.array(F.to_json(F.struct("pos", "run_id", "event_type", "level", "message")),
                                        F.lit('{"pos": '))).alias("value"))
    lines.write.text(f"{root}/in")
    schema = "pos bigint, run_id bigint, event_type string, level string, message string"
    stream = tail.json_stream(session, f"{root}/in", schema, FILES_PER_BATCH)
    finish(tail.append_files(stream, f"{root}/out", "parquet"), f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


LOGS = 64  # files that the events are dealt over


def grown_logs(lines: DataFrame, root: str, catch_up: Callable[[], None]) -> None:
    """Log files of (file, at, line) in three states, with the stream resumed after each.

    The first third of the lines; then files have grown by the second; then every other file has grown
    again, and the rest begin anew with the last third alone.
    """
    span = lines.agg(F.min("at").alias("lo"), F.max("at").alias("hi")).first()
    lo, hi = span["lo"] or 0, span["hi"] or 0
    first, second = lo + (hi - lo) // 3, lo + (hi - lo) * 2 // 3
    replaced = F.crc32(F.col("file").cast("binary")) % 2 == 1
    for part in (F.col("at") <= first, F.col("at") <= second, ~replaced | (F.col("at") > second)):
        writers.write_log_files(lines.filter(part), root).write.format("noop").mode("overwrite").save()
        catch_up()


def log_file(key: Column) -> Column:
    """One of LOGS file names."""
    return F.concat(F.lit("log-"), (key % LOGS).cast("string"), F.lit(".log"))


@query("t1_grown_events", f"""
WITH {o.EVENTS} SELECT pos, run_id, event_type, level, message FROM ev""")
def grown_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to growing logs with broken lines among them; some logs are cut short on the way."""
    session, root = tail.stream_session(spark), scratch(spark, "t1g")
    ev = tables.events(spark, sf_dir).select("pos", "run_id", "event_type", "level", "message")
    lines = ev.select(log_file(F.col("run_id")).alias("file"), F.col("pos").alias("at"), F.explode(F.array(
        F.lit('{"pos": '), F.lit("  "), F.to_json(F.struct("pos", "run_id", "event_type", "level", "message")))).alias("line"))
    schema = "pos bigint, run_id bigint, event_type string, level string, message string"

    def catch_up() -> None:
        stream = tail.growing_json(session, f"{root}/in", schema, ".log").drop("file", "start")
        finish(tail.append_files(stream, f"{root}/out", "parquet"), f"{root}/checkpoint")

    grown_logs(lines, f"{root}/in", catch_up)
    return spark.read.parquet(f"{root}/out")


@query("t2_line_tail", """
SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') || ' ' || event_type AS line FROM events ORDER BY event_id DESC LIMIT 20""")
def line_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last twenty lines over all growing and replaced logs; lines start with a sortable number."""
    session, root = tail.stream_session(spark), scratch(spark, "t2")
    number = F.lpad(F.col("event_id").cast("string"), 12, "0")
    lines = tables.table(spark, sf_dir, "events").select(
        log_file(F.col("user_id")).alias("file"), F.col("event_id").alias("at"), F.concat(number, F.lit(" "), F.col("event_type")).alias("line"))

    def catch_up() -> None:
        stream = tail.growing_text(session, f"{root}/in", ".log")
        finish(tail.keep_last_lines(stream, f"{root}/out", ("arrived", "line")), f"{root}/checkpoint")

    grown_logs(lines, f"{root}/in", catch_up)
    return tail.read_last_lines(spark, f"{root}/out").select("line")


@query("k3_tail_bytes", f"""
WITH l AS (SELECT user_id % {LOGS} AS log, event_id AS pos, lpad(CAST(event_id AS VARCHAR), 12, '0') || ' ' || props AS line FROM events),
b AS (SELECT *, sum(strlen(line) + 1) OVER (PARTITION BY log ORDER BY pos DESC) AS to_end,
             sum(strlen(line) + 1) OVER (PARTITION BY log) AS size, row_number() OVER (PARTITION BY log ORDER BY pos DESC) AS rn FROM l)
SELECT 'log-' || log || '.log' AS file, line FROM b WHERE rn <= 25 AND (to_end < 512 OR size <= 512)""")
def tail_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 25 lines of every log, from no more than 512 bytes of its end."""
    root = scratch(spark, "k3")
    number = F.lpad(F.col("event_id").cast("string"), 12, "0")
    lines = tables.table(spark, sf_dir, "events").select(
        log_file(F.col("user_id")).alias("file"), F.col("event_id").alias("at"), F.concat(number, F.lit(" "), F.col("props")).alias("line"))
    writers.write_log_files(lines, root).write.format("noop").mode("overwrite").save()
    return byte_tail.last_lines(spark, root, 25, 512, ".log").select(F.substring_index("file", "/", -1).alias("file"), "line")


_UPDATE_SCHEMA = "run_id bigint, pos bigint, seq bigint, ts timestamp_ntz"


@query("t3_sequence_upsert", f"""
WITH {o.UPDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq DESC, pos) AS rn FROM updates)
SELECT run_id, seq, pos FROM r WHERE rn = 1""")
def sequence_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, root = tail.stream_session(spark), scratch(spark, "t3")

    def catch_up() -> None:
        stream = tail.json_stream(session, f"{root}/in", _UPDATE_SCHEMA)
        finish(versions.write_versions(state.newest_by_sequence(stream, []), f"{root}/out", ["run_id"]), f"{root}/checkpoint")

    in_drops(tables.sequence_updates(spark, sf_dir), f"{root}/in", catch_up)
    return versions.read_versions(spark, f"{root}/out", ["run_id"]).select("run_id", "seq", "pos")


_REPORTED_SCHEMA = f"{_UPDATE_SCHEMA}, reported_run_id bigint"


@query("t4_restart_flags", f"""
WITH RECURSIVE {o.REPORTED}
SELECT run_id, pos, seq, restarted, accepted, NOT accepted AND NOT own AS mismatch,
       own AND coalesce(NOT accepted AND ts > last_ts_before + INTERVAL {fv.STALE_SECONDS} SECONDS, false) AS stale
FROM walk""")
def restart_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restart, stale and mismatch flags; every eleventh update is reported by another run."""
    session, root = tail.stream_session(spark), scratch(spark, "t4")

    def catch_up() -> None:
        stream = tail.json_stream(session, f"{root}/in", _REPORTED_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
        finish(state.write_flags(stream, f"{root}/out"), f"{root}/checkpoint")

    updates = tables.sequence_updates(spark, sf_dir).withColumn(
        "reported_run_id", F.when(F.col("pos") % 11 == 0, F.col("run_id") + 1).otherwise(F.col("run_id")))
    in_drops(updates, f"{root}/in", catch_up)
    return versions.read_versions(spark, f"{root}/out/flags", None)


def _deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.events(spark, sf_dir).select("run_id", "pos", "model", "counters_delta", "usage_delta", "ts")


@query("t5_counter_fold", f"WITH {_DELTAS} {_FOLDED}")
def counter_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, root = tail.stream_session(spark), scratch(spark, "t5c")

    def catch_up() -> None:
        stream = tail.json_stream(session, f"{root}/in", DELTA_SCHEMA)
        finish(versions.write_versions(state.fold_counters(stream), f"{root}/out", ["run_id", "counter"]), f"{root}/checkpoint")

    in_drops(_deltas(spark, sf_dir), f"{root}/in", catch_up)
    return versions.read_versions(spark, f"{root}/out", ["run_id", "counter"]).withColumn("value", r6("value"))


@query("t5_usage_fold", f"""
WITH {o.EVENTS},
u AS (SELECT run_id, sum(k) * 10.0 AS input_tokens, sum(k) * 1.0 AS output_tokens,
             arg_max(model, pos) FILTER (WHERE model IS NOT NULL) AS model FROM ev GROUP BY run_id)
SELECT run_id, CAST(input_tokens AS DOUBLE) AS input_tokens, CAST(output_tokens AS DOUBLE) AS output_tokens, u.model,
       round(coalesce(input_tokens / unit * pin + output_tokens / unit * pout, 0.0), 9) AS estimated_cost_usd
FROM u LEFT JOIN {_price_values(fv.PRICES_PER_MILLION)} ON p.model = u.model""")
def usage_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, root = tail.stream_session(spark), scratch(spark, "t5u")

    def catch_up() -> None:
        stream = tail.json_stream(session, f"{root}/in", DELTA_SCHEMA)
        costed = folds.fold_usage(stream, pricing.price_table(session))
        finish(versions.write_versions(costed, f"{root}/out", ["run_id"]), f"{root}/checkpoint")

    in_drops(_deltas(spark, sf_dir), f"{root}/in", catch_up)
    return versions.read_versions(spark, f"{root}/out", ["run_id"]).select(
        "run_id", "input_tokens", "output_tokens", "model", F.round("estimated_cost_usd", 9).alias("estimated_cost_usd"))


@query("t6_t8_s13_event_sink", f"""
WITH {o.EVENTS}
SELECT pos, run_id, level, message || ' [TOKEN]' AS message, '1.0' AS event_version,
       coalesce(c.c_mktsegment, 'unknown') AS stage
FROM (SELECT * FROM ev) e LEFT JOIN customer c ON c.c_custkey = e.run_id""")
def event_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events prepared in flight and appended as JSON Lines, micro-batch by micro-batch."""
    session, root = tail.stream_session(spark), scratch(spark, "t6")
    raw = tables.events(spark, sf_dir).select(
        F.col("pos").cast("string").alias("ts"), "run_id", "level", F.lit("").alias("stage"), F.lit(None).cast("int").alias("round"),
        F.concat("message", F.lit(" token=" + "s" * 24)).alias("message"), F.array(F.lit("a")).alias("artifact_paths"),
        F.lit("dropped").alias("secret_note"))
    raw.write.json(f"{root}/in")
    schema = ("ts string, run_id bigint, level string, stage string, round int, message string, "
              "artifact_paths array<string>, secret_note string")
    stream = tail.json_stream(session, f"{root}/in", schema, 1)
    states = tables.table(session, sf_dir, "customer").select(
        F.col("c_custkey").alias("run_id"), F.col("c_nationkey").alias("current_round"),
        F.col("c_mktsegment").alias("current_stage"))
    finish(tail.write_prepared(stream, f"{root}/out", states), f"{root}/checkpoint")
    out = spark.read.schema("ts string, run_id bigint, level string, message string, event_version string, stage string").json(f"{root}/out")
    return out.select(F.col("ts").cast("bigint").alias("pos"), "run_id", "level", "message", "event_version", "stage")


@query("t7_report_upsert", """
WITH r AS (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS run_id, o_orderkey AS pos, o_orderstatus AS status FROM orders)
SELECT 'accepted' AS outcome, run_id, max(pos) AS pos, arg_max(status, pos) AS status FROM r WHERE run_id IS NOT NULL GROUP BY run_id
UNION ALL SELECT 'rejected', -1, pos, status FROM r WHERE run_id IS NULL""")
def report_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, root = tail.stream_session(spark), scratch(spark, "t7")
    reports = tables.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("run_id"),
        F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("status"))
    reports.write.json(f"{root}/in")
    schema = "run_id bigint, pos bigint, status string"
    stream = tail.json_stream(session, f"{root}/in", schema, 2)
    finish(state.write_reports(stream, f"{root}/out", f"{root}/rejected", ["status"]), f"{root}/checkpoint")
    accepted = versions.read_versions(spark, f"{root}/out", ["run_id"])
    rejected = versions.read_versions(spark, f"{root}/rejected", None)
    return accepted.select(F.lit("accepted").alias("outcome"), "run_id", "pos", "status").unionByName(
        rejected.select(F.lit("rejected").alias("outcome"), F.lit(-1).cast("bigint").alias("run_id"), "pos", "status"))


_LATE = 15 * 86_400_000_000  # microseconds by which every 97th call arrives later


@query("t9_token_rates", f"""
WITH {o.EVENTS}, a AS (SELECT ts, k * 11 AS tokens, k / 1000.0 AS cost, epoch_us(ts) AS us, epoch_us(ts) + CASE WHEN pos % 97 = 0 THEN {_LATE} ELSE 0 END AS arrived FROM ev),
s AS (SELECT min(arrived) AS lo, max(arrived) AS hi FROM a),
d AS (SELECT a.*, CASE WHEN arrived <= lo + (hi - lo) // 3 THEN 0 WHEN arrived <= lo + (hi - lo) * 2 // 3 THEN 1 ELSE 2 END AS part FROM a, s),
c AS (SELECT part, max(max(us)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock FROM d GROUP BY part),
w AS (SELECT d.*, us // 600000000 * 600000000 AS begun, coalesce((us // 600000000 + 1) * 600000000 <= clock - 1800000000, false) AS late FROM d JOIN c USING (part))
SELECT CASE WHEN late THEN 'late' ELSE 'on time' END AS outcome, begun AS window_us, count(*) AS calls, CAST(sum(tokens) AS BIGINT) AS tokens,
       round(sum(cost), 6) AS cost_usd FROM w GROUP BY ALL""")
def token_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and cost per ten minutes of event time; every 97th call arrives half a month late."""
    session, root = tail.stream_session(spark), scratch(spark, "t9")
    calls = tables.events(spark, sf_dir).select(
        "ts", (F.col("k") * 11).alias("tokens"), (F.col("k") / 1000).alias("cost_usd"),
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.when(F.col("pos") % 97 == 0, _LATE).otherwise(0)).alias("arrived"))

    def catch_up() -> None:
        stream = tail.json_stream(session, f"{root}/in", "ts timestamp_ntz, tokens bigint, cost_usd double")
        finish(rates.write_rates(stream.withColumn("ts", F.col("ts").cast("timestamp")), f"{root}/out"), f"{root}/checkpoint")

    in_drops(calls, f"{root}/in", catch_up, "arrived")
    punctual = rates.window_sums(versions.read_versions(spark, f"{root}/out/sums", None))
    late = versions.read_versions(spark, f"{root}/out/late", None).withColumns({"calls": F.lit(1).cast("bigint")})
    both = punctual.withColumn("outcome", F.lit("on time")).unionByName(rates.window_sums(late).withColumn("outcome", F.lit("late")))
    return both.select("outcome", F.unix_micros("window_start").alias("window_us"), "calls", "tokens", r6("cost_usd").alias("cost_usd"))
