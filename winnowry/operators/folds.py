"""Counters, usage and state folded from streams of deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.operators.pricing import add_cost, rule_cost


def usage_rollup(calls: DataFrame, cost: Column | None = None) -> DataFrame:
    """Requests, tokens and spend per provider and model; tokens and spend of successes only."""
    ok = F.col("success")
    spend = cost if cost is not None else rule_cost(
        F.col("model"), F.col("prompt_tokens"), F.col("completion_tokens"))
    return calls.groupBy("provider", "model").agg(
        F.count("*").alias("request_count"),
        F.count_if(ok).alias("successful_requests"),
        F.count_if(~ok).alias("failed_requests"),
        F.sum(F.when(ok, F.col("prompt_tokens")).otherwise(0)).alias("prompt_tokens"),
        F.sum(F.when(ok, F.col("completion_tokens")).otherwise(0)).alias("completion_tokens"),
        F.sum(F.when(ok, F.col("prompt_tokens") + F.col("completion_tokens")).otherwise(0)).alias("total_tokens"),
        F.sum(F.when(ok, spend).otherwise(0.0)).alias("spend_usd"),
    )


def fold_deltas(events: DataFrame, deltas: str = "counters_delta", key: str = "run_id", pos: str = "pos",
                last_value: tuple = fv.LAST_VALUE_COUNTERS) -> DataFrame:
    """(run, counter, value): sums of deltas, but the newest value of last-value counters."""
    long = events.select(key, pos, F.explode(deltas).alias("counter", "delta"))
    newest = F.max_by("delta", pos)
    return long.groupBy(key, "counter").agg(
        F.when(F.col("counter").isin(*last_value), newest).otherwise(F.sum("delta")).alias("value")
    )


def as_map(folded: DataFrame, key: str = "run_id", name: str = "counter", value: str = "value",
           out: str = "counters") -> DataFrame:
    """One map per run.  Entries per run are as many as there are distinct counters."""
    return folded.groupBy(key).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, value)))).alias(out))


def fold_usage(events: DataFrame, prices: DataFrame, key: str = "run_id", pos: str = "pos") -> DataFrame:
    """Cumulative usage per run, costed at the price of the run's last named model."""
    usage = F.col("usage_delta")

    def total(name: str) -> Column:
        return F.sum(F.coalesce(F.try_element_at(usage, F.lit(name)), F.lit(0.0)))

    folded = events.groupBy(key).agg(
        *[total(n).alias(n) for n in fv.USAGE_NAMES if n != "estimated_cost_usd"],
        F.max_by("model", F.when(F.col("model").isNotNull(), F.col(pos))).alias("model"),
    )
    return add_cost(folded, prices, "input_tokens", "output_tokens", out="estimated_cost_usd")


def upsert_state(stored: DataFrame, updates: DataFrame, fields: list[str], key: str = "run_id",
                 pos: str = "pos") -> DataFrame:
    """Shallow-merge updates over stored rows in ``pos`` order: the newest non-null value of
    each field wins; sequence_number grows by the number of updates."""
    newest = updates.groupBy(key).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(pos))).alias(f"_{f}") for f in fields],
        F.count("*").alias("_updates"), F.max("updated_at").alias("_updated_at"),
    )
    merged = stored.join(newest, key, "full_outer")
    return merged.select(
        key, *[F.coalesce(F.col(f"_{f}"), F.col(f)).alias(f) for f in fields],
        F.coalesce("_updated_at", "updated_at").alias("updated_at"),
        (F.coalesce("sequence_number", F.lit(0)) + F.coalesce("_updates", F.lit(0))).alias("sequence_number"),
    )


def merge_maps(df: DataFrame, key: str, entries: str, rank: str, name: str = "key", value: str = "value") -> DataFrame:
    """Shallow merge of maps per key as (key, name, value) rows; the highest rank wins."""
    long = df.select(key, rank, F.explode(entries).alias(name, value))
    return long.groupBy(key, name).agg(F.max_by(value, rank).alias(value))
