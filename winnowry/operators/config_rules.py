"""Run configuration checked against typed rules; every violation is reported."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry import fixed_values as fv


def rule_table(spark: SparkSession, rules: tuple = fv.CONFIG_RULES, required: tuple = ()) -> DataFrame:
    rows = [(k, list(t), lo, hi, list(a) if a else None, k in required) for k, t, lo, hi, a in rules]
    names = ("key", "types", "min", "max", "allowed", "required")
    kinds = (pa.string(), pa.list_(pa.string()), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.bool_())
    columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return spark.createDataFrame(pa.table(columns, names=names))


def violations(configs: DataFrame, rules: DataFrame, key: str = "run_id") -> DataFrame:
    """(run, key, violation) of configs given as (run, key, type, value) rows.

    A wrong type hides the range and value checks of that key, as those need the type.
    """
    joined = configs.join(rules, "key", "left")
    known = F.col("types").isNotNull()
    typed = known & F.array_contains("types", F.col("type"))
    number = F.col("value").try_cast("double")
    checks = F.array_compact(F.array(
        F.when(~known, F.lit("unknown")),
        F.when(known & ~typed, F.lit("type")),
        F.when(typed & (number < F.col("min")), F.lit("too small")),
        F.when(typed & (number > F.col("max")), F.lit("too large")),
        F.when(typed & F.col("allowed").isNotNull() & ~F.array_contains("allowed", F.col("value")), F.lit("not allowed")),
    ))
    found = joined.select(key, "key", F.explode(checks).alias("violation"))
    return found.unionByName(missing_required(configs, rules, key))


def missing_required(configs: DataFrame, rules: DataFrame, key: str = "run_id") -> DataFrame:
    """Required keys a run does not set."""
    needed = rules.filter("required").select("key")
    wanted = needed.agg(F.collect_set("key")).scalar()
    have = configs.join(needed, "key", "left_semi")
    runs = configs.select(key).distinct().join(
        have.groupBy(key).agg(F.collect_set("key").alias("_have")), key, "left")
    nothing = F.array().cast("array<string>")
    absent = F.array_except(wanted, F.coalesce("_have", nothing))
    return runs.select(key, F.explode(absent).alias("key"), F.lit("missing").alias("violation"))
