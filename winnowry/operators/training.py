"""Training text, validation split and size gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.functions import text

BUCKETS = 10_000


def format_training_text(df: DataFrame, eos: str = fv.EOS_TOKEN) -> DataFrame:
    """Add ``text`` and drop samples that yield none."""
    body = text.sft_text(F.col("instruction"), F.col("context"), F.col("response"), eos)
    return df.withColumn("text", body).filter(F.length("text") > 0)


def split_validation(df: DataFrame, bucket: Column, fraction: float = fv.VALIDATION_FRACTION) -> DataFrame:
    """Add ``split``.  ``bucket`` is an integer in [0, 10000) derived from the row's identity,
    so the split survives retries and re-runs; fraction 0 means no validation rows."""
    held_out = bucket < int(round(fraction * BUCKETS))
    return df.withColumn("split", F.when(held_out, F.lit("validation")).otherwise(F.lit("train")))


def hashed_bucket(*keys: str, seed: int = 42) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(BUCKETS))


def has_at_least(df: DataFrame, n: int) -> DataFrame:
    """One row (rows_seen, passed): reads no more than ``n`` rows per partition."""
    return df.limit(n).agg(F.count("*").alias("rows_seen")).withColumn("passed", F.col("rows_seen") >= n)
