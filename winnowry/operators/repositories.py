"""Repository selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_repos(df: DataFrame, languages: list[str], min_stars: int, min_forks: int) -> DataFrame:
    return df.filter(
        F.col("language").isin(*languages) & (F.col("stars") >= min_stars) & (F.col("forks") >= min_forks)
    )


def top_repos(df: DataFrame, max_results: int, tie: str = "repo_id") -> DataFrame:
    """Most stars, then most forks; ``tie`` fixes the order of equal ones."""
    return df.orderBy(F.col("stars").desc(), F.col("forks").desc(), F.col(tie)).limit(max_results)


def repo_status(df: DataFrame) -> DataFrame:
    """Counts of repositories by processing state."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("state").isin("cloned", "processed")).alias("cloned"),
        F.count_if(F.col("state") == "processed").alias("processed"),
        F.count_if(F.col("state") == "failed").alias("failed"),
    )
