"""Joins that one key cannot hold up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_skewed(rows: DataFrame, found: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """rows left joined to ``found`` (unique ``key`` and further columns), whatever part of the rows one key has.

    Keys of more than a ``share``-th of the rows are fewer than ``share``, so what is found for them is
    broadcast; all others meet in a shuffled join: ``found`` never passes through the driver, however
    often a stream joins it.  ``rows`` is read twice: persist or store it before.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col(key).isNotNull())
    total = rows.count()
    frequent = [r[key] for r in counts.filter(F.col("_n") * share > total).select(key).collect()]
    hot = found.filter(F.col(key).isin(frequent))
    is_hot = F.coalesce(F.col(key).isin(frequent), F.lit(False))
    often = rows.filter(is_hot).join(F.broadcast(hot), key, "left")
    return often.unionByName(rows.filter(~is_hot).join(found.hint("merge"), key, "left"))
