"""Top rows per group without a hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry.session import stored

RANK = "_rank"
SLOT = "_slot"
ROW = "_row"
SKETCH_ERROR = 0.03  # of a rank, as a share of all; the default sketch stays within about half of it


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    The rank filter sits on the window, so each map task keeps one row per key before
    the shuffle: a key that fills a third of the table still ships one row per task.
    """
    ranked = df.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(RANK) == 1).drop(RANK)


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int,
                    slots: int | None = None, rank_name: str | None = None) -> DataFrame:
    """The first ``n`` rows per key by ``order``, exactly.

    Few keys mean few tasks, so ranking runs twice: first per (key, slot), where a slot
    is a bundle of map tasks, as many as the session's shuffle partitions unless given, then per
    key over at most ``slots * n`` survivors.  The top n of a union of top-n lists is the top n of the whole, however rows fell into slots.
    Spark prunes inside map tasks up to ``spark.sql.optimizer.windowGroupLimitThreshold``
    rows per key (1000 unless set); raise it along with ``n``.
    """
    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slotted = df.withColumn(SLOT, F.pmod(F.spark_partition_id(), F.lit(slots)))
    per_slot = F.row_number().over(Window.partitionBy(*keys, SLOT).orderBy(*order))
    survivors = slotted.withColumn(RANK, per_slot).filter(F.col(RANK) <= n).drop(RANK, SLOT)
    if keys:
        final = Window.partitionBy(*keys).orderBy(*order)
    else:
        final = Window.orderBy(*order)
    name = rank_name or RANK
    out = survivors.withColumn(name, F.row_number().over(final)).filter(F.col(name) <= n)
    return out if rank_name else out.drop(RANK)


def top_n_by_threshold(df: DataFrame, key: str, score: str, order: list[str], n: int) -> DataFrame:
    """The ``n`` rows of the highest score per key, ties by ``order``, then by place; exactly.

    Wide rows are written once and fetched for the winners alone.  A quantile sketch per key bounds the
    n-th score from below; only rows above the bound are ranked, by their narrow columns.  Where the
    sketch erred and fewer than n rows lie above, all rows of the key are ranked.
    """
    rows = stored(df.withColumn(ROW, F.monotonically_increasing_id()), "ranking-rows")
    narrow = rows.select(key, F.col(score).cast("double").alias("_score"), *order, ROW)
    sized = narrow.groupBy(key).agg(F.count("*").alias("_all"), F.kll_sketch_agg_double("_score").alias("_sketch"))
    place = F.greatest(F.lit(0.0), 1 - F.lit(float(n)) / F.col("_all") - SKETCH_ERROR)
    grid = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(i / 100) for i in range(101)]))
    bounds = sized.select(F.col(key).alias("_key"), "_all", F.when(
        F.kll_sketch_get_n_double("_sketch") > 0, F.get(grid, F.floor(place * 100).cast("int"))).alias("_bound"))
    bounds = stored(bounds, "ranking-bounds")  # sketches draw at random; every use below sees one draw
    same = F.col(key).eqNullSafe(F.col("_key"))
    above = narrow.join(bounds, same).filter("_score >= _bound").groupBy("_key").agg(F.count("*").alias("_above"))
    short = bounds.join(above.withColumnRenamed("_key", "_k"), F.col("_key").eqNullSafe(F.col("_k")), "left").select(
        "_key", F.when(F.coalesce("_above", F.lit(0)) >= F.least("_all", F.lit(n)), F.col("_bound")).alias("_bound"))
    open_rows = narrow.join(short, same).filter("_bound is null or _score >= _bound").drop("_key", "_bound")
    winners = stored(top_n_per_group(open_rows, [key], [F.col("_score").desc(), *[F.col(c) for c in order], F.col(ROW)], n).select(ROW), "ranking-winners")
    return rows.join(winners, ROW, "left_semi").drop(ROW)


def newest(df: DataFrame, keys: list[str], time: str, value: str, out: str) -> DataFrame:
    """Value of the latest row per key; the greater value wins equal times."""
    pick = F.max(F.struct(F.col(time), F.col(value)))[value].alias(out)
    return df.groupBy(*keys).agg(pick) if keys else df.agg(pick)
