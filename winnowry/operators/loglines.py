"""Log tables (source, pos, line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnowry.functions import logs, text
from winnowry.operators.ranking import top_n_per_group


def tail(df: DataFrame, n: int, keys: list[str] | None = None, pos: str = "pos") -> DataFrame:
    """The last ``n`` lines, per key when keys are given."""
    if keys:
        return top_n_per_group(df, keys, [F.col(pos).desc()], n)
    return df.orderBy(F.col(pos).desc()).limit(n)


def training_lines(recent: DataFrame, key: str = "source") -> DataFrame:
    """Training lines of each (bounded) tail; all of its lines where none is one."""
    hit = logs.is_training_line(F.col("line"))
    any_hit = F.max(hit).over(Window.partitionBy(key))
    return recent.withColumn("_any", any_hit).filter(hit | ~F.col("_any")).drop("_any")


def with_training_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns(logs.training_metrics(F.col("line")))


def pick_progress(recent: DataFrame, key: str = "source", pos: str = "pos",
                  configured: str = "configured_total") -> DataFrame:
    """The authoritative progress bar of each (bounded) tail.

    Last bar whose total is the configured one; with a configured total that never occurs,
    the first bar of the largest total; without one, the last bar of the largest total.
    """
    bars = recent.filter(F.col("bar_total").isNotNull())
    wanted = F.coalesce(F.col("bar_total") == F.col(configured), F.lit(False))
    largest_pos = F.when(F.col(configured) > 0, -F.col(pos)).otherwise(F.col(pos))
    rank = F.struct(
        wanted.cast("int").alias("a"),
        F.when(wanted, F.lit(0)).otherwise(F.col("bar_total")).alias("b"),
        F.when(wanted, F.col(pos)).otherwise(largest_pos).alias("c"),
    )
    speed = F.when(F.col("sec_per_it") > 0, 1.0 / F.col("sec_per_it")).otherwise(F.lit(0.0))
    best = F.max(F.struct(rank.alias("rank"), "bar_step", "bar_total", speed.alias("speed"))).alias("best")
    return bars.groupBy(key).agg(best).select(
        key, F.col("best.bar_total").alias("total_steps"), F.col("best.bar_step").alias("training_step"),
        F.col("best.speed").alias("training_speed"))


def loss_history(df: DataFrame, key: str = "source", pos: str = "pos", keep: int = 100) -> DataFrame:
    """The last ``keep`` losses per source in order, and the current one."""
    recent = top_n_per_group(
        df.filter(F.col("loss").isNotNull()).select(key, pos, "loss"), [key], [F.col(pos).desc()], keep)
    entries = F.sort_array(F.collect_list(F.struct(pos, "loss")))
    return recent.groupBy(key).agg(entries.alias("_e")).select(
        key, F.transform("_e", lambda e: e["loss"]).alias("losses"),
        F.element_at("_e", -1)["loss"].alias("current_loss"))


def latest_values(df: DataFrame, names: list[str], key: str = "source", pos: str = "pos") -> DataFrame:
    """Newest non-null value of each named column per source."""
    return df.groupBy(key).agg(*[
        F.max_by(n, F.when(F.col(n).isNotNull(), F.col(pos))).alias(n) for n in names])


def parallel_progress(recent: DataFrame, key: str = "source", pos: str = "pos") -> DataFrame:
    """Stage and counts after reading each (bounded) tail of a parallel generation log."""
    m = recent.withColumns(logs.parallel_metrics(text.strip(F.col("line"))))
    last = {n: F.max_by(n, F.when(F.col(n).isNotNull(), F.col(pos))) for n in ("stage", "processed_files", "total_files")}
    done = F.max(F.when(F.col("finished_samples").isNotNull(), F.struct(F.col(pos).alias("p"), F.col("finished_samples").alias("n"))))
    running = F.collect_list(F.when(F.col("running_samples").isNotNull(),
                                    F.struct(F.col(pos).alias("p"), F.col("running_samples").alias("n"))))
    rows = m.groupBy(key).agg(
        *[c.alias(n) for n, c in last.items()], done.alias("_done"), running.alias("_running"))
    later = F.filter("_running", lambda r: F.coalesce(r["p"] >= F.col("_done")["p"], F.lit(True)))
    peak = F.array_max(F.transform(later, lambda r: r["n"]))
    zero = F.lit(0)
    return rows.select(
        key, F.coalesce("stage", F.lit("idle")).alias("stage"),
        F.coalesce("processed_files", zero).alias("processed_files"),
        F.coalesce("total_files", zero).alias("total_files"),
        F.greatest(F.coalesce(F.col("_done")["n"], zero), F.coalesce(peak, zero)).alias("samples_generated"),
    )
