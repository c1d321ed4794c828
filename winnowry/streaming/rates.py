"""Token and cost rates by event time, with late rows kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from winnowry.streaming import versions

WIDTH, DELAY = "10 minutes", "30 minutes"


def window_sums(rows: DataFrame) -> DataFrame:
    """Windows added up; of partial sums as of single rows."""
    return rows.groupBy("window_start").agg(
        F.sum("calls").alias("calls"), F.sum("tokens").alias("tokens"), F.sum("cost_usd").alias("cost_usd"))


def newest_time(rows: DataFrame) -> DataFrame:
    return rows.agg(F.max("ts").alias("ts"))


def split_late(batch: DataFrame, clock: DataFrame | None, width: str = WIDTH, delay: str = DELAY) -> tuple[DataFrame, DataFrame]:
    """(on time, late): a row is late if its window ended ``delay`` or more before the newest earlier event.

    ``batch`` has ts, tokens and cost_usd; rows without a time are late.  ``clock`` is one row at most.
    """
    rows = batch.select("ts", "tokens", "cost_usd")
    window = F.window("ts", width)["start"]  # leaves out rows without a time
    timed = rows.filter("ts is not null").withColumn("window_start", window)
    untimed = rows.filter("ts is null").withColumn("window_start", F.lit(None).cast("timestamp"))
    newest = clock.agg(F.max("ts")).first()[0] if clock is not None else None
    ends = F.col("window_start") + F.expr(f"interval {width}")
    late = F.coalesce(ends <= F.lit(newest).cast("timestamp") - F.expr(f"interval {delay}"), F.lit(False))
    return timed.filter(~late), timed.filter(late).unionByName(untimed)


def write_rates(stream: DataFrame, path: str, width: str = WIDTH, delay: str = DELAY) -> DataStreamWriter:
    """Sums per window below ``path/sums``, late rows below ``path/late``, the newest event time below ``path/clock``.

    State is one row a window, merged by adding up, so it outlives any number of batches; a repeated batch
    judges its rows by the clock before it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch.persist()
        clock = versions.read_versions(session, f"{path}/clock", None, batch_id)
        punctual, late = split_late(batch, clock, width, delay)
        one = punctual.select("window_start", F.lit(1).cast("bigint").alias("calls"), F.col("tokens").cast("bigint").alias("tokens"), "cost_usd")
        versions.commit(window_sums(one), batch_id, f"{path}/sums", None, window_sums)
        versions.commit(late, batch_id, f"{path}/late", None)
        versions.commit(newest_time(batch.select("ts")), batch_id, f"{path}/clock", None, newest_time)
        batch.unpersist()

    return stream.writeStream.outputMode("append").foreachBatch(write)
