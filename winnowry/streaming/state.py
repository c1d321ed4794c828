"""Stateful streams per run."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from winnowry import fixed_values as fv
from winnowry.operators import folds, sequence
from winnowry.session import stored
from winnowry.streaming import versions

NEWEST_SCHEMA = "pos bigint, seq bigint"


def fold_counters(events: DataFrame) -> DataFrame:
    """Running counters per run; the same fold as in batch."""
    return folds.fold_deltas(events)


def newest_by_sequence(updates: DataFrame, fields: list[str]) -> DataFrame:
    """Running row of the highest sequence number per run; the earliest of equal ones stays."""
    rank = F.struct(F.col("seq"), (-F.col("pos")).alias("age"))
    row = F.max(F.struct(rank.alias("rank"), "pos", *fields)).alias("row")
    return updates.groupBy("run_id").agg(row).select("run_id", "row.rank.seq", "row.pos", *[f"row.{f}" for f in fields])


def newest_reports(reports: DataFrame, fields: list[str]) -> DataFrame:
    """Last report per run by position; reports without a run are dropped."""
    named = reports.filter(F.coalesce(F.col("run_id").cast("string"), F.lit("")) != "")
    row = F.max(F.struct("pos", *fields)).alias("row")
    return named.groupBy("run_id").agg(row).select("run_id", "row.pos", *[f"row.{f}" for f in fields])


def rejected_reports(reports: DataFrame) -> DataFrame:
    return reports.filter(F.coalesce(F.col("run_id").cast("string"), F.lit("")) == "")


def write_reports(stream: DataFrame, path: str, rejected_path: str, fields: list[str]) -> DataStreamWriter:
    """Both outcomes of every batch in one pass: its newest report per run, and its reports without a run."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        versions.commit(newest_reports(batch, fields), batch_id, path, ["run_id"])
        versions.commit(rejected_reports(batch), batch_id, rejected_path, None)
        batch.unpersist()

    return stream.writeStream.foreachBatch(write)


def flag_batch(updates: DataFrame, before: DataFrame | None, gap: int = fv.RESTART_GAP,
               stale_seconds: int = fv.STALE_SECONDS) -> tuple[DataFrame, DataFrame]:
    """Flags of a batch's updates, and the last accepted number and time of its runs.

    ``updates`` has run_id, pos, seq, ts and reported_run_id; ``before`` has run_id, seq, ts of earlier
    batches.  A number that repeats or falls a little is a mismatch if another run reported it, and stale
    if the last accepted one is too old; another run's number restarts nothing.  The last numbers go
    ahead of the batch as rows without a position, so a hot run is replayed in bounded blocks like any.
    """
    rows = updates.select("run_id", "pos", "seq", "ts", F.col("run_id").eqNullSafe(F.col("reported_run_id")).alias("own"), F.lit(False).alias("seed"))
    if before is not None:
        met = before.join(rows.select("run_id").distinct(), "run_id", "left_semi")
        rows = rows.unionByName(met.select("run_id", F.lit(None).cast("bigint").alias("pos"), "seq", "ts", F.lit(True).alias("own"), F.lit(True).alias("seed")))
    replayed = stored(sequence.stale_flags(sequence.replay_sequence(rows, ts="ts", gap=gap, own="own"), seconds=stale_seconds), "flags")
    flags = replayed.filter("not seed").select(
        "run_id", "pos", "seq", "restarted", "accepted", (~F.col("accepted") & ~F.col("own")).alias("mismatch"),
        (F.col("stale") & F.col("own")).alias("stale"))
    last = replayed.filter("accepted").groupBy("run_id").agg(F.max_by(F.struct("seq", "ts"), F.struct(
        (~F.col("seed")).alias("a"), "pos")).alias("last")).select("run_id", "last.seq", "last.ts")
    return flags, last


def write_flags(stream: DataFrame, path: str, gap: int = fv.RESTART_GAP, stale_seconds: int = fv.STALE_SECONDS) -> DataStreamWriter:
    """Commit flags below ``path/flags`` and the runs' last numbers below ``path/last``, batch by batch.

    A batch is put in order by position; batches follow each other as they arrive.  A repeated batch
    starts from the numbers before it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        flags, last = flag_batch(batch, versions.read_versions(batch.sparkSession, f"{path}/last", ["run_id"], batch_id), gap, stale_seconds)
        versions.commit(flags, batch_id, f"{path}/flags", None)
        versions.commit(last, batch_id, f"{path}/last", ["run_id"])

    return stream.writeStream.outputMode("append").foreachBatch(write)


class Silence(StatefulProcessor):
    """Keeps the newest position and number of a run, and a timer that every update sets anew.

    Needs no order and holds one row, so a hot run passes in chunks of bounded size.
    """

    def __init__(self, seconds: float):
        self.wait = int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", NEWEST_SCHEMA)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = self.newest.get() if self.newest.exists() else None
        for chunk in rows:
            top = chunk.loc[chunk["pos"].idxmax()]
            if best is None or int(top["pos"]) >= best[0]:
                best = (int(top["pos"]), int(top["seq"]))
        if best is not None:
            self.newest.update(best)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)
        yield pd.DataFrame(columns=["run_id", "pos", "seq"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        pos, seq = self.newest.get()
        yield pd.DataFrame({"run_id": [key[0]], "pos": [pos], "seq": [seq]})

    def close(self) -> None:
        """Nothing to free."""


def silent_runs(updates: DataFrame, seconds: float = fv.STALE_SECONDS) -> DataFrame:
    """(run_id, pos, seq) of the newest update whenever a run has been silent for ``seconds``.

    Timers keep scheduling batches: run such a stream at an interval.  Its state needs the RocksDB store,
    which ``tail.stream_session`` sets.
    """
    named = updates.filter("pos is not null and seq is not null").select("run_id", "pos", "seq")
    return named.groupBy("run_id").transformWithStateInPandas(
        Silence(seconds), f"run_id {updates.schema['run_id'].dataType.simpleString()}, pos bigint, seq bigint", "append", "processingTime")
