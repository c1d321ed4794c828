"""Streams over folders of event files and log files.

``json_stream`` and ``line_stream`` pick up whole new files; ``growing_json`` and ``growing_text`` read
what is appended to files, and files that were cut short or replaced from their start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from winnowry.functions import text
from winnowry.operators import runs
from winnowry.operators.joining import left_join_skewed
from winnowry.sources import byte_tail
from winnowry.sources.readers import CORRUPT, EVENT_SCHEMA

FILE_ORDER = ("file_time", "file_path", "start", "row")


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose state partitions match its cores, with state in RocksDB.

    The number of state partitions is fixed at a stream's first start, so it is chosen here.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set("spark.sql.shuffle.partitions", str(max(1, spark.sparkContext.defaultParallelism)))
    return session


def json_stream(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA, files_per_batch: int | None = None) -> DataFrame:
    """JSON Lines as they arrive, broken lines skipped."""
    full = T.StructType.fromDDL(f"{schema}, {CORRUPT} string")
    reader = spark.readStream.schema(full).option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Non-blank lines with their file's time, name and split start."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(path).select(
        text.strip(F.col("value")).alias("line"), F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start"))
    return lines.filter(F.col("line") != "")


def prepared_events(stream: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Stateless event preparation; ``state`` is a static table of runs."""
    return runs.prepare_events(stream, state)


def write_prepared(stream: DataFrame, path: str, state: DataFrame) -> DataStreamWriter:
    """Prepared events as JSON Lines, a folder ``batch=<id>`` each; runs that fill a batch are enriched by broadcast.

    A repeated batch replaces its own folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        prepared = runs.prepare_events(batch, state, left_join_skewed)
        prepared.write.mode("overwrite").json(f"{path}/batch={batch_id}")
        batch.unpersist()

    return stream.writeStream.outputMode("append").foreachBatch(write)


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start a stream: every ``interval`` when given, else over what is there and then stop."""
    ready = writer.option("checkpointLocation", checkpoint)
    ready = ready.trigger(processingTime=interval) if interval else ready.trigger(availableNow=True)
    return ready.start()


def growing_json(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA, suffix: str = "") -> DataFrame:
    """JSON objects appended to growing logs, with (file, start); blank and broken lines skipped."""
    full = T.StructType.fromDDL(f"{schema}, {CORRUPT} string")
    lines = byte_tail.growing_lines(spark, path, suffix).filter(text.strip(F.col("line")) != "")
    parsed = lines.select("file", "start", F.from_json("line", full, {"columnNameOfCorruptRecord": CORRUPT}).alias("v"))
    return parsed.filter(F.col(f"v.{CORRUPT}").isNull() & F.col("v").isNotNull()).select(
        *[F.col(f"v.{f.name}") for f in T.StructType.fromDDL(schema)], "file", "start")


def growing_text(spark: SparkSession, path: str, suffix: str = "", partition_bytes: int = 32 << 20) -> DataFrame:
    """Non-blank lines appended to growing logs, trimmed, with their file's time, name and byte offset."""
    lines = byte_tail.growing_lines(spark, path, suffix, partition_bytes)
    return lines.select(text.strip(F.col("line")).alias("line"), F.col("modified").alias("file_time"),
                        F.col("file").alias("file_path"), "start").filter(F.col("line") != "")


def append_files(stream: DataFrame, path: str, fmt: str = "json") -> DataStreamWriter:
    """Exactly-once append of a stateless stream."""
    return stream.writeStream.outputMode("append").format(fmt).option("path", path)


def keep_last_lines(stream: DataFrame, path: str, order: tuple = FILE_ORDER, n: int = 20) -> DataStreamWriter:
    """Maintain the last ``n`` lines as ``path/batch=<id>``, by file order unless told otherwise.

    ``order`` may name ``arrived``, the number of the batch, so that lines of replaced files come last.

    A batch derives its version from the previous one and overwrites its own folder, so a
    repeated batch yields the same version.
    """
    newest = [F.col(c).desc() for c in order]

    def update(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"row": F.monotonically_increasing_id(), "arrived": F.lit(batch_id).cast("bigint")}).select(
            "line", *[c for c in order if c != "line"])
        if batch_id > 0:
            earlier = batch.sparkSession.read.schema(rows.schema).parquet(f"{path}/batch={batch_id - 1}")
            rows = rows.unionByName(earlier)
        rows.orderBy(*newest).limit(n).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(update)


def read_last_lines(spark: SparkSession, path: str) -> DataFrame:
    """The newest version written by ``keep_last_lines``."""
    versions = spark.read.parquet(path)
    newest = versions.agg(F.max("batch").alias("batch"))
    return versions.join(F.broadcast(newest), "batch").drop("batch")
