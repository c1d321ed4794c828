"""Sinks.  All are plain Spark writers; nothing is written one file per key."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.sources.byte_tail import opened

ROWS_PER_FILE = 100_000


def append_samples(df: DataFrame, path: str) -> None:
    """Append raw samples as JSON Lines; the per-file key travels as ``sample_key``.

    The samples of a file repeat its text one after the other, so they are packed; such a file is read
    by one task, and is therefore ended after ROWS_PER_FILE rows.
    """
    df.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE).json(path)


def write_dataset(samples: DataFrame, stats: DataFrame, path: str) -> None:
    """Dataset as Parquet and its one-row statistics as JSON."""
    samples.write.mode("overwrite").parquet(f"{path}/train")
    stats.write.mode("overwrite").json(f"{path}/stats")


def write_repos(repos: DataFrame, path: str) -> None:
    """URL list for scrapers and details as JSON Lines."""
    repos.select("url").write.mode("overwrite").text(f"{path}/urls")
    repos.write.mode("overwrite").json(f"{path}/details")


def write_eval_results(results: DataFrame, path: str) -> None:
    """Results by round; only the rounds present in ``results`` are replaced."""
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("round").parquet(path)


def append_tokens(df: DataFrame, path: str) -> None:
    """Append (ts, tokens) rows with a positive count."""
    df.filter(F.col("tokens") > 0).select("ts", "tokens").write.mode("append").csv(path)


def write_file_list(files: DataFrame, path: str) -> None:
    files.select("path").write.mode("overwrite").text(path)


def write_log_files(lines: DataFrame, root: str) -> DataFrame:
    """One text file below ``root`` for each ``file``, with its ``line``s in the order of ``at``; returns (file, lines).

    A task writes its files one after the other as their sorted rows come by, each under another name
    until it is whole, so a repeated task replaces what it wrote and no file is held in memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        system.create_dir(base, recursive=True)
        token, name, out, count = uuid.uuid4().hex, None, None, 0

        def closed() -> pa.RecordBatch:
            out.close()
            system.move(f"{base}/_{token}", f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"file": [name], "lines": [count]})

        for batch in batches:
            for file, line in zip(batch["file"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if file != name:
                    if out:
                        yield closed()
                    name, count, out = file, 0, system.open_output_stream(f"{base}/_{token}")
                out.write(line.encode() + b"\n")
                count += 1
        if out:
            yield closed()

    ordered = lines.select("file", "at", "line").repartition("file").sortWithinPartitions("file", "at")
    return ordered.select("file", "line").mapInArrow(run, "file string, lines bigint")
