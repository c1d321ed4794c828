"""Results of streams as a log-structured merge of bounded runs.

Every batch adds one run, a folder of its rows.  When a level has FAN runs they are merged into one of
the next level: the newest row of every key, or all rows where there are no keys.  A manifest names the
live runs of a batch; it appears under its final name when all its runs are written, so an interrupted
or repeated batch leaves the earlier manifest as it was, and readers follow the newest one.  What the
last manifests do not name is removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from winnowry.operators.ranking import first_per_group

FAN = 3
KEPT = 3  # manifests whose runs stay, for readers that began before
BATCH = "_batch"


@dataclass
class Folder:
    """Small files and listings of one place, whatever file system it is on."""

    spark: SparkSession
    path: str

    def at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    @property
    def system(self):
        return self.at("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, below: str) -> list[str]:
        where = self.at(below)
        return sorted(f.getPath().getName() for f in self.system.listStatus(where)) if self.system.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write under another name, then rename: readers see the whole file or none."""
        draft = self.at(f"drafts/{uuid.uuid4().hex}")
        stream = self.system.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.system.mkdirs(self.at(name).getParent())
        if not self.system.rename(draft, self.at(name)):
            raise OSError(f"could not publish {name}")

    def remove(self, name: str) -> None:
        self.system.delete(self.at(name), True)


def manifests(folder: Folder, before: int | None = None) -> list[str]:
    """Names of the manifests in the order of their batches; of a repeated batch any attempt is whole."""
    found = [n for n in folder.names("manifests") if n.endswith(".json")]
    return [n for n in found if before is None or int(n.split("-")[0]) < before]


def runs_of(folder: Folder, name: str) -> list[dict]:
    return json.loads(folder.read(f"manifests/{name}"))


def rows_of(spark: SparkSession, path: str, runs: list[dict]) -> DataFrame:
    return spark.read.schema(runs[0]["schema"]).parquet(*[f"{path}/runs/{r['name']}" for r in runs])


def newest_rows(rows: DataFrame, keys: list[str] | None) -> DataFrame:
    return first_per_group(rows, keys, [F.col(BATCH).desc()]) if keys else rows


def commit(batch: DataFrame, batch_id: int, path: str, keys: list[str] | None,
           merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Add the rows of a batch; a repeated batch builds on the same predecessor and replaces its first attempt.

    ``merge`` makes one run of several, by default the newest row of every key; sums, say, add up.
    """
    spark, folder = batch.sparkSession, Folder(batch.sparkSession, path)
    earlier = manifests(folder, batch_id)
    live = runs_of(folder, earlier[-1]) if earlier else []

    def write(rows: DataFrame, level: int) -> dict:
        name = f"{batch_id:012d}-{level}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{path}/runs/{name}")
        return {"name": name, "level": level, "schema": rows._jdf.schema().toDDL()}

    live.append(write(batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")), 0))
    level = 0
    while len(full := [r for r in live if r["level"] == level]) >= FAN:
        rows = rows_of(spark, path, full)
        merged = write(merge(rows.drop(BATCH)).withColumn(BATCH, F.lit(batch_id).cast("bigint")) if merge else newest_rows(rows, keys), level + 1)
        live = [r for r in live if r["level"] != level] + [merged]
        level += 1
    folder.publish(f"manifests/{batch_id:012d}-{uuid.uuid4().hex[:8]}.json", json.dumps(live))
    kept = manifests(folder)
    kept, gone = kept[-KEPT:], kept[:-KEPT]
    named = {r["name"] for m in kept for r in runs_of(folder, m)}
    for name in gone:
        folder.remove(f"manifests/{name}")
    for name in folder.names("runs"):
        if name not in named and int(name.split("-")[0]) < batch_id:
            folder.remove(f"runs/{name}")


def read_versions(spark: SparkSession, path: str, keys: list[str] | None, before: int | None = None) -> DataFrame | None:
    """Current row per key, or all rows without keys; None while no batch (before ``before``) was committed."""
    folder = Folder(spark, path)
    found = manifests(folder, before)
    if not found:
        return None
    return newest_rows(rows_of(spark, path, runs_of(folder, found[-1])), keys).drop(BATCH)


def live_runs(spark: SparkSession, path: str) -> int:
    """How many folders a reader has to read."""
    folder = Folder(spark, path)
    found = manifests(folder)
    return len(runs_of(folder, found[-1])) if found else 0


def write_versions(stream: DataFrame, path: str, keys: list[str] | None) -> DataStreamWriter:
    """Commit the changed rows of every batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        commit(batch, batch_id, path, keys)

    return stream.writeStream.outputMode("update" if keys else "append").foreachBatch(write)
