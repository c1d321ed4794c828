"""Importance resampling towards a target distribution, with an exact weighted-median cutoff.

Features are hashed into a fixed number of buckets.  A bucket's gain compares its share in the target
with its share in the source; a document's weight is the mean gain of its features, looked up in one
array.  Weight plus Gumbel noise drawn from the id is the score, and the highest scores are a sample
without replacement.

The cutoff is found without sorting: every chunk of the keys that are still open sends its median and
size, the median of these medians weighted by size is the next pivot, and at least a quarter of the
open keys lies on either side of it, so every pass over them settles a quarter at least.  Only the
winners are sorted.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import numbered, stored, word_pieces

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
CHUNK = 1 << 20  # keys whose median is one candidate
SORTED = 4096  # so few open keys are put in order at once
# Bytes of a text: A-Z to a-z, digits and bytes of other characters as they are, everything else a space.
SPACED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def buckets_of(text: bytes | None, n: int, buckets: int) -> np.ndarray:
    """The bucket of every run of 1 to n consecutive words of a text, repeats included."""
    out, before = [], []
    for words in word_pieces((text or b"").translate(SPACED)):
        joined = before + words
        for size in range(1, n + 1):
            runs = words if size == 1 else [b" ".join(joined[i:i + size]) for i in range(
                max(0, len(before) - size + 1), len(joined) - size + 1)]
            out.append(np.fromiter(map(zlib.crc32, runs), dtype=np.uint32, count=len(runs)) % np.uint32(buckets))
        before = joined[max(0, len(joined) - n + 1):] if n > 1 else []
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def features(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """doc_id, n_words, found (buckets as 32-bit numbers) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("found", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [buckets_of(t.as_py(), n, buckets) for t in batch["text"]]
            words = found if n == 1 else [buckets_of(t.as_py(), 1, buckets) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array([len(w) for w in words], pa.int64()),
                pa.array([f.astype("<u4").tobytes() for f in found], pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        run, "doc_id bigint, n_words bigint, found binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows; the driver receives one sum a bucket."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for f in batch["found"]:
                total += np.bincount(np.frombuffer(f.as_py(), "<u4"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], schema=schema)

    out = np.zeros(buckets, np.int64)
    for bucket, n in found.select("found").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share to source share, by bucket, both smoothed by one."""
    s, t, size = source.astype(np.float64), target.astype(np.float64), len(source)
    ratio = (t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def scored(found: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row; the score is null without an id."""
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "n_features", "weight", "score"))])
    gain_of = found.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(f.as_py(), "<u4") for f in batch["found"]]
            sizes = np.array([len(v) for v in values], np.int64)
            sums = np.array([gain_of.value[v].sum() for v in values], np.int64)
            weight = np.where(sizes > 0, sums // np.maximum(sizes, 1), 0)
            ids = batch["doc_id"].to_pylist()
            h = np.array([int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16) for i in ids], np.float64)
            noise = np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["n_words"], pa.array(sizes), pa.array(weight),
                pa.array(weight + noise, pa.int64(), mask=np.array([i is None for i in ids], bool))], schema=schema)

    return found.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


Key = tuple[int, ...]


def median(columns: list[np.ndarray]) -> Key:
    """The lower median of keys given column by column: by the first column, then among its equals."""
    half = (len(columns[0]) - 1) // 2
    for k in range(len(columns)):
        column = columns[k]
        value = np.partition(column, half)[half]
        half -= int((column < value).sum())
        same = column == value
        columns = [c[same] for c in columns]
    return tuple(int(c[0]) for c in columns)


def below(columns: list[np.ndarray], pivot: Key) -> np.ndarray:
    """Which keys come before the pivot."""
    out = np.zeros(len(columns[0]), bool)
    same = ~out
    for column, value in zip(columns, pivot, strict=True):
        out |= same & (column < value)
        same &= column == value
    return out


def medians(keys: DataFrame, pivot: Key | None, chunk: int) -> list[tuple[bool, int, Key]]:
    """(above, size, median) of the keys on either side of the pivot, chunk by chunk; the pivot itself is left out.

    The driver receives at most two short rows for each partition and each full chunk.
    """
    names = keys.columns
    schema = pa.schema([("above", pa.bool_()), ("n", pa.int64()), ("median", pa.list_(pa.int64()))])

    def flushed(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        less = below(columns, pivot) if pivot else np.zeros(len(columns[0]), bool)
        same = np.logical_and.reduce([c == v for c, v in zip(columns, pivot, strict=True)]) if pivot else less
        rows = [(above, int(side.sum()), median([c[side] for c in columns]))
                for above, side in ((False, less), (True, ~less & ~same)) if side.any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append([batch[c].to_numpy() for c in names])
                held += batch.num_rows
            if held >= chunk:
                yield from flushed(parts)
                parts, held = [], 0
        if held:
            yield from flushed(parts)

    return [(r["above"], r["n"], tuple(r["median"])) for r in keys.mapInArrow(run, "above boolean, n bigint, median array<bigint>").collect()]


def weighted_median(found: list[tuple[int, Key]]) -> Key:
    """The first of the sorted medians at which half of the weight is reached."""
    found, seen = sorted(found, key=lambda x: x[1]), 0
    total = sum(n for n, _ in found)
    for n, key in found:
        seen += n
        if 2 * seen >= total:
            return key
    raise ValueError("no medians")


def as_struct(key: Key) -> Column:
    return F.struct(*[F.lit(v).cast("bigint") for v in key])


def cutoff(keys: DataFrame, place, chunk: int = CHUNK, in_order: int = SORTED) -> tuple[Key | None, int]:
    """The exact key at ``place(number of keys)``, counted from 1 in ascending order, and that place.

    ``keys`` has bigint columns without nulls, most significant first; rows are unique.  No key is at place 0.
    """
    names = keys.columns
    whole = F.struct(*names)
    found = medians(keys, None, chunk)
    left = held = sum(n for _, n, _ in found)
    wanted = k = place(left)
    if not 0 < k <= left:
        return None, 0
    low = high = None

    def still_open() -> DataFrame:
        out = keys
        if low:
            out = out.filter(F.col(names[0]) >= low[0]).filter(whole > as_struct(low))
        if high:
            out = out.filter(F.col(names[0]) <= high[0]).filter(whole < as_struct(high))
        return out

    while left > in_order:
        pivot = weighted_median([(n, m) for _, n, m in found])
        if left * 4 <= held:  # what is read again shrinks with what is open
            keys, held = stored(still_open(), "resampling-open"), left
        found = medians(still_open(), pivot, chunk)
        less = sum(n for above, n, _ in found if not above)
        if k == less + 1:
            return pivot, wanted
        if k <= less:
            high, left = pivot, less
        else:
            low, left, k = pivot, left - less - 1, k - less - 1
        found = [f for f in found if f[0] == (low == pivot)]
    return tuple(still_open().orderBy(*names).collect()[k - 1]), wanted


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, n: int = 1,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs`` (doc_id, text), drawn towards ``target`` (text).

    Of the rows with at least ``min_words`` words the ``percent`` hundredths (floored) of the highest
    scores get a rank from 1; ties go to the smaller id, then to the earlier row.  Null and empty texts
    have no features and weight 0.  Rows without a doc_id have no score and are not drawn from; rows that
    repeat one are rows of their own.  An empty target or table gives smoothed shares alone.
    """
    found = stored(features(docs, n, buckets), "resampling-features")
    aimed = features(target.select(F.lit(0).alias("doc_id"), "text"), n, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(aimed, buckets))
    rows = stored(scored(found, gain, seed).withColumn("place", F.monotonically_increasing_id()), "resampling-scores")
    enters = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    key = ((-F.col("score")).alias("worse"), F.col("doc_id"), F.col("place"))
    last, drawn = cutoff(rows.filter(enters).select(*key), lambda size: percent * size // 100)
    out = ("doc_id", "n_features", "weight", "score")
    if not drawn:
        return rows.select(*out, F.lit(None).cast("bigint").alias("rank"))
    wins = enters & (-F.col("score") <= last[0]) & (F.struct(*key) <= as_struct(last))
    ranked = numbered(rows.filter(wins), [F.col("score").desc(), F.col("doc_id"), F.col("place")], "rank", "resampling-winners")
    return rows.filter(~F.coalesce(wins, F.lit(False))).select(*out, F.lit(None).cast("bigint").alias("rank")).unionByName(
        ranked.select(*out, "rank"))


def resampled(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The drawn rows of ``docs`` with all columns; of rows that repeat a doc_id all come with it."""
    drawn = resample(docs, target, **parameters).filter("rank is not null").select(F.col("doc_id").alias("_doc_id")).distinct()
    return docs.join(drawn, F.col("doc_id").cast("bigint") == F.col("_doc_id"), "left_semi")
