"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnowry import session

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HELD_OUT_FOLDS = 5
PART_BITS = 33  # of the numbers that monotonically_increasing_id gives within a partition
SPACE = re.compile(rb"[ \t-\r]")
BATCH_BYTES = 1 << 21  # of texts that Python gets at once
SLOTS = 1 << 24  # of a broadcast sieve of keys: 262,144 rows of 64 at most, whatever the number of keys


_NOTES: ContextVar[tuple[list[str], ...]] = ContextVar("notes", default=())  # one per thread, so runs side by side stay apart


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back; inside ``noted`` the path is noted."""
    path = session.scratch(df.sparkSession, label)
    for note in _NOTES.get():
        note.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs run meanwhile hand rows to Python in Arrow batches of about ``size`` bytes, not of 64 MB.

    Executor and worker hold several of a batch, and both keep memory that large buffers once took.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that ``stored`` writes meanwhile."""
    paths: list[str] = []
    before = _NOTES.set((*_NOTES.get(), paths))
    try:
        yield paths
    finally:
        _NOTES.reset(before)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete these tables; those already gone are passed over."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` finds, stored; the tables it wrote on the way are removed.

    For results much smaller than those tables, such as the decisions of a filter.
    """
    with noted() as paths:
        made = make()
    out = stored(made, label)
    remove(out.sparkSession, paths)
    return out


def word_pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between ASCII white space, in lists of about ``size`` bytes of text."""
    begin = 0
    while begin < len(text):
        end = begin + size
        if end < len(text):  # up to the next space; the pattern is one class of bytes, so no piece is read twice
            space = SPACE.search(text, end)
            end = space.start() if space else len(text)
        if words := text[begin:end].split():
            yield words
        begin = end


def numbered(rows: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """The rows with their place in a total order, from 1; sorted by ranges, so no task sees them all."""
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", PART_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))  # one row a partition
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + F.col("_at").bitwiseAND((1 << PART_BITS) - 1) + 1).drop("_part", "_start", "_at")


def with_found(rows: DataFrame, found: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """rows left joined to ``found`` (unique null-safe ``key``, n: rows of that key, further columns), whatever one key holds.

    Keys of more than a ``share``-th of all rows, fewer than ``share`` of them, are broadcast; the rest
    meets in a shuffle.
    """
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    hot = found.filter(F.col("n") * share > total).select(F.col(key).alias("_hot"), F.struct(*[c for c in found.columns if c not in (key, "n")]).alias("_own"))
    met = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left")
    at_once = met.filter("_own is not null").select(*rows.columns, "_own.*")
    rest = met.filter("_own is null").select(*rows.columns)
    cold = found.filter(F.col("n") * share <= total).drop("n").withColumnRenamed(key, "_cold")
    return at_once.unionByName(rest.join(cold, F.col(key).eqNullSafe(F.col("_cold")), "left").drop("_cold"))


def sifted(docs: DataFrame, found: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose doc_id is surely not in found's ``key``, and all others, some of them by chance.

    So a join with few found documents moves their texts, not all.  Hashed keys are bits of a broadcast sieve of bounded
    size; the more keys, the more rows it lets through by chance, so the others need an exact join.
    """
    slot = lambda c: F.pmod(F.xxhash64(c.cast("bigint")), F.lit(SLOTS))
    bit = lambda c: slot(c).bitwiseAND(F.lit(63)).cast("int")
    sieve = F.broadcast(found.select(F.shiftright(slot(F.col(key)), 6).alias("_word"), F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), bit(F.col(key))).alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    hit = (F.shiftright(slot(F.col("doc_id")), 6) == F.col("_word")) & (F.getbit("_bits", bit(F.col("doc_id"))) == 1)
    return docs.join(sieve, hit, "left_anti"), docs.join(sieve, hit, "left_semi")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, other letters untouched."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def words(text: Column, separators: str) -> Column:
    """The non-empty pieces between separators (a character class); null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{separators}+"), lambda w: w != "")


def held_out(doc_id: Column) -> Column:
    """Whether a document is outside the training folds; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(True))
