"""Threshold-scaled document sketches: every shingle hash below a fixed fraction is retained.

Sketches of any two texts are samples of the same hash range, so they compare and merge whatever the
sizes of the texts.  A text none of whose hashes falls below the threshold keeps its smallest one,
which a merge preserves.  Everything is row-local except the neighbour lookup, which moves each text once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry.llm.common import let, lower_ascii, words

SHINGLE_WORDS = 5
HASH_BITS = 40
FRACTION = 1 / 4
WHITE = "[\\x20\\x09-\\x0D]"
BUCKET_ROWS = 2048
MAX_BUCKETS = 65536
COARSE = 64


def shingle_hashes(text: Column, n: int = SHINGLE_WORDS) -> Column:
    """Hashes of all n-word shingles; a shorter text is one shingle; no words, none."""
    def over(h: Column) -> Column:
        longer = F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (n - 1), F.lit(0))), lambda x, i: F.xxhash64(
            x, *[F.get(h, i + k) for k in range(1, n)]))
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= n, longer).otherwise(whole)

    hashes = let(F.transform(words(lower_ascii(text), WHITE), lambda w: F.xxhash64(w)), over)
    return F.transform(hashes, lambda x: x.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))


def retained(hashes: Column, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes below the threshold, else the smallest alone."""
    top = int(fraction * (1 << HASH_BITS))
    def keep(h: Column) -> Column:
        low = F.filter(h, lambda x: x < top)
        return let(low, lambda low: F.when((F.size(low) > 0) | (F.size(h) == 0), F.array_sort(F.array_distinct(low)))
                   .otherwise(F.array(F.array_min(h))))
    return let(hashes, keep)


def sketch(text: Column) -> Column:
    """The sketch of a text; null and empty texts have an empty one."""
    return retained(shingle_hashes(text))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts taken together."""
    return retained(F.array_union(a, b), fraction)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; two empty sketches are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; an empty sketch is contained in all."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def printed(s: Column) -> Column:
    """A sketch as text: its hashes in order, ten hex digits each."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.hex(x), HASH_BITS // 4, "0")), "")


def id_bounds(docs: DataFrame) -> list[int]:
    """Upper ids of buckets of about BUCKET_ROWS rows; the last is the largest id.  At most MAX_BUCKETS values."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id is not null")
    n = min(MAX_BUCKETS, max(1, math.ceil(ids.count() / BUCKET_ROWS)))
    fractions = F.from_json(F.lit(str([i / n for i in range(1, n + 1)])), "array<double>")
    row = ids.agg(F.percentile_approx("doc_id", fractions, 10 * n + 1000).alias("cuts"), F.max("doc_id").alias("top")).first()
    return sorted({*(row["cuts"] or []), row["top"]}) if row["top"] is not None else []


def place(value: Column, bounds: list[int]) -> Column:
    """How many bounds are smaller, found among every 64th and then among the 64 after it."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds]) if len(bounds) < COARSE else F.from_json(
        F.lit(str(bounds)), "array<bigint>")
    if len(bounds) <= COARSE:
        return F.coalesce(F.size(F.filter(table, lambda b: b < value)), F.lit(0))
    coarse = F.from_json(F.lit(str(bounds[COARSE - 1::COARSE])), "array<bigint>")
    skip = F.size(F.filter(coarse, lambda b: b < value)) * COARSE
    return let(skip, lambda k: k + F.size(F.filter(F.slice(table, k + 1, F.lit(COARSE)), lambda b: b < value)))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sketch and the text and sketch of the next document by descending doc_id.

    The last document is followed by the first.  Null ids come last; equal ids go by text hash.
    Buckets of ids are ordered on their own; the top row of each also goes, as a ghost, to the bucket
    above, whose last row it follows.
    """
    bounds = id_bounds(docs)
    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "bucket", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(place(F.col("doc_id"), bounds)))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("ghost"))
    if bounds:
        last = F.col("bucket") == len(bounds) - 1
        is_top = F.col("doc_id") == F.get(F.from_json(F.lit(str(bounds)), "array<bigint>"), F.col("bucket"))
        above = F.struct(F.when(last, F.lit(0)).otherwise(F.col("bucket") + 1).alias("bucket"),
                         F.when(last, F.lit(2)).otherwise(F.lit(1)).alias("ghost"))
        seats = F.when(is_top, F.array(own, above)).otherwise(F.array(own))
    else:
        seats = F.array(own)
    seated = rows.select("doc_id", "text", F.explode(seats).alias("seat")).select(
        "doc_id", "text", F.col("seat.bucket").alias("bucket"), F.col("seat.ghost").alias("ghost"))
    order = Window.partitionBy("bucket").orderBy(
        (F.col("ghost") == 2).asc(), F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text", "ghost")
    # Sketches are made after the texts have moved, so they never travel.
    sketched = seated.repartition("bucket").withColumn("sketch", sketch(F.col("text")))
    return sketched.withColumns({
        "next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order),
    }).filter("ghost = 0").drop("bucket", "ghost")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has the last third of its code points replaced by the first as many of the next
    document.  Null texts count as empty; repeated rows each give a row; an empty table gives none.
    """
    n, next_text = F.length("text"), F.coalesce("next_text", F.lit(""))
    third = F.floor(n / 3).cast("int")
    edited = with_next(docs).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - third), F.substring(next_text, F.lit(1), third)))
    empty = F.array().cast("array<bigint>")
    made = edited.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"), "sketch",
        F.coalesce("next_sketch", empty).alias("next_sketch"), sketch(F.col("edited")).alias("edited_sketch"))
    return made.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_contained"))
