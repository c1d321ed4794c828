"""Passages that repeat across documents, found by content-defined chunks.

A gear rolling hash runs over the bytes of a text.  Its units are words; in scripts written without
spaces and in very long words every code point is one.  The greatest hash of every WINDOW units in a row
ends a chunk, so boundaries depend on nearby bytes alone, an insertion moves the chunks it touches and no
others, and no stretch goes without a boundary.  Chunks meet by digest; consecutive chunks that an earlier
document already has make a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnowry.llm.common import settled, sifted, small_batches

WINDOW = 12  # units in a row of which one ends a chunk
DIGEST_UNITS = 4  # that a digest covers at least: that of a shorter chunk reaches back
LONG_WORD = 64  # code points; those of longer words are units of their own
# Units of whole chunks.  The hashes of a copied passage agree from its 9th unit on, and the boundaries between the greatest
# of the first and of the last WINDOW such units, so 50 units always leave 19 or more, but for chance ties of the hash.
PASSAGE_WORDS = 16
HASH_BYTES = 16  # bytes that the 16-bit rolling hash remembers; 8 of them count at units of one code point
# Thai to Myanmar, Khmer, kana, Han
UNSPACED = ((0x0E00, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
            (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x20000, 0x3FFFF))
PART_TEXTS = 100  # of which the chunks are handed over at once


def gears() -> np.ndarray:
    """A fixed random 16-bit number per byte value."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(48)).astype(np.uint16)


GEARS = gears()
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hash(data: np.ndarray) -> np.ndarray:
    """hash[i] = 2 * hash[i - 1] + gear[byte i], modulo 2**16, for all i at once by doubling the span."""
    h, span = GEARS[data], 1
    while span < HASH_BYTES:
        h[span:] += h[:-span] << np.uint16(span)
        span *= 2
    return h


def units(data: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets where the units of a UTF-8 text start and end, and which of them are one code point by rule.

    ``chars`` has the number of code points before every byte offset.
    """
    inside = ~SPACE[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = chars[ends] - chars[starts] > LONG_WORD
    if not long.any() and not (data >= 0xE0).any():
        return starts, ends, np.zeros(len(starts), dtype=bool)
    first = np.flatnonzero(np.diff(chars))  # byte offsets of code points
    alone = np.zeros(len(first), dtype=bool)
    code = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    for low, high in UNSPACED:
        alone |= (code >= low) & (code <= high)
    depth = np.zeros(len(data) + 1, np.int8)
    depth[starts[long]], depth[ends[long]] = 1, -1
    alone |= np.cumsum(depth)[first] > 0
    after = np.append(first[1:], len(data))
    start, end, single = (np.zeros(len(data) + 1, dtype=bool) for _ in range(3))
    start[starts] = end[ends] = True
    start[first[alone]] = single[first[alone]] = end[after[alone]] = True
    end[first[alone][first[alone] > 0]] = True
    start[after[alone]] = True
    end[1:] &= inside  # the byte before an end and the byte at a start are no white space
    start[:-1] &= inside
    start[-1] = False
    return np.flatnonzero(start), np.flatnonzero(end), single[start]


def boundaries(h: np.ndarray) -> np.ndarray:
    """The units that end chunks: the greatest of every WINDOW in a row, and the last.

    Of equal ones, as a repeated word has them, those less than WINDOW after another are left out.
    """
    last = len(h) - 1
    if last < WINDOW:
        return np.array([last])
    windows = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
    found = np.unique(np.arange(len(windows)) + windows.argmax(axis=1))
    if ((h[found[1:]] == h[found[:-1]]) & (np.diff(found) < WINDOW)).any():
        kept = [int(found[0])]
        for i in found[1:].tolist():
            if i - kept[-1] >= WINDOW or h[i] != h[kept[-1]]:
                kept.append(i)
        found = np.array(kept)
    return found if found[-1] == last else np.append(found, last)


def chunks(text: str | None) -> list[tuple[int, int, int, int, int]]:
    """(digest, start, end, first unit, next unit) of every chunk; offsets in code points.  No words, no chunks."""
    import xxhash

    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, dtype=np.uint8)
    if not len(data):
        return []
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts, ends, single = units(data, chars)
    if not len(starts):
        return []
    h = gear_hash(data)
    near = h.copy()
    near[HASH_BYTES // 2:] -= h[:-(HASH_BYTES // 2)] << np.uint16(HASH_BYTES // 2)
    last = boundaries(np.where(single, near[ends - 1], h[ends - 1]))
    first = np.concatenate([[0], last[:-1] + 1])
    a, b = starts[first], ends[last]
    seen = starts[np.maximum(np.minimum(first, last + 1 - DIGEST_UNITS), 0)]
    digests = [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(seen.tolist(), b.tolist())]
    return list(zip(np.array(digests, np.uint64).view(np.int64).tolist(), chars[a].tolist(), chars[b].tolist(),
                    first.tolist(), (last + 1).tolist()))


def chunk_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, at, digest, start, end, w0, w1 of each chunk of each text.  Rows without an id are left out."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int32()), ("digest", pa.int64()),
                        *[(c, pa.int32()) for c in ("start", "end", "w0", "w1")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch[c].to_numpy() for c in ("doc_id", "text_hash"))
            for low in range(0, len(batch), PART_TEXTS):
                cut = [chunks(t.as_py()) for t in batch["text"].slice(low, PART_TEXTS)]
                sizes = np.array([len(c) for c in cut])
                if sizes.any():
                    flat = np.array([c for found in cut for c in found], np.int64).T
                    at = np.arange(len(flat[0])) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    each = [np.repeat(x[low:low + PART_TEXTS], sizes) for x in (ids, hashes)]
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((*each, at.astype(np.int32), flat[0], *flat[1:].astype(np.int32)), schema)], schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return source.filter("doc_id is not null").mapInArrow(
        run, "doc_id bigint, text_hash bigint, at int, digest bigint, start int, end int, w0 int, w1 int")


def repeated_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, text_hash, start, length (code points), n_words, first_doc_id of every repeated passage.

    A passage is a run of chunks that a document with a smaller id has too; first_doc_id is the first
    to have its longest chunk.  What repeats inside one document only is none, nor are runs of fewer
    units, which n_words counts.  Rows that repeat a doc_id and text give their passages once; null and empty texts have none.
    """
    # In order of doc_id the first is known as rows come by: no group is held, and chunks move once.
    by_id = Window.partitionBy("digest").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    copied = chunk_rows(docs).withColumn("first", F.min("doc_id").over(by_id)).filter("doc_id > first").drop("digest")
    by_place = Window.partitionBy("doc_id", "text_hash").orderBy("at")
    runs = copied.withColumn("run", F.col("at") - F.dense_rank().over(by_place)).groupBy("doc_id", "text_hash", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("w1") - F.min("w0")).cast("bigint").alias("n_words"),
        F.max_by("first", F.col("end") - F.col("start")).alias("first_doc_id"))
    return runs.filter(F.col("n_words") >= passage_words).select(
        "doc_id", "text_hash", F.col("start").cast("bigint").alias("start"), (F.col("end") - F.col("start")).cast("bigint").alias("length"),
        "n_words", "first_doc_id")


def without_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` with every repeated passage cut from all but its first document; n_chars follows the text.

    A document of which no word is left goes; all others stay, also those without id or text.
    """
    with small_batches(docs.sparkSession):
        spans = settled(lambda: repeated_passages(docs, passage_words).groupBy("doc_id", "text_hash").agg(
            F.array_sort(F.collect_list(F.struct("start", "length"))).alias("_cut")).toDF("_doc_id", "_text_hash", "_cut"), "cuts")
    same = (F.col("doc_id").cast("bigint") == F.col("_doc_id")) & (F.xxhash64("text") == F.col("_text_hash"))
    apart, met = sifted(docs, spans, "_doc_id")
    joined = met.join(spans, same, "left")
    gone = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("_cut", i - 1)["start"] + F.get("_cut", i - 1)["length"])
    kept = F.array_join(F.transform(F.sequence(F.lit(0), F.size("_cut")), lambda i: F.substring(
        F.col("text"), (gone(i) + 1).cast("int"), (F.coalesce(F.get("_cut", i)["start"], F.length("text")) - gone(i)).cast("int"))), "")
    out = joined.withColumn("text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return apart.unionByName(out.filter(F.col("_cut").isNull() | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(*docs.columns))
