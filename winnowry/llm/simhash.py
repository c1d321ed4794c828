"""Near-duplicate documents by SimHash fingerprints, compared exactly in tiles.

Equal fingerprints are one node from the start.  Nodes of the same population count (number of set
bits) are cut into tiles; fingerprints that differ in at most ``radius`` bits have population counts
at most that far apart, so only tiles of such counts meet.  Each meeting of two tiles is a task of
bounded size: numpy exclusive-or and bit counts over small blocks, of which those are skipped whose
population counts, quarter word by quarter word, are too far apart.  A meeting reports a spanning
forest of the links it found, at most one link a fingerprint, so dense groups cost no more than others.

The number of meetings grows with the square of the number of distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import stored, with_found, word_pieces
from winnowry.llm.components import components

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 1 << 15  # fingerprints of a tile: 256 KB
BLOCK = 256  # fingerprints of a block inside a tile
TASKS = 100_000  # meetings beyond that share tasks
MANY = 1 << 16  # shingle hashes whose bits are counted at once
QUARTERS = np.array([0, 16, 32, 48], np.uint64)


def fingerprint(text: bytes | None, n: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits: those set in more than half of the XXH64 hashes of the n-word shingles, repeats included.

    Fewer than n words are one shingle; without words no bit is set.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, total, before = np.zeros(64, np.int64), 0, []
    for found in word_pieces((text or b"").lower()):  # bytes: only A-Z change, only ASCII space splits
        words = before + found
        if len(words) < n:
            before = words
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        spans = zip(starts[:len(words) - n + 1].tolist(), (starts + sizes)[n - 1:].tolist(), strict=True)
        h = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - n + 1)
        for at in range(0, len(h), MANY):
            part = h[at:at + MANY]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
        before = words[len(words) - n + 1:] if n > 1 else []
    if not total and before:
        return digest(b" ".join(before), seed)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row; stored."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), n, seed) for t in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))], schema=schema)

    return stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        run, "doc_id bigint, fp bigint"), "simhash-fingerprints")


def tiles(nodes: DataFrame, size: int) -> tuple[DataFrame, dict[int, int]]:
    """bits, tile, fps (one binary a tile), and the number of tiles by population count, which has 65 values.

    A fingerprint's tile is a hash of it, over as many tiles as its population count needs.
    """
    bits = F.bit_count("fp")
    counts = {r["bits"]: -(-r["n"] // size) for r in nodes.groupBy(bits.alias("bits")).agg(F.count("*").alias("n")).collect()}
    of_bits = F.create_map(*[F.lit(x).cast("bigint") for pair in counts.items() for x in pair]) if counts else F.lit(None)
    dealt = nodes.select("fp", bits.alias("bits")).withColumn(
        "tile", F.pmod(F.xxhash64("fp"), of_bits[F.col("bits").cast("bigint")]) if counts else F.lit(0).cast("bigint"))
    schema = "bits int, tile bigint, fps binary"

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bits": [key[0]], "tile": [key[1]], "fps": [group["fp"].to_numpy(np.int64).tobytes()]})

    return stored(dealt.groupBy("bits", "tile").applyInPandas(pack, schema), "simhash-tiles"), counts


def met(counts: dict[int, int], radius: int) -> int:
    """How many meetings there are, from the number of tiles by population count."""
    return sum(n * counts.get(b + d, 0) if d else n * (n + 1) // 2 for b, n in counts.items() for d in range(radius + 1))


def meetings(tiled: DataFrame, counts: dict[int, int], radius: int) -> DataFrame:
    """meeting, left, right: every two tiles whose population counts are at most ``radius`` apart, once.

    The tiles name their meetings themselves, from the tile numbers by population count.  A tile also meets itself.
    """
    if not counts:
        return tiled.select(F.lit("").alias("meeting"), F.col("fps").alias("left"), F.col("fps").alias("right")).limit(0)
    number = F.create_map(*[F.lit(x).cast("bigint") for b in range(-radius, 65 + radius) for x in (b, counts.get(b, 0))])
    others = F.flatten(F.transform(
        F.filter(F.sequence(F.col("bits") - radius, F.col("bits") + radius), lambda b: number[b.cast("bigint")] > 0),
        lambda b: F.transform(F.sequence(F.lit(0).cast("bigint"), number[b.cast("bigint")] - 1),
                              lambda t: F.struct(b.alias("bits"), t.alias("tile")))))
    own = F.struct("bits", "tile")
    told = tiled.select("fps", own.alias("own"), F.explode(others).alias("other"))
    name = F.array_join(F.array(*[F.col(c).cast("string") for c in ("low.bits", "low.tile", "high.bits", "high.tile")]), ":")
    named = told.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).withColumn("meeting", name)
    # Meetings are small in bytes and long in time: they are dealt by number, not merged by size.
    named = named.repartition(min(TASKS, met(counts, radius)), "meeting")
    return named.groupBy("meeting").agg(
        F.max(F.when(F.col("own") == F.col("low"), F.col("fps"))).alias("left"),
        F.max(F.when(F.col("own") == F.col("high"), F.col("fps"))).alias("right"))


def ordered(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints in the order of their quarters' population counts, and these counts."""
    parts = np.bitwise_count((fps[:, None] >> QUARTERS) & np.uint64(0xFFFF)).astype(np.int16)
    order = np.lexsort(parts.T[::-1])
    return fps[order], parts[order]


def spans(parts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest population counts of every block."""
    starts = np.arange(0, len(parts), block)
    return np.minimum.reduceat(parts, starts), np.maximum.reduceat(parts, starts)


class Forest:
    """Components of numbered nodes that are joined in arrays; remembers a spanning forest."""

    def __init__(self, size: int):
        self.root = np.arange(size)
        self.joined: list[tuple[int, int]] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join a[i] with b[i]; pairs that are together already cost one comparison."""
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            high, at = np.unique(np.maximum(ra, rb), return_index=True)  # each root is hung below one smaller root
            self.joined += zip(a[at].tolist(), b[at].tolist(), strict=True)
            self.root[high] = np.minimum(ra, rb)[at]
            while ((up := self.root[self.root]) != self.root).any():
                self.root = up


def tile_links(left: bytes, right: bytes, radius: int, block: int = BLOCK) -> np.ndarray:
    """A spanning forest, as rows of two fingerprints, of all pairs of the tiles that differ in at most ``radius`` bits."""
    one = left == right
    a, pa_ = ordered(np.frombuffer(left, np.int64).view(np.uint64))
    b, pb = (a, pa_) if one else ordered(np.frombuffer(right, np.int64).view(np.uint64))
    (low_a, high_a), (low_b, high_b) = spans(pa_, block), spans(pb, block)
    forest, shift = Forest(len(a) if one else len(a) + len(b)), 0 if one else len(a)
    for i in range(len(low_a)):
        gap = np.maximum(0, np.maximum(low_a[i] - high_b, low_b - high_a[i])).sum(axis=1)
        u = a[i * block:(i + 1) * block, None]
        for j in np.flatnonzero(gap <= radius).tolist():
            if one and j < i:
                continue
            x, y = np.nonzero(np.bitwise_count(u ^ b[None, j * block:(j + 1) * block]) <= radius)
            if len(x):
                forest.join(x + i * block, y + (j * block + shift))
    both = a if one else np.concatenate([a, b])
    return both[np.array(forest.joined, np.int64).reshape(-1, 2)].view(np.int64)


def links(nodes: DataFrame, radius: int, tile: int) -> DataFrame:
    """a, b: links that connect all fingerprints within ``radius`` bits of each other; stored."""
    tiled, counts = tiles(nodes, tile)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch["left"], batch["right"], strict=True):
                found = tile_links(left.as_py(), right.as_py(), radius)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], schema=schema)

    return stored(meetings(tiled, counts, radius).select("left", "right").mapInArrow(run, "a bigint, b bigint"), "simhash-links")


def simhash_duplicates(docs: DataFrame, n: int = SHINGLE, seed: int = SEED, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs`` (doc_id, text).

    Two documents are linked if their fingerprints differ in at most ``radius`` bits; component_id is the
    smallest doc_id that links reach, its own included.  Null, empty and blank texts have the fingerprint
    zero and are linked like any other.  Rows without a doc_id take no part: their component_id is null.
    Rows that repeat a doc_id keep their own fingerprints, so each has the component of its text.
    """
    made = fingerprints(docs, n, seed)
    nodes = stored(made.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    roots = components(links(nodes, radius, tile))
    rooted = stored(nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "simhash-least")
    named = with_found(rooted.select("fp", F.col("n").alias("rows"), "root"), least, "root")
    found = stored(named.select("fp", F.col("rows").alias("n"), "component_id"), "simhash-components")
    return with_found(made, found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
