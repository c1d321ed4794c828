"""Hierarchical best-fit packing of tokenized documents into sequences of a fixed length.

Items are packed best-fit-decreasing inside groups of bounded size.  Nearly full bins are final.
Underfull bins become the items of the next round, regrouped by fill so that fewer and fewer groups
merge like a tree, until a round saves nothing.  No task sees more than ``GROUP_ITEMS`` items on
average, however many there are: a round that cannot merge its bins ends the rounds instead of
gathering them.
"""

from __future__ import annotations

import array
import functools
import math
import re
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import small_batches, stored

CAPACITY = 4096
END_ID = 1
GROUP_ITEMS = 16384
NEARLY_FULL = 0.995
MAX_ROUNDS = 12
CACHE_WORDS = 1 << 18  # of a worker, which keeps them between tasks

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64())])
# Texts of these characters are normalized by lower-casing alone; their words can be looked up one by one.
PLAIN = re.compile("[\t\n\r -~¡-ÿ]*")
PLAIN_WORD = re.compile("[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|'(?:s|t|re|ve|m|ll|d)|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def packed_ids(ids: list[int]) -> bytes:
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordIds(dict):
    """Word to its ids as little-endian bytes, filled when asked; emptied when too large."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.model, self.letters = tokenizer.model, byte_letters()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        shown = word.encode().decode("latin-1").translate(self.letters)
        out = self[word] = packed_ids([t.id for t in self.model.tokenize(shown)])
        return out


@functools.lru_cache(maxsize=1)
def encoder(path: str):
    """text -> ids as bytes, equal to the tokenizer's own encoding without special tokens added; one for all tasks of a worker."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    known = WordIds(tokenizer)

    def encode(text: str) -> bytes:
        if "<|" in text or not PLAIN.fullmatch(text):
            return packed_ids(tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(known.__getitem__, PLAIN_WORD.findall(text.lower())))

    return encode


def tokenize(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32.

    Null texts count as empty: their document is the end id alone.  Only documents longer than the
    capacity are cut.  Repeated rows give repeated pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, width = encoder(tokenizer_path), packed_ids([END_ID]), 4 * capacity
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = encode(text.as_py() or "") + end
                for k in range(0, len(ids), width):
                    part = ids[k:k + width]
                    rows.append((doc_id, k // width, k // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[]] * len(PIECES), PIECES)], schema=PIECES)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of every item, largest first, each into the fullest bin that still takes it."""
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms: list[int] = []  # sorted room values that have bins
    used = 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        size = lengths[i]
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(at)
        else:
            room, chosen, used = capacity, used, used + 1
        bins[i], offsets[i] = chosen, capacity - room
        left = room - size
        if left:
            if not open_bins[left]:
                insort(rooms, left)
            open_bins[left].append(chosen)
    return bins, offsets


def pack_round(items: DataFrame, groups: int, capacity: int, seed: int) -> DataFrame:
    """item_id, length -> item_id, length, bin_id, offset; each group packs alone.  A bin's id is its first item's."""
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "item_id"], ascending=[False, True], kind="stable", ignore_index=True)
        bins, offsets = best_fit(group["length"].tolist(), capacity)
        group["offset"] = offsets
        first = group[group["offset"] == 0]
        names = dict(zip((bins[i] for i in first.index), first["item_id"]))
        group["bin_id"] = [names[b] for b in bins]
        return group[["item_id", "length", "bin_id", "offset"]]

    dealt = items.withColumn("dealt", F.pmod(F.xxhash64("item_id", F.lit(seed)), F.lit(groups)))
    packed = dealt.groupBy("dealt").applyInPandas(
        lambda g: pack(g[["item_id", "length"]]), "item_id bigint, length bigint, bin_id bigint, offset bigint")
    return packed


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """pieces (with ``length`` from 1 to capacity) plus sequence_id and offset.

    Full pieces are sequences of their own and take no part in packing.  Ties in length go by item id.
    An empty table stays empty.
    """
    with small_batches(pieces.sparkSession):
        named = stored(pieces.withColumn("item_id", F.monotonically_increasing_id()), "pack-items")
    items = named.select("item_id", "length")
    rest = items.filter(F.col("length") < capacity)
    placed = None  # item_id, bin_id, offset over all rounds so far, for items of unfinished and finished bins
    todo = rest
    left = todo.count()
    for step in range(MAX_ROUNDS):
        groups = max(1, math.ceil(left / group_items))
        packed = stored(pack_round(todo, groups, capacity, step), f"pack-round{step}")
        placed = packed.select("item_id", "bin_id", "offset") if placed is None else stored(
            placed.join(packed.select(F.col("item_id").alias("bin_id"), F.col("bin_id").alias("upper"),
                                      F.col("offset").alias("shift")), "bin_id", "left")
            .select("item_id", F.coalesce("upper", "bin_id").alias("bin_id"),
                    (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")), f"pack-placed{step}")
        bins = packed.groupBy("bin_id").agg(F.sum("length").alias("length"))
        under = bins.filter(F.col("length") < NEARLY_FULL * capacity).select(F.col("bin_id").alias("item_id"), "length")
        todo = stored(under, f"pack-under{step}")
        before, left = left, todo.count()
        if groups == 1 or left == 0 or (step and left > 0.98 * before):
            break
    return named.join(placed, "item_id", "left").select(
        *[c for c in named.columns if c != "item_id"],
        F.coalesce("bin_id", "item_id").alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize and pack whole documents; columns of ``tokenize`` plus sequence_id and offset."""
    return pack(tokenize(docs, tokenizer_path, capacity), capacity)
