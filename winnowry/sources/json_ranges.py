"""Large JSON arrays read by many tasks.

A file is cut into byte ranges.  What a range does to the reader depends on where it starts: outside a
string, inside one, or behind a backslash.  Every range is lexed for all three, which tells the state
and the depth it leaves; put together in order, they give every range its true start.  Each range then
emits the elements that begin in it, reading on where the last one ends later.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from winnowry.functions import json_text
from winnowry.sources.byte_tail import listed, opened, register

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
QUOTE, BACKSLASH, COMMA = ord('"'), ord("\\"), ord(",")
OPENING, CLOSING = np.frombuffer(b"[{", np.uint8), np.frombuffer(b"]}", np.uint8)
WHITE = np.frombuffer(b" \t\r\n", np.uint8)
STEP = 1 << 20


def lexed(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Which bytes are outside strings (quotes excluded), and the state after the last byte."""
    if not len(data):
        return np.zeros(0, bool), state
    at = np.arange(len(data))
    plain = data != BACKSLASH
    last = np.maximum.accumulate(np.where(plain, at, -1))  # last byte that is no backslash, up to here
    before = np.concatenate([[-1], last[:-1]])
    run = at - before - 1  # backslashes right before
    # A run that begins the range goes on behind an escaped byte, so its first backslash is spent.
    run = run - ((before == -1) & (run > 0) & (state == ESCAPED))
    escaped = run % 2 == 1
    if state == ESCAPED:
        escaped[0] = True
    quotes = (data == QUOTE) & ~escaped
    inside = (np.cumsum(quotes) + (state != OUTSIDE)) % 2 == 1
    tail = len(data) - 1 - last[-1] - int(last[-1] == -1 and state == ESCAPED)
    end = OUTSIDE if not inside[-1] else ESCAPED if tail % 2 == 1 else INSIDE
    return ~inside & ~quotes, end


def depths(data: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Nesting after each byte, relative to the start."""
    return np.cumsum((np.isin(data, OPENING) & outside).astype(np.int64) - (np.isin(data, CLOSING) & outside))


@dataclass
class Piece(InputPartition):
    """Bytes [begin, end) of a file of ``size`` bytes; with a start once it is known."""

    file: str
    size: int
    begin: int
    end: int
    state: int = OUTSIDE
    depth: int = 0
    begun: bool = False  # whether anything but white space came before


def read_range(root: str, piece: Piece) -> np.ndarray:
    system, _ = opened(root)
    with system.open_input_file(piece.file) as file:
        file.seek(piece.begin)
        return np.frombuffer(file.read(piece.end - piece.begin), np.uint8)


def effects(root: str, piece: Piece) -> list[tuple[int, int, bool]]:
    """State and depth change behind a range, and whether it has more than white space, for each state before it."""
    data = read_range(root, piece)
    solid = bool((~np.isin(data, WHITE)).any())
    out = []
    for state in (OUTSIDE, INSIDE, ESCAPED):
        outside, end = lexed(data, state)
        total = depths(data, outside)
        out.append((end, int(total[-1]) if len(total) else 0, solid))
    return out


def elements(root: str, piece: Piece) -> Iterator[tuple[int, str | None]]:
    """(start, text) of the array elements that begin in a range; text is None where no single, closed array can be.

    An element begins behind the opening bracket or a comma at depth one, and ends before the next comma
    or the closing bracket.  An empty array has one element without text.
    """
    data = read_range(root, piece)
    outside, state = lexed(data, piece.state)
    level = depths(data, outside) + piece.depth
    before = np.concatenate([[piece.depth], level[:-1]])
    white = np.isin(data, WHITE)
    opens, closes = outside & (before == 0) & (level == 1), outside & (before == 1) & (level == 0)
    last = piece.end == piece.size
    wrong = (((level == 0) & (before == 0) & ~white).any()  # something beside the array
             or (level < 0).any() or (data[opens] != ord("[")).any() or (data[closes] != ord("]")).any()
             or opens.sum() > int(not piece.begun)  # another array
             or last and (state != OUTSIDE or level[-1] != 0)  # cut short
             or last and not piece.begun and white.all())  # nothing at all
    if wrong:
        yield -1, None
        return
    commas = outside & (level == 1) & (data == COMMA)
    starts, ends = np.flatnonzero(commas | opens) + 1, np.flatnonzero(commas | closes)
    raw, system = data.tobytes(), opened(root)[0]
    for start, stop in zip(starts.tolist(), np.searchsorted(ends, starts).tolist(), strict=True):
        if stop < len(ends):
            text, closed = raw[start:ends[stop]], closes[ends[stop]]
        else:
            text, closed = rest_of(system, piece, raw[start:], state, int(level[-1]))
        text = text.strip(bytes(WHITE))
        empty = closed and opens[start - 1]
        yield piece.begin + start, text.decode("utf-8", "replace") if text or empty else None


def rest_of(system, piece: Piece, begun: bytes, state: int, depth: int) -> tuple[bytes, bool]:
    """An element that goes on behind its range, and whether the array closes behind it."""
    parts, at = [begun], piece.end
    with system.open_input_file(piece.file) as file:
        while at < piece.size:
            file.seek(at)
            data = np.frombuffer(file.read(min(STEP, piece.size - at)), np.uint8)
            outside, state = lexed(data, state)
            level = depths(data, outside) + depth
            found = np.flatnonzero(outside & (((level == 1) & (data == COMMA)) | (level == 0)))
            if len(found):
                parts.append(data[:found[0]].tobytes())
                return b"".join(parts), data[found[0]] != COMMA
            parts.append(data.tobytes())
            depth, at = int(level[-1]), at + len(data)
    return b"".join(parts), False


class Ranges(DataSourceReader):
    """Effects of all ranges, or the elements of ranges with known starts."""

    def __init__(self, options: dict):
        low = {k.lower(): v for k, v in options.items()}
        self.path, self.suffix, self.size = low["path"], low.get("suffix", ""), int(low["rangebytes"])
        self.starts = json.loads(low["starts"]) if "starts" in low else None

    def partitions(self) -> list[Piece]:
        out = []
        for f in listed(self.path, self.suffix):
            known = self.starts.get(f.path, []) if self.starts is not None else None
            for k, begin in enumerate(range(0, f.size, self.size)):
                start = known[k] if known else [OUTSIDE, 0, False]
                out.append(Piece(f.path, f.size, begin, min(f.size, begin + self.size), *start))
        return out or [Piece("", 0, 0, 0)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        if self.starts is None:
            yield pa.RecordBatch.from_pydict({"file": [partition.file], "start": pa.array([partition.begin], pa.int64()),
                                              "value": [json.dumps(effects(self.path, partition))]})
            return
        held: list[tuple[int, str | None]] = []
        for row in elements(self.path, partition):
            held.append(row)
            if len(held) == 4096:
                yield self.batch(partition, held)
                held = []
        if held:
            yield self.batch(partition, held)

    def batch(self, partition: Piece, rows: list[tuple[int, str | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [partition.file] * len(rows), "start": pa.array([r[0] for r in rows], pa.int64()),
                                           "value": pa.array([r[1] for r in rows], pa.string())})


class JsonRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_ranges"

    def schema(self) -> str:
        return "file string, start bigint, value string"

    def reader(self, schema) -> DataSourceReader:
        return Ranges(dict(self.options))


def array_elements(spark: SparkSession, path: str, suffix: str = "", range_bytes: int = 32 << 20) -> DataFrame:
    """(file, start, value) of all elements of JSON array files, whatever their size; ``start`` orders a file.

    An empty array is one row with an empty value; a file that is no single, closed array has rows with a
    null value, beside what looked like elements.  Elements are cut out, not parsed.  The driver receives
    three short effects a range, and hands every range its start.
    """
    register(spark, JsonRanges)
    reader = lambda: spark.read.format("json_ranges").option("suffix", suffix).option("rangeBytes", range_bytes)
    starts: dict[str, list[list[int]]] = {}
    state, depth, begun = OUTSIDE, 0, False
    for row in reader().load(path).orderBy("file", "start").collect():
        if row["start"] == 0:
            state, depth, begun = OUTSIDE, 0, False
        starts.setdefault(row["file"], []).append([state, depth, begun])
        state, change, solid = json.loads(row["value"])[state]
        depth, begun = depth + change, begun or solid
    return reader().option("starts", json.dumps(starts)).load(path)


def array_counts(spark: SparkSession, path: str, suffix: str = "", range_bytes: int = 32 << 20) -> DataFrame:
    """(file, rows) of JSON array files; 0 for a document that is broken or no array.  Every element is parsed."""
    found = array_elements(spark, path, suffix, range_bytes)
    refused = F.try_parse_json("value").isNull() & (F.col("value") != "")
    judged = found.withColumn("fine", json_text.decodes(F.when(refused, F.col("value"))) | ~refused)
    counted = judged.groupBy("file").agg(F.count_if(F.col("value") != "").alias("n"), F.min(F.coalesce("fine", F.lit(False))).alias("fine"))
    return counted.select("file", F.when(F.col("fine"), F.col("n")).otherwise(0).cast("bigint").alias("rows"))
