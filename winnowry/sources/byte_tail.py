"""Logs that grow, read by byte offsets: a source that streams what was appended, or reads files from their ends.

``register`` makes it known as format ``byte_tail``.  Options: ``path`` (a file or a folder, any
location pyarrow knows), ``suffix`` of wanted names, ``partitionBytes`` (bytes of one task, 32 MB),
and for batch reads ``maxBytes`` and ``maxLines`` of each file's end.

As a stream the offset is the number of bytes read of every file.  A file that shrank, or whose first
bytes changed, was replaced and is read from its start.  A line counts once its line feed is written.
Lines are decoded as UTF-8, with undecodable bytes replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file string, modified timestamp, start bigint, line string"
ARROW = pa.schema([("file", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("start", pa.int64()), ("line", pa.string())])
HEAD = 256  # first bytes that tell whether a file is still the same
STEP = 1 << 16
ROWS = 8192  # lines of an Arrow batch


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(path: str, suffix: str) -> list[fs.FileInfo]:
    """Wanted files, by name; none where nothing is there yet."""
    system, root = opened(path)
    found = system.get_file_info(root)
    if found.type == fs.FileType.File:
        return [found]
    below = system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
    return sorted((f for f in below if f.type == fs.FileType.File and f.base_name.endswith(suffix)
                   and not f.base_name.startswith((".", "_"))), key=lambda f: f.path)


def complete(file, size: int, known: int) -> int:
    """Bytes up to the last line feed; the file is searched from its end, back to what is known."""
    end = size
    while end > known:
        begin = max(known, end - STEP)
        file.seek(begin)
        at = file.read(end - begin).rfind(b"\n")
        if at >= 0:
            return begin + at + 1
        end = begin
    return known


def head(file, size: int) -> list[int]:
    """Length and checksum of the first bytes."""
    file.seek(0)
    return [min(HEAD, size), zlib.crc32(file.read(min(HEAD, size)))]


@dataclass
class Range(InputPartition):
    """Lines of a file that start in [begin, end); ``first`` starts one, and none reaches beyond ``stop``."""

    file: str
    modified: float
    first: int
    begin: int
    end: int
    stop: int


@dataclass
class Ends(InputPartition):
    """Files of which the ends are read: path, size and time."""

    files: list[tuple[str, int, float]]


def in_batches(rows: Iterator[tuple[str, float, int, str]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for file, modified, start, line in rows:
        held.append((file, int(modified * 1e6), start, line))
        if len(held) == ROWS:
            yield batch_of(held)
            held = []
    if held:
        yield batch_of(held)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)


def lines_in(root: str, part: Range) -> Iterator[tuple[str, float, int, str]]:
    """The lines of a range, read in steps; a carriage return before the line feed goes."""
    system, _ = opened(root)
    with system.open_input_file(part.file) as file:
        at = part.begin
        if at > part.first:  # unless a line feed precedes it, the first piece belongs to the range before
            file.seek(at - 1)
            at = next_line(file, at - 1, part.stop)
        held: list[bytes] = []  # pieces of the line that goes on
        start = at
        while start < part.end and at < part.stop:
            file.seek(at)
            piece = file.read(min(STEP, part.stop - at))
            at += len(piece)
            *whole, rest = piece.split(b"\n")
            for line in whole:
                if start >= part.end:
                    return
                line, held = b"".join([*held, line]), []
                yield part.file, part.modified, start, line.removesuffix(b"\r").decode("utf-8", "replace")
                start += len(line) + 1
            held.append(rest)


def next_line(file, at: int, stop: int) -> int:
    """Where the first line after ``at`` begins."""
    while at < stop:
        file.seek(at)
        found = file.read(min(STEP, stop - at)).find(b"\n")
        if found >= 0:
            return at + found + 1
        at = min(at + STEP, stop)
    return stop


class GrowingFiles(DataSourceStreamReader):
    """Micro-batches of the bytes that were appended since the last one."""

    def __init__(self, options: dict):
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.piece = int(options.get("partitionbytes", options.get("partitionBytes", 32 << 20)))
        self.seen: dict[str, list] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Per file: complete bytes, length and checksum of its head, and its time."""
        out = {}
        system, _ = opened(self.path)
        for info in listed(self.path, self.suffix):
            old = self.seen.get(info.path)
            if old and old[4] == [info.size, info.mtime_ns]:
                out[info.path] = old
                continue
            with system.open_input_file(info.path) as file:
                size = file.size()
                same = old is not None and size >= old[0] and head(file, old[1]) == old[1:3]
                end = complete(file, size, old[0] if same else 0)
                if end:
                    out[info.path] = [end, *head(file, end), info.mtime_ns / 1e9, [info.size, info.mtime_ns]]
        self.seen = out
        return out

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        system, _ = opened(self.path)
        for name, (stop, _, _, modified, _) in sorted(end.items()):
            first = 0
            if old := start.get(name):
                with system.open_input_file(name) as file:
                    first = old[0] if stop >= old[0] and head(file, old[1]) == old[1:3] else 0
            for begin in range(first, stop, self.piece):
                out.append(Range(name, modified, first, begin, min(stop, begin + self.piece), stop))
        return out

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the stream's own checkpoint."""

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return in_batches(lines_in(self.path, partition))


class FileEnds(DataSourceReader):
    """The last lines of every file, from no more than ``maxBytes`` of its end; all line ends of Unicode end a line here."""

    def __init__(self, options: dict):
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.most = int(options.get("maxbytes", options.get("maxBytes", 65536)))
        self.keep = int(options.get("maxlines", options.get("maxLines", 20)))
        self.piece = int(options.get("partitionbytes", options.get("partitionBytes", 32 << 20)))

    def partitions(self) -> list[Ends]:
        files = [(f.path, f.size, f.mtime_ns / 1e9) for f in listed(self.path, self.suffix) if f.size]
        each = max(1, self.piece // max(1, self.most))
        return [Ends(files[i:i + each]) for i in range(0, len(files), each)] or [Ends([])]

    def read(self, partition: Ends) -> Iterator[pa.RecordBatch]:
        return in_batches(row for f in partition.files for row in self.end_of(*f))

    def end_of(self, name: str, size: int, modified: float) -> Iterator[tuple[str, float, int, str]]:
        """The piece after the first line feed, unless it begins the file or has none; then its last lines."""
        system, _ = opened(self.path)
        begin = size - min(self.most, size)
        with system.open_input_file(name) as file:
            file.seek(begin)
            data = file.read(size - begin)
        if begin:
            cut = data.find(b"\n") + 1
            begin, data = begin + cut, data[cut:]
        found: list[tuple[int, str]] = []
        lines = data.split(b"\n")
        for line in lines[:-1] if not lines[-1] else lines:
            found += [(begin, part) for part in line.decode("utf-8", "replace").splitlines() or [""]]
            begin += len(line) + 1
        for start, line in found[-self.keep:]:
            yield name, modified, start, line


class ByteTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "byte_tail"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FileEnds(dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return GrowingFiles(dict(self.options))


def register(spark: SparkSession, source: type[DataSource] = ByteTail) -> None:
    """Make a source known by its name; a session that inherited it already knows it."""
    try:
        spark.dataSource.register(source)
    except AnalysisException as e:
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise


def growing_lines(spark: SparkSession, path: str, suffix: str = "", partition_bytes: int = 32 << 20) -> DataFrame:
    """A stream of (file, modified, start, line): every complete line once, however files grow or are replaced."""
    register(spark)
    return spark.readStream.format("byte_tail").option("suffix", suffix).option("partitionBytes", partition_bytes).load(path)


def last_lines(spark: SparkSession, path: str, lines: int = 20, max_bytes: int = 65536, suffix: str = "") -> DataFrame:
    """(file, modified, start, line): the last lines of every file, from at most ``max_bytes`` of its end.

    A piece that does not begin the file loses its first, cut line; an unfinished last line counts.
    """
    register(spark)
    return spark.read.format("byte_tail").option("suffix", suffix).option("maxBytes", max_bytes).option("maxLines", lines).load(path)
