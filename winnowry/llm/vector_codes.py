"""Vector code compression: product codebooks trained by exact dual-tree Lloyd rounds over integers.

Vectors become integers and are cut into equal parts; every part position has its own codebook.  Blocks
of vectors are put into one balanced tree for each part position, once; a node knows the box around its
parts and their sum.  The entries of a codebook form a small tree of boxes as well.  A round descends
both trees together: an entry node whose box is farther from a part node than another is at most is
pruned for all parts below.  A node with one entry left is assigned whole, by its cached sum.  Only
leaves that stay uncertain compare their parts with the entries left, in integers.  All bounds are
integers too, so the result is that of comparing every part with every entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import stored, with_found

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 4096  # vectors of one set of trees
LEAF = 32  # parts of a leaf at most
LIMIT = 1 << 25  # of an integer component, so that squared distances of parts up to 2048 wide stay exact


@dataclass
class Tree:
    """Balanced tree over rows: level l has 2 ** l nodes, node i of n rows holds rows n * i // 2 ** l to n * (i + 1) // 2 ** l."""

    rows: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]

    def edges(self, level: int) -> np.ndarray:
        return len(self.rows) * np.arange((1 << level) + 1) >> level

    @property
    def depth(self) -> int:
        return len(self.low) - 1


def boxed(rows: np.ndarray, depth: int) -> Tree:
    """The tree over rows in their final order."""
    edges = [(len(rows) * np.arange(1 << level)) >> level for level in range(depth + 1)]
    return Tree(rows, *([f.reduceat(rows, e, axis=0) for e in edges] for f in (np.minimum, np.maximum, np.add)))


def planted(rows: np.ndarray, leaf: int) -> tuple[np.ndarray, Tree]:
    """Order and tree of integer rows (at least one): every node is halved along its widest side."""
    depth = max(0, int(np.ceil(np.log2(len(rows) / leaf)))) if len(rows) > leaf else 0
    order = np.arange(len(rows))
    for level in range(depth):
        edges = (len(rows) * np.arange((1 << level) + 1)) >> level
        own = rows[order]
        widest = (np.maximum.reduceat(own, edges[:-1], axis=0) - np.minimum.reduceat(own, edges[:-1], axis=0)).argmax(axis=1)
        node = np.repeat(np.arange(1 << level), np.diff(edges))
        order = order[np.lexsort((own[np.arange(len(own)), widest[node]], node))]
    return order, boxed(rows[order], depth)


def entry_tree(entries: np.ndarray) -> tuple[np.ndarray, Tree]:
    """Index by leaf and tree of a codebook; leaves are single entries.

    Of equal entries only the first can be nearest, so the others stay out.  Copies of the last entry
    fill up a power of two; their index is -1.
    """
    first = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    full = 1 << (len(first) - 1).bit_length()
    index = np.concatenate([first, np.full(full - len(first), first[-1])])
    order, tree = planted(entries[index], 1)
    return np.where(order < len(first), index[order], -1), tree


def meet(parts: Tree, entries: np.ndarray) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Nearest entries of all parts, the lower index among equally near ones.

    Returns the nodes that were assigned whole (level, nodes, entries), and the rows of uncertain
    leaves with their entries.
    """
    order, book = entry_tree(entries)
    whole: list[tuple[int, np.ndarray, np.ndarray]] = []
    q, r, ql, rl = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while True:
        low_q, high_q, low_r, high_r = parts.low[ql][q], parts.high[ql][q], book.low[rl][r], book.high[rl][r]
        least = (np.maximum(0, np.maximum(low_q - high_r, low_r - high_q)) ** 2).sum(axis=1)
        most = (np.maximum(high_q - low_r, high_r - low_q) ** 2).sum(axis=1)
        starts = np.flatnonzero(np.append(True, q[1:] != q[:-1]))  # pairs stay in the order of q
        sizes = np.diff(np.append(starts, len(q)))
        near = least <= np.repeat(np.minimum.reduceat(most, starts), sizes)
        q, r = q[near], r[near]
        if single := rl == book.depth:
            real = order[r] >= 0
            q, r = q[real], r[real]
            alone = np.ones(len(q), bool)
            alone[1:] &= q[1:] != q[:-1]
            alone[:-1] &= q[1:] != q[:-1]
            whole.append((ql, q[alone], order[r[alone]]))
            q, r = q[~alone], r[~alone]
        if not len(q) or (single and ql == parts.depth):
            break
        if rl < book.depth:
            q, r, rl = np.repeat(q, 2), (2 * r[:, None] + np.arange(2)).ravel(), rl + 1
        if ql < parts.depth:
            starts = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
            sizes = np.diff(np.append(starts, len(q)))
            # both children of a node take over its entries: [a b c] becomes [a b c][a b c]
            at = np.arange(len(q)) - np.repeat(starts, sizes)
            place = 2 * np.repeat(starts, sizes) + at
            nq, nr = np.empty(2 * len(q), np.int64), np.empty(2 * len(q), np.int64)
            for child, to in ((0, place), (1, place + np.repeat(sizes, sizes))):
                nq[to], nr[to] = 2 * q + child, r
            q, r, ql = nq, nr, ql + 1
    if not len(q):
        return whole, np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = parts.edges(ql)
    begin, size = edges[q], edges[q + 1] - edges[q]
    row = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    entry = np.repeat(order[r], size)
    known, at = np.unique(row, return_inverse=True)
    far = np.full((len(known), len(entries)), np.iinfo(np.int64).max)
    far[at, entry] = ((parts.rows[row] - entries[entry]) ** 2).sum(axis=1)
    return whole, known, far.argmin(axis=1)


def gathered(parts: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and sum of the parts that each entry is nearest to."""
    counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    whole, rows, own = meet(parts, entries)
    for level, nodes, entry in whole:
        np.add.at(counts, entry, np.diff(parts.edges(level))[nodes])
        np.add.at(sums, entry, parts.sums[level][nodes])
    np.add.at(counts, own, 1)
    np.add.at(sums, own, parts.rows[rows])
    return counts, sums


def assigned(parts: Tree, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of every row of the tree."""
    out = np.zeros(len(parts.rows), np.int64)
    whole, rows, own = meet(parts, entries)
    for level, nodes, entry in whole:
        edges = parts.edges(level)
        size = edges[nodes + 1] - edges[nodes]
        at = np.repeat(edges[nodes] - np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64), size) + np.arange(size.sum())
        out[at] = np.repeat(entry, size)
    out[rows] = own
    return out


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, xs of the usable rows: floor(scale * component), all components finite and within LIMIT.

    All have the most frequent length, the shorter one among equally frequent.
    """
    x = F.transform(F.col("embedding"), lambda c: F.floor(c.cast("double") * scale))
    usable = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * scale < LIMIT))
    made = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(usable).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), x.alias("xs"))
    made = stored(made, "codes-integers")
    width = made.groupBy(F.size("xs").alias("width")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "width").first()
    return made.filter(F.size("xs") == (width["width"] if width else 0))


def cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """Begin and end of every part; widths differ by one at most where they cannot be equal."""
    return [(width * p // parts, width * (p + 1) // parts) for p in range(parts)]


TREES = pa.schema([("vec_ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("orders", pa.list_(pa.binary())),
                   ("rows", pa.list_(pa.binary())), ("boxes", pa.list_(pa.binary())), ("sums", pa.list_(pa.binary()))])


def trees(vectors: DataFrame, parts: int, block: int, leaf: int) -> DataFrame:
    """Blocks of vectors with one tree for each part position; stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, block):
                own = batch.slice(begin, block)
                xs = own["xs"].flatten().to_numpy().reshape(own.num_rows, -1)
                made = [planted(xs[:, a:b], leaf) for a, b in cuts(xs.shape[1], parts) if a < b]
                columns = [[own["vec_id"].to_pylist()], [own["label"].to_pylist()],
                           [[order.astype("<i4").tobytes() for order, _ in made]],
                           [[t.rows.astype("<i4").tobytes() for _, t in made]],
                           [[np.concatenate(t.low + t.high).astype("<i4").tobytes() for _, t in made]],
                           [[np.concatenate(t.sums).astype("<i8").tobytes() for _, t in made]]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, TREES, strict=True)], schema=TREES)

    return stored(vectors.mapInArrow(run, "vec_ids array<bigint>, labels array<bigint>, orders array<binary>, rows array<binary>,"
                                          " boxes array<binary>, sums array<binary>"), "codes-trees")


def read_trees(block: dict, width: int, parts: int) -> Iterator[tuple[np.ndarray, Tree]]:
    """Order and tree of every part position of a stored block."""
    for (a, b), order, rows, boxes, sums in zip(
            [c for c in cuts(width, parts) if c[0] < c[1]], block["orders"], block["rows"], block["boxes"], block["sums"], strict=True):
        w = b - a
        rows = np.frombuffer(rows, "<i4").astype(np.int64).reshape(-1, w)
        boxes = np.frombuffer(boxes, "<i4").astype(np.int64).reshape(2, -1, w)
        sums = np.frombuffer(sums, "<i8").reshape(-1, w)
        at = [(1 << level) - 1 for level in range((len(sums) + 1).bit_length())]
        level = [slice(x, y) for x, y in zip(at, at[1:], strict=False)]
        yield np.frombuffer(order, "<i4"), Tree(rows, [boxes[0][s] for s in level], [boxes[1][s] for s in level], [sums[s] for s in level])


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def lloyd_round(planted_trees: DataFrame, books: list[np.ndarray], width: int, parts: int) -> list[np.ndarray]:
    """Every entry replaced by the floored mean of its parts; unused entries stay.

    A task sends one sum for each component of each entry; the driver receives their totals.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("part", "entry", "place", "total")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for block in blocks(batches):
            for total, book, (_, tree) in zip(totals, books, read_trees(block, width, parts), strict=True):
                counts, sums = gathered(tree, book)
                total[:, 0] += counts
                total[:, 1:] += sums
        for p, total in enumerate(totals):
            entry, place = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(entry), p)), pa.array(entry), pa.array(place), pa.array(total[entry, place])], schema=schema)

    totals = [np.zeros((len(b), b.shape[1] + 1), object) for b in books]
    for r in planted_trees.mapInArrow(run, "part bigint, entry bigint, place bigint, total bigint").groupBy("part", "entry", "place").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        totals[r["part"]][r["entry"], r["place"]] = int(r["total"])
    return [np.array([[s // t[0] for s in t[1:]] if t[0] else list(old) for t, old in zip(total, book, strict=True)], np.int64)
            for total, book in zip(totals, books, strict=True)]


def encoded(planted_trees: DataFrame, books: list[np.ndarray], width: int, parts: int) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("code", pa.string()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n = len(block["vec_ids"])
            codes, error = np.zeros((n, len(books)), np.uint8), np.zeros(n, np.int64)
            for p, (book, (order, tree)) in enumerate(zip(books, read_trees(block, width, parts), strict=True)):
                own = assigned(tree, book)
                codes[order, p] = own
                error[order] += ((tree.rows - book[own]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([
                pa.array(block["vec_ids"], pa.int64()), pa.array(block["labels"], pa.int64()),
                pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)], schema=schema)

    return planted_trees.mapInArrow(run, "vec_id bigint, label bigint, code string, error bigint")


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
          block: int = BLOCK, leaf: int = LEAF) -> tuple[DataFrame, list[np.ndarray], int]:
    """The stored trees of the usable vectors, the codebooks after all rounds, and the length of a vector."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    usable = integer_vectors(vectors, scale)
    first = [r["xs"] for r in usable.orderBy(F.col("vec_id").asc_nulls_last(), "xs").limit(entries).select("xs").collect()]
    width = len(first[0]) if first else 0
    start = np.array(first, np.int64).reshape(len(first), width)
    books = [start[:, a:b] for a, b in cuts(width, parts) if a < b]
    grown = trees(usable, parts, block, leaf)
    for _ in range(rounds if books else 0):
        books = lloyd_round(grown, books, width, parts)
    return grown, books, width


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the usable rows of ``vectors`` (vec_id, embedding, label).

    Rows whose vector is null, empty, or has null, non-finite or huge components (LIMIT after scaling) are
    dropped, as are vectors of another length than most.  Codebooks start from the smallest vec_ids, among
    equal ones from the smaller vector; rows without a vec_id come last.  Rows that repeat a vec_id are
    vectors of their own.  With fewer vectors than entries there are as many entries as vectors.
    """
    grown, books, width = train(vectors, parts, entries, rounds, scale, block, leaf)
    made = stored(encoded(grown, books, width, parts), "codes")
    sums = stored(made.groupBy("label").agg(F.count("*").alias("n"), F.sum("error").alias("label_error")), "codes-labels")
    return with_found(made, sums, "label").select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
