"""A hierarchical weighted hash tree that places rows in shards.

A row descends region, rack and shard; at each level every child draws -ln(u) / weight from a hash of
the row's key and the child's name, and the smallest draw wins.  A child whose weight or presence
changes only gains or loses rows itself, and below an unchanged child every choice stays the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry.llm.common import stored

BLOCK_BITS = 15


@dataclass(frozen=True)
class Node:
    """A subtree; a leaf has a shard number.  An inner node weighs what its children weigh."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(regions: dict[str, dict[str, dict[int, float]]]) -> Node:
    """{region: {rack: {shard: weight}}} as a tree."""
    return Node("", tuple(
        Node(region, tuple(
            Node(f"{region}/{rack}", tuple(Node(f"{region}/{rack}/{s}", (), s, w) for s, w in shards.items()))
            for rack, shards in racks.items()))
        for region, racks in regions.items()))


def draw(key: Column, node: Node) -> Column:
    """The child's weighted draw; the hash's upper 53 bits make u in (0, 1)."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11) + 0.5) / float(1 << 53)
    return -F.log(u) / node.weight


def descend(key: Column, node: Node) -> Column:
    """The shard a key reaches.  Equal draws go to the child named first; null keys share one path."""
    if not node.children:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if len(live) == 1:
        return descend(key, live[0])
    best = F.array_min(F.array(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(live)]))["i"]
    out = F.when(best == 0, descend(key, live[0]))
    for i, c in enumerate(live[1:], 1):
        out = out.when(best == i, descend(key, c))
    return out


def numbered(rows: DataFrame, group: str, slot: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    Rows are numbered in blocks of their stored order, so a group may hold any share of the table;
    only one count per group and block is ordered across blocks.
    """
    placed = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "shard-rows").withColumn(
        "_block", F.shiftright("_at", BLOCK_BITS))
    counts = placed.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_block", group).orderBy("_at"))
    return placed.withColumn("_row", inside).join(starts, [group, "_block"]).withColumn(
        slot, F.col("_start") + F.col("_row") - 1).drop("_at", "_block", "_start", "_row")


def shard_documents(docs: DataFrame, now: Node, grown: Node) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; only the id and the tree decide.

    A null text has size 1 and the checksum of no bytes.  Repeated rows share a shard and have slots of their own.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(
        doc_id.alias("doc_id"), (F.octet_length(data) + 1).cast("bigint").alias("size"), F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"), descend(doc_id, now).cast("int").alias("shard"),
        descend(doc_id, grown).cast("int").alias("grown_shard"))
    return numbered(rows, "shard", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("bigint").alias("slot"), "grown_shard")
