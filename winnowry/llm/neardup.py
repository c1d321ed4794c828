"""Near-duplicate documents by bottom-k sketches of one hash function.

The k smallest shingle hashes of a text are its sketch.  Inverted lists of retained values bring
similar texts together: two similar sketches agree in so many values that they already agree in one of
their rarest few, so each text enters only the lists of those.  The sketch of the union of two sets
estimates their similarity and drops most chance meetings; the full sets decide the rest exactly.

Texts with equal sets are one node from the start.  A list is first compared with a few hubs, which
joins the members of a dense group in linear time.  Afterwards members of a list that are still in
different components are compared, unless their sizes and the shingles they share with anyone rule a
link out, so no link between different texts is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import settled, sifted, small_batches, stored
from winnowry.llm.components import components, merged

SKETCH = 48
CROSS_ROWS, CROSS_COLUMNS = 256, 1024  # texts of a block pair compared in one task, on average at most
CROSS_HASHES = 1 << 21  # shingles of either side of such a pair, on average at most: long texts make blocks of few
SLACK = 5.2  # standard errors of the overlap of two sketches that may be lacking: fewer than 1 link in a million


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; fewer words make one shingle, none no shingle."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    width = min(n, len(h))
    acc = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        acc = (acc ^ (acc >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - width + 1 + k]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        acc = (acc ^ (acc >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(acc ^ (acc >> np.uint64(31)))


def sketches(docs: DataFrame, n: int, k: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest of the whole set, sketch (smallest k hashes, as signed longs); stored."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), n) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["text_hash"], pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s[:k].view(np.int64) for s in sets], pa.list_(pa.int64()))], schema=schema)

    made = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, sketch array<bigint>")
    with small_batches(docs.sparkSession):
        return stored(made, "near-sketches")


def full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """key, hashes: the whole shingle set of each wanted node (key, doc_id, digest); stored."""
    schema = pa.schema([("digest", pa.binary()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), n) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], schema=schema)

    ids = wanted.select("doc_id").distinct()
    texts = sifted(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), ids, "doc_id")[1].join(ids, "doc_id", "left_semi")
    made = texts.select("text").mapInArrow(run, "digest binary, hashes array<bigint>").dropDuplicates(["digest"])
    with small_batches(docs.sparkSession):
        return stored(wanted.join(made, "digest").select("key", "hashes"), "near-sets")


def least_overlap(n: Column, k: int, share: float) -> Column:
    """Values that two sketches of linked sets have in common at least; n is the size of one set.

    Sets small enough to be their own sketches, like all their partners, must overlap in that share.
    """
    slack = max(1, math.floor(k * share - SLACK * math.sqrt(k * share * (1 - share))))
    return F.when(n < k * share, F.ceil(n * share - 1e-9)).otherwise(F.lit(slack)).cast("int")


def inverted_lists(nodes: DataFrame, k: int, share: float) -> DataFrame:
    """value, key, shared (how many of its values others have): each node in the lists of its rarest values; values of one node only make no list.

    Rarer values come first in one order over all nodes; sketches that agree in ``need`` values agree
    in one of the first (size - need + 1).  Values held by one node lead that order and are skipped by count.
    """
    postings = nodes.select("key", least_overlap(F.col("n"), k, share).alias("need"), F.explode("sketch").alias("value"))
    held = nodes.select(F.explode("sketch").alias("value")).groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    shared = postings.join(held, "value").groupBy("key", "need").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("vs"))
    lists = shared.filter(F.size("vs") >= F.col("need")).select(
        "key", F.size("vs").alias("shared"), F.explode(F.slice("vs", F.lit(1), F.size("vs") - F.col("need") + 1)).alias("v"))
    return stored(lists.select(F.col("v.value").alias("value"), "key", "shared"), "near-lists")


def ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a < b)."""
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def hub_pairs(lists: DataFrame, rank: Column, seed: int) -> DataFrame:
    """Every member of a list with its hub, the member of the highest rank; linear in the size of the list.

    Among equals each list draws its own.
    """
    draw = F.xxhash64("key", "value", F.lit(seed))
    hubs = lists.groupBy("value").agg(F.max(F.struct(rank.alias("rank"), draw.alias("draw"), "key")).alias("hub"))
    return ordered(lists.join(hubs, "value").select(F.col("key").alias("a"), F.col("hub.key").alias("b")))


def open_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """value, key, root, minor: lists with several components; minor where not in the list's largest."""
    named = lists.join(roots.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    sizes = named.groupBy("value", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("value").agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("parts")).filter("parts > 1").select(
        "value", F.col("top.root").alias("main"))
    return stored(named.join(main, "value").withColumn("minor", F.col("root") != F.col("main")).drop("main"), "near-open")


def partner_bounds(opened: DataFrame, nodes: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """key, n, most: a set links with none larger than ``most``, by how many of its shingles any other has.

    Every intersection lies within the shingles that a set shares with anyone; they are counted over the
    members of open lists, among which all links still to be found are.
    """
    keys = opened.select("key").distinct()
    each = sets.join(keys, "key").select("key", F.explode("hashes").alias("hash"))
    held = each.groupBy("hash").agg(F.count("*").alias("df")).filter("df > 1").select("hash")
    shared = each.join(held, "hash").groupBy("key").agg(F.count("*").alias("s"))
    s = F.coalesce("s", F.lit(0))
    return nodes.join(keys, "key", "left_semi").select("key", "n").join(shared, "key", "left").select(
        "key", "n", F.floor((s * den - (F.col("n") - s) * num) / num).alias("most"))


def cross_links(opened: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between different components that share an open list, by the full sets: whatever links two, one link of them or more.

    Sets that can link with none, by their size and the shingles they share with anyone, stay out.  What
    lists of several components tie together is a cluster, and one of each pair is outside the cluster's
    largest component.  Blocks of such members meet blocks of all members in tasks of bounded size, which
    return one link of any two components.
    """
    able = stored(opened.filter(F.col("most") * den >= F.col("n") * num).select("value", "key", "root", "n"), "near-able")
    several = able.groupBy("value").agg(F.min("key").alias("first"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    tied = components(able.join(several, "value").select(F.col("key").alias("a"), F.col("first").alias("b"))).select(
        F.col("node").alias("key"), F.col("root").alias("cluster"))
    each = able.select("key", "root", "n").distinct()
    each = stored(each.join(tied, "key"), "near-clustered")
    parts = each.groupBy("cluster", "root").agg(F.count("*").alias("m"), F.sum("n").alias("hashes"))
    sizes = parts.groupBy("cluster").agg(F.max(F.struct("m", "root", "hashes")).alias("main"), F.sum("m").alias("all"),
                                         F.sum("hashes").alias("hashes"), F.count("*").alias("parts"))
    blocks = lambda texts, hashes, most: F.ceil(F.greatest(texts / most, hashes / CROSS_HASHES))
    sizes = sizes.filter("parts > 1").select(
        "cluster", F.col("main.root").alias("main"), blocks(F.col("all"), F.col("hashes"), CROSS_COLUMNS).alias("columns"),
        blocks(F.col("all") - F.col("main.m"), F.col("hashes") - F.col("main.hashes"), CROSS_ROWS).alias("rows"))
    named = each.join(sizes, "cluster").withColumn("outside", F.col("root") != F.col("main"))
    block = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), F.col(n))
    span = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    kept = ("key", "root", "cluster")
    left = named.filter("outside").select(*kept, F.lit(True).alias("outside"), block("rows", 1).alias("i"), F.explode(span("columns")).alias("j"))
    right = named.select(*kept, F.lit(False).alias("outside"), F.explode(span("rows")).alias("i"), block("columns", 2).alias("j"))
    met = left.unionByName(right).join(sets, "key")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        us, vs = group[group["outside"]], group[~group["outside"]]
        out, told = [], set()
        if len(us) and len(vs):
            flat = np.concatenate(vs["hashes"].to_numpy())
            lengths = vs["hashes"].map(len).to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            keys, roots = vs["key"].to_numpy(), vs["root"].to_numpy()
            known, codes = np.unique(flat, return_inverse=True)
            for key, root, hashes in zip(us["key"], us["root"], us["hashes"]):
                at = np.searchsorted(known, hashes)
                at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == hashes)]
                mark = np.zeros(len(known), dtype=np.int64)
                mark[at] = 1
                both = np.add.reduceat(mark[codes], starts)
                good = np.flatnonzero((both * den >= (len(hashes) + lengths - both) * num) & (roots != root))
                for at in good[np.unique(roots[good], return_index=True)[1]]:
                    if (root, roots[at]) not in told:
                        told.add((root, roots[at]))
                        out.append((key, keys[at]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return met.select("key", "root", "outside", "hashes", "cluster", "i", "j").groupBy("cluster", "i", "j").applyInPandas(
        compare, "a bigint, b bigint")


def verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs with den * intersection >= num * union: union-sketch estimate first, full sets last."""
    share = num / den
    slack = max(1, math.floor(k * share - SLACK * math.sqrt(k * share * (1 - share))))
    side = lambda x: nodes.select(F.col("key").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        (F.least("na", "nb") * den >= F.greatest("na", "nb") * num))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    agree = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    whole = (F.col("na") <= k) & (F.col("nb") <= k)
    near = near.filter(whole | (agree >= slack)).select("a", "b", "na", "nb")
    full = lambda x: sets.select(F.col("key").alias(x), F.col("hashes").alias(f"f{x}"))
    both = near.join(full("a"), "a").join(full("b"), "b").withColumn("i", F.size(F.array_intersect("fa", "fb")))
    return both.filter(F.col("i") * den >= (F.col("na") + F.col("nb") - F.col("i")) * num).select("a", "b")


def classes(docs: DataFrame, n: int, num: int, den: int, k: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, root, component_id for every row; root tells components apart and is null for rows that take no part."""
    made = sketches(docs, n, k)
    nodes = stored(made.filter("doc_id is not null and n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("n"), F.any_value("sketch").alias("sketch")).withColumn(
        "key", F.monotonically_increasing_id()), "near-nodes")
    lists = inverted_lists(nodes, k, num / den)
    wanted = nodes.join(lists.select("key").distinct(), "key", "left_semi").select("key", "doc_id", "digest")
    sets = full_sets(docs, wanted, n)
    # First hubs share most of their sketch, second ones have the fewest shingles of their own; then all the rest.
    pairs = stored(hub_pairs(lists, F.col("shared"), 0), "near-pairs")
    roots = stored(components(verified(pairs, nodes, sets, k, num, den)), "near-roots")
    opened = open_lists(lists, roots)
    if not opened.isEmpty():
        bounds = stored(partner_bounds(opened, nodes, sets, num, den), "near-bounds")
        hubs = stored(hub_pairs(opened.join(bounds, "key"), F.col("most") / F.col("n"), 1), "near-hubs")
        roots = merged(roots, verified(hubs, nodes, sets, k, num, den))
        roots = merged(roots, cross_links(open_lists(lists, roots).join(bounds, "key"), sets, num, den))
    named = nodes.select("digest", "doc_id", "key").join(roots, F.col("key") == F.col("node"), "left").select(
        "digest", "doc_id", F.coalesce("root", "key").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = named.join(least, "root").select("digest", "root", "component_id")
    joined = made.select("doc_id", "text_hash", "n_shingles", "digest").join(found, "digest", "left")
    takes_part = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return joined.select("doc_id", "text_hash", "n_shingles", F.when(takes_part, F.col("root")).alias("root"),
                         F.when(takes_part, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Two texts are linked if their sets of n-word shingles have a Jaccard similarity of num / den or more;
    component_id is the smallest doc_id that links reach, kept marks it.  Null and empty texts have no
    shingles and no links.  Rows without a doc_id take no part: their component_id is null and they are
    kept.  Rows that repeat a doc_id are judged text by text; all that have the smallest id are marked kept.
    """
    return classes(docs, n, num, den, k).select("doc_id", "n_shingles", "component_id").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def leaving(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """_doc_id, _text_hash, _every: whether all rows of that id and text leave, or all but one."""
    found = classes(docs, n, num, den, SKETCH).filter("root is not null").groupBy("doc_id", "text_hash", "root", "component_id").agg(
        F.count("*").alias("rows"))
    heads = found.filter("doc_id = component_id")
    first = heads.groupBy("root").agg(F.min("text_hash").alias("first"), F.sum("rows").alias("of")).filter("of > 1").drop("of")
    repeated = heads.join(first, "root").withColumn("_every", F.col("text_hash") != F.col("first")).filter("_every or rows > 1")
    both = found.filter("doc_id <> component_id").select("doc_id", "text_hash", F.lit(True).alias("_every")).unionByName(
        repeated.select("doc_id", "text_hash", "_every"))
    return both.toDF("_doc_id", "_text_hash", "_every")


def without_near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component one row, which has its smallest id.

    Where an id repeats, texts are judged one by one: a duplicate takes no other text of its id along, of several
    near texts of the smallest id one stays, and of rows with equal id and text one.  Rows without id or words stay.
    """
    gone = settled(lambda: leaving(docs, n, num, den), "near-leaving")
    same = (F.col("doc_id").cast("bigint") == F.col("_doc_id")) & (F.xxhash64("text") == F.col("_text_hash"))
    apart, met = sifted(docs, gone, "_doc_id")
    stay = met.join(gone.filter("_every"), same, "left_anti")
    copies = gone.filter("not _every")
    if copies.isEmpty():
        return apart.unionByName(stay)
    one = stay.join(copies, same).dropDuplicates(["_doc_id", "_text_hash"]).select(*docs.columns)
    return apart.unionByName(stay.join(copies, same, "left_anti")).unionByName(one)
