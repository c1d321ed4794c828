import math
import zlib
from collections import Counter

import xxhash

from winnowry.llm import queries, sharding


def drawn(doc_id, name):
    seed = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42)
    return ((xxhash.xxh64_intdigest(name.encode(), seed) >> 11) + 0.5) / 2**53


def walk(doc_id, node):
    while node.children:
        node = min((-math.log(drawn(doc_id, c.name)) / c.weight, i, c) for i, c in enumerate(node.children))[2]
    return node.shard


def test_matches_plain_tree_and_laws(spark, documents):
    now, grown = sharding.tree(queries.SHARD_TREE), sharding.tree(queries.GROWN_TREE)
    rows = sharding.shard_documents(documents, now, grown).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["shard"], r["grown_shard"]) == (walk(r["doc_id"], now), walk(r["doc_id"], grown))
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert r["grown_shard"] in (r["shard"], 8)
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_weights_and_confined_movement(spark):
    """A heavier shard takes rows from everywhere but moves nothing between racks it does not weigh on."""
    ids = spark.range(20_000).selectExpr("id as doc_id", "'x' as text")
    old = sharding.tree({"r": {"a": {0: 1.0, 1: 1.0}}, "s": {"b": {2: 1.0}, "c": {3: 1.0, 4: 1.0}}})
    new = sharding.tree({"r": {"a": {0: 1.0, 1: 2.0}}, "s": {"b": {2: 1.0}, "c": {3: 1.0, 4: 1.0}}})
    moves = Counter((r["shard"], r["grown_shard"]) for r in sharding.shard_documents(ids, old, new).collect())
    assert all(b in (0, 1) for a, b in moves if a != b)
    assert all(n > 2300 for n in Counter({a: n for (a, b), n in moves.items() if a == b}).values())
    zero = sharding.tree({"r": {"a": {0: 0.0, 1: 1.0}}})
    assert {r["shard"] for r in sharding.shard_documents(ids.limit(50), zero, zero).collect()} == {1}


def test_odd_documents(odd_docs):
    tree = sharding.tree(queries.SHARD_TREE)
    rows = sharding.shard_documents(odd_docs, tree, tree).collect()
    assert len(rows) == 10 and len({(r["shard"], r["slot"]) for r in rows}) == 10
    empty = next(r for r in rows if r["doc_id"] == 2)
    assert (empty["size"], empty["text_crc32"]) == (1, 0)
    assert sharding.shard_documents(odd_docs.limit(0), tree, tree).count() == 0
