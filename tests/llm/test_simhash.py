import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from winnowry.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, n=4, seed=42):
    ws = WORD.findall((text or "").translate(LOWER))
    found = [" ".join(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    """Smallest reachable node of every node, by comparing all with all."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("tile", [8, 1 << 15])
def test_same_as_plain(documents, tile):
    want = {r["doc_id"]: plain_fingerprint(r["text"]) for r in documents.select("doc_id", "text").collect()}
    roots = plain_components(want)
    got = simhash.simhash_duplicates(documents, tile=tile).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{f:016x}", roots[i]) for i, f in want.items()}
    assert len(set(roots.values())) < len(roots)


def test_words_across_pieces(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice(["a", "bb", "Ccc", "é"]) * rng.randint(1, 3) for _ in range(3000))
    from winnowry.llm import common
    monkeypatch.setattr(simhash, "word_pieces", lambda t: common.word_pieces(t, 40))
    monkeypatch.setattr(simhash, "MANY", 5)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    for few in ("", "  ", "One", "one two three", "one two three four"):
        assert simhash.fingerprint(few.encode()) == plain_fingerprint(few)


def test_tile_links_connect_what_all_pairs_connect():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = np.array([c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))) for c in centres for _ in range(60)])
    fps = np.unique(near)
    left, right = fps[::2].tobytes(), fps[1::2].tobytes()
    found = [simhash.tile_links(a, b, 4, 16) for a, b in ((left, left), (right, right), (left, right))]
    assert all(len(f) < len(fps) for f in found)  # a forest, however many pairs there are
    pairs = np.concatenate(found).view(np.uint64)
    assert all((int(a) ^ int(b)).bit_count() <= 4 for a, b in pairs)
    number = {int(f): k for k, f in enumerate(fps)}
    links = simhash.Forest(len(fps))
    links.join(np.array([number[int(a)] for a in pairs[:, 0]]), np.array([number[int(b)] for b in pairs[:, 1]]))
    roots = plain_components({k: int(f) for k, f in enumerate(fps)})
    assert links.root.tolist() == [roots[k] for k in range(len(fps))]


def test_odd_rows(spark, odd_docs):
    got = simhash.simhash_duplicates(odd_docs).collect()
    assert len(got) == 10
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["fingerprint"] == "0" * 16 and by_id[i]["component_id"] == 2 for i in (2, 3, 4))
    assert by_id[None]["component_id"] is None and by_id[1]["component_id"] == 1
    assert simhash.simhash_duplicates(odd_docs.limit(0)).count() == 0


def test_a_third_has_one_text(spark):
    docs = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("the same words again and again")).otherwise(
        F.concat_ws(" ", *[F.xxhash64("id", F.lit(k)).cast("string") for k in range(9)])).alias("text")).withColumnRenamed("id", "doc_id")
    got = simhash.simhash_duplicates(docs).groupBy("component_id").count().orderBy(F.desc("count")).limit(2).collect()
    assert got[0]["component_id"] == 0 and got[0]["count"] >= 1000 and got[1]["count"] <= 3
