import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowry.llm import resampling
from winnowry.llm.common import word_pieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, target, percent=10, min_words=20, n=1, buckets=10_000, seed=2024):
    """doc_id -> n_features, weight, score, rank, by lists and dictionaries alone."""
    def runs(text):
        ws = WORD.findall((text or "").translate(LOWER))
        return [" ".join(ws[i:i + k]) for k in range(1, n + 1) for i in range(len(ws) - k + 1)], len(ws)

    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, t in docs for f in runs(t)[0])
    t = Counter(place(f) for x in target for f in runs(x)[0])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = {}
    for doc_id, text in docs:
        found, words = runs(text)
        weight = sum(gain(place(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
        out[doc_id] = [len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words]
    able = sorted((i for i in out if out[i][4] >= min_words), key=lambda i: (-out[i][2], i))
    for rank, i in enumerate(able[:percent * len(able) // 100], 1):
        out[i][3] = rank
    return {i: tuple(v[:4]) for i, v in out.items()}


def collected(df):
    return {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("n", [1, 3])
def test_same_as_plain(spark, documents, sf_dir, n):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = plain([tuple(r) for r in documents.select("doc_id", "text").collect()], [r["text"] for r in target.collect()], n=n)
    assert collected(resampling.resample(documents, target, n=n)) == want
    assert sum(v[3] is not None for v in want.values()) > 5


def test_words_across_pieces():
    text = " ".join(f"w{i}" for i in range(5000)).encode()
    assert [w for p in word_pieces(text, 50) for w in p] == text.split()
    one, two = resampling.buckets_of(text, 2, 1000), text.split()
    assert sorted(one.tolist()) == sorted(zlib.crc32(f) % 1000 for f in [*two, *(a + b" " + b for a, b in zip(two, two[1:], strict=False))])


@pytest.mark.parametrize("chunk,in_order", [(7, 1), (64, 10), (1 << 20, 4096)])
def test_cutoff_is_exact(spark, chunk, in_order):
    rng = random.Random(chunk)
    keys = sorted((rng.choice([-3, 0, 0, 0, 5, rng.randrange(-99, 99)]), rng.randrange(50), i) for i in range(900))
    df = spark.createDataFrame(rng.sample(keys, 900), "a bigint, b bigint, c bigint").repartition(5)
    for k in (1, 2, 449, 900):
        assert resampling.cutoff(df, lambda n, k=k: k, chunk, in_order) == (keys[k - 1], k)
    assert resampling.cutoff(df, lambda n: 0, chunk, in_order) == (None, 0)
    assert resampling.cutoff(df.limit(0), lambda n: n // 10, chunk, in_order) == (None, 0)


def test_every_pass_settles_a_quarter():
    rng = np.random.default_rng(3)
    for _ in range(50):
        chunks = [np.sort(rng.integers(0, 1000, rng.integers(1, 40))) for _ in range(rng.integers(1, 30))]
        pivot = resampling.weighted_median([(len(c), resampling.median([c])) for c in chunks])[0]
        keys = np.concatenate(chunks)
        assert (keys <= pivot).sum() * 4 >= len(keys) and (keys >= pivot).sum() * 4 >= len(keys)


def test_odd_rows(spark, odd_docs):
    got = resampling.resample(odd_docs, odd_docs, percent=100, min_words=0).collect()
    assert len(got) == 10
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[None]["score"] is None and by_id[None]["rank"] is None and by_id[None]["n_features"] == 5
    assert all(by_id[i]["n_features"] == 0 and by_id[i]["weight"] == 0 for i in (2, 3, 4))
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 10))
    assert by_id[5]["n_features"] == 30_000
    assert resampling.resample(odd_docs.limit(0), odd_docs).count() == 0
    assert resampling.resample(odd_docs, odd_docs.limit(0)).count() == 10
    assert resampling.resampled(odd_docs, odd_docs, percent=100, min_words=0).columns == odd_docs.columns


def test_many_rows_of_one_score(spark):
    """A third of all rows repeats one id, so they tie in everything; exactly the asked number is drawn."""
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("one two three").alias("text"))
    got = resampling.resample(docs, docs, min_words=2).filter("rank is not null").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 301))
