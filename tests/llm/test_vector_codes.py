import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowry.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """vec_id -> code, error and the digest, comparing all parts with all entries in Python integers."""
    kept = sorted((i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
                  if v is not None and all(x is not None and math.isfinite(x) for x in v))
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        own = [[near(v, p) for _, v, _ in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), o in zip(kept, own[p], strict=True) if o == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    codes = {i: [near(v, p) for p in range(parts)] for i, v, _ in kept}
    return {i: ("".join(f"{e:02x}" for e in codes[i]), sum(far(cut(v, p), books[p][codes[i][p]]) for p in range(parts))) for i, v, _ in kept}, digest


@pytest.mark.parametrize("entries,block,leaf", [(16, 64, 4), (5, 200, 32), (1, 50, 8)])
def test_same_as_plain(spark, entries, block, leaf):
    rng = np.random.default_rng(entries)
    centres = rng.normal(size=(9, 24))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 9] + rng.normal(scale=0.1, size=24) * (i % 4)], int(i % 3)) for i in rng.permutation(300)]
    got = vc.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), entries=entries, block=block, leaf=leaf).collect()
    want, digest = plain(rows, entries=entries)
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
    sums = {k: sum(want[i][1] for i, _, label in rows if label == k) for k in range(3)}
    assert all(r["label_error"] == sums[r["vec_id"] % 3] for r in got)


@pytest.mark.parametrize("n,width,entries", [(1, 3, 1), (200, 8, 16), (333, 2, 7), (64, 1, 13)])
def test_trees_prune_without_changing_the_nearest(n, width, entries):
    rng = np.random.default_rng(n)
    rows = rng.integers(-20, 20, (n, width))
    book = rng.integers(-20, 20, (entries, width))
    book[-1] = book[0]  # equal entries: the lower index wins
    order, tree = vc.planted(rows, 8)
    far = ((rows[order][:, None] - book) ** 2).sum(axis=2)
    own = vc.assigned(tree, book)
    assert own.tolist() == far.argmin(axis=1).tolist()
    counts, sums = vc.gathered(tree, book)
    assert counts.tolist() == np.bincount(own, minlength=entries).tolist()
    assert all(sums[e].tolist() == rows[order][own == e].sum(axis=0).tolist() for e in range(entries))


def test_whole_nodes_are_assigned_by_their_sums():
    rng = np.random.default_rng(4)
    book = rng.integers(-1000, 1000, (16, 8)) * 100
    rows = np.repeat(book, 256, axis=0) + rng.integers(-50, 50, (4096, 8))
    whole, uncertain, _ = vc.meet(vc.planted(rows, 32)[1], book)
    assert len(uncertain) == 0 and sum(len(nodes) for _, nodes, _ in whole) < 64


def test_odd_rows(spark):
    good = [(i, [float(i)] * 16, None if i % 2 else 1) for i in range(20)]
    bad = [(100, None, 1), (101, [], 1), (102, [1.0] * 15 + [None], 1), (103, [float("nan")] * 16, 1), (104, [float("inf")] + [0.0] * 15, 1),
           (105, [1.0] * 8, 1), (106, [1e30] * 16, 1)]
    docs = spark.createDataFrame(good + bad + [(None, [2.5] * 16, 1), (3, [3.0] * 16, None)], SCHEMA).withColumns(
        {c: F.lit("z") for c in ("code", "error", "n", "xs", "part", "entry")})
    got = vc.compress(docs).collect()
    assert sorted(r["vec_id"] if r["vec_id"] is not None else -1 for r in got) == sorted([*range(20), 3, -1])
    assert len({r["label_error"] for r in got}) <= 2
    assert vc.compress(docs.limit(0)).count() == 0
    few = vc.compress(docs.filter("vec_id < 2")).collect()
    assert {r["error"] for r in few} == {0} and {r["code"] for r in few} == {"00" * 8, "01" * 8}


def test_a_third_is_one_vector(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [1.0] * 16 if i % 3 == 0 else [float(np.float32(x)) for x in rng.normal(size=16)], 7) for i in range(300)]
    got = vc.compress(spark.createDataFrame(rows, SCHEMA), block=50).collect()
    want, _ = plain(rows)
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want
