import hashlib
import random
import re

from winnowry.llm import decontamination as dc

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def by_hand(docs, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, met = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    met |= windows[key]
        named = ",".join(sorted(map(str, met)))
        out.append((doc_id, len(w), len(hit), len(met), hashlib.sha256(named.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def found(docs, items):
    rows = dc.find_leaks(docs, items).drop("text_hash").collect()
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows], key=str)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.collect()]


def test_matches_brute_force(spark, documents, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = found(documents, items)
    assert got == by_hand(pairs(documents, "doc_id"), pairs(items, "item_id")) and any(r[-1] for r in got)


def test_overlaps_repeats_and_short_items(spark):
    rng = random.Random(11)
    vocabulary = ["a", "b", "cc", "é", "d1", "ee"]
    stream = [rng.choice(vocabulary) for _ in range(400)]
    items = [(1, " ".join(stream[20:45])), (2, " ".join(stream[30:60])), (3, "a b"), (4, " ".join(["a"] * 12)), (5, "!!"), (6, None),
             (7, "one TWO three"), (1, " ".join(stream[20:45])), (None, "q")]
    docs = [(1, " ".join(stream)), (2, "-".join(stream[25:50]).upper()), (3, "a " * 40), (4, "one two, three"), (5, "x one"), (6, None), (7, ""),
            (8, " ".join(stream[20:29])), (None, " ".join(stream[10:90])), (1, " ".join(stream))]
    named = [i for i in items if i[0] is not None]
    assert found(spark.createDataFrame(docs, "doc_id bigint, text string"),
                 spark.createDataFrame(items, "item_id bigint, text string")) == by_hand(docs, named)


def test_odd_documents(spark, odd_docs):
    items = spark.createDataFrame([(1, "the one text of some words in here")], "item_id bigint, text string")
    assert found(odd_docs, items) == by_hand(pairs(odd_docs, "doc_id"), pairs(items, "item_id"))
    stayed = dc.without_leaks(odd_docs, items)
    assert stayed.columns == odd_docs.columns and sorted(r["doc_id"] or 0 for r in stayed.collect()) == [0, 2, 3, 4, 5, 6, 7, 8]
    assert not any(r[-1] for r in found(odd_docs, items.limit(0)))
    assert found(odd_docs.limit(0), items) == []


def test_proximity_in_any_order(spark):
    items = spark.createDataFrame([(1, "alpha of the beta of the gamma")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "gamma x beta x x alpha"), (2, "alpha " + "of the " * 30 + "beta gamma"), (3, "beta gamma")],
                                 "doc_id bigint, text string")
    docs = docs.unionByName(spark.createDataFrame([(i, "of the of the") for i in range(10, 20)], docs.schema))
    index, made, wanted = dc.prepare(docs, items, factor=None)
    near = dc.proximity_matches(index, made, wanted, span=8).join(index.select("row", "doc_id"), "row").collect()
    assert {r["doc_id"] for r in near} == {1}
    assert dc.phrase_matches(index, made, wanted).count() == 0
