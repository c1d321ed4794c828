import random
import re

import pytest

from winnowry.llm import neardup
from winnowry.llm.components import components, merged

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, n, num, den):
    sets, inverted, parent = {}, {}, {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[doc_id] = {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
        parent[doc_id] = doc_id

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for doc_id, s in sets.items():
        met = {}
        for x in s:
            for other in inverted.setdefault(x, []):
                met[other] = met.get(other, 0) + 1
            inverted[x].append(doc_id)
        for other, both in met.items():
            if den * both >= num * (len(s) + len(sets[other]) - both):
                a, b = root(doc_id), root(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def found(docs, *args):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs, *args).collect()}


@pytest.mark.parametrize("n, num", [(3, 85), (5, 80)])
def test_matches_brute_force(documents, n, num):
    assert found(documents, n, num, 100) == by_hand([(r["doc_id"], r["text"]) for r in documents.collect()], n, num, 100)


def test_dense_group_at_the_threshold(spark):
    """Copies of one text whose edits put pairs on both sides of the threshold, and chains of them."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(220)]
    rows, chain = [], list(words)
    for i in range(160):
        copy = list(words)
        for at in rng.sample(range(220), rng.randint(0, 9)):
            copy[at] = f"e{i}x{at}"
        rows.append((i, " ".join(copy)))
    for i in range(160, 220):
        for at in rng.sample(range(220), 5):
            chain[at] = f"c{i}x{at}"
        rows.append((i, " ".join(chain)))
    rows += [(500 + i, " ".join(words[:100]) + f" own{i} " + " ".join(f"z{i}y{k}" for k in range(60))) for i in range(40)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(docs, 3, 85, 100) == by_hand(rows, 3, 85, 100)


def test_odd_documents(odd_docs):
    got = neardup.near_duplicates(odd_docs, 3, 85, 100).collect()
    assert len(got) == 10
    by_id = {r["doc_id"]: r for r in got}
    assert (by_id[2]["n_shingles"], by_id[2]["component_id"], by_id[2]["kept"]) == (0, 2, True)
    assert by_id[3]["kept"] and by_id[4]["kept"] and by_id[6]["n_shingles"] == 1
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    stayed = neardup.without_near_duplicates(odd_docs)
    assert stayed.columns == odd_docs.columns and stayed.count() == 9  # of the repeated row, one stays
    assert neardup.near_duplicates(odd_docs.limit(0)).count() == 0
    assert neardup.without_near_duplicates(odd_docs.limit(0)).count() == 0


def test_repeated_ids_are_judged_text_by_text(make_docs):
    rng = random.Random(11)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(150)) for _ in range(3))
    near = a.rsplit(" ", 1)[0] + " end"
    rows = [(1, a), (1, near), (1, a), (2, near), (2, b), (3, c), (3, c), (3, c), (4, b), (None, c), (None, c), (5, ""), (5, "")]
    stayed = [(r["doc_id"], r["text"]) for r in neardup.without_near_duplicates(make_docs(rows)).collect()]
    ones = [r for r in stayed if r[0] == 1]
    assert len(ones) == 1 and ones[0][1] in (a, near)  # texts that are near, whatever the order of their hashes
    assert sorted((r for r in stayed if r[0] and r[0] > 1), key=str) == sorted([(2, b), (3, c), (5, ""), (5, "")], key=str)
    assert stayed.count((None, c)) == 2


def test_blocks_of_long_texts(spark, monkeypatch):
    """Blocks cut by shingles find the same components; the hubs alone leave some of these links open."""
    monkeypatch.setattr(neardup, "CROSS_HASHES", 3000)
    compared, plain = [], neardup.cross_links
    monkeypatch.setattr(neardup, "cross_links", lambda *args: compared.append(1) or plain(*args))
    rng = random.Random(4)
    words, rows = [f"w{rng.randrange(10**6)}" for _ in range(700)], []
    for i in range(120):
        copy = list(words)
        for at in rng.sample(range(700), rng.randint(0, 30)):
            copy[at] = f"e{i}x{at}"
        rows.append((i, " ".join(copy)))
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85, 100) == by_hand(rows, 3, 85, 100)
    assert compared


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 160)}


def plain_roots(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def test_components_of_random_links_and_of_more_links_later(spark):
    """Equal links, links both ways, two hubs over the same nodes; later links join old components, new nodes, or nothing."""
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)]
    links += links[:20] + [(b, a) for a, b in links[20:40]] + [(500 + i, 400 + i % 2) for i in range(60)] + [(500 + i, 401) for i in range(60)]
    links = [(a, b) for a, b in links if a != b]
    frame = lambda rows: spark.createDataFrame(rows, "a bigint, b bigint")
    read = lambda df: sorted(tuple(r) for r in df.select("node", "root").collect())
    first = components(frame(links))
    assert read(first) == sorted(plain_roots(links).items())
    later = [(rng.randrange(350), rng.randrange(350)) for _ in range(40)]
    later = [(a, b) for a, b in later if a != b] + [(900, 901), (2, 900)]
    assert read(merged(first, frame(later))) == sorted(plain_roots(links + later).items())
    for settled in ([], links[:5]):
        assert read(merged(first, frame(settled))) == read(first)
    assert read(components(frame([]))) == []
