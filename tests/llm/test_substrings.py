import random

from winnowry.llm import substrings


def prose(rng, n):
    return [rng.choice("bcdfghjk") + rng.choice("aeiou") * rng.randint(1, 3) + rng.choice("lmnprst") + str(rng.randrange(300)) for _ in range(n)]


def planted(count, size):
    rng = random.Random(size)
    docs = {i: prose(rng, rng.randint(60, 600)) for i in range(4 * count)}
    pairs = {}
    for k in range(count):
        passage = prose(rng, size)
        a, b = 2 * k, 2 * k + 1
        for x in (a, b):
            at = rng.randrange(len(docs[x]))
            docs[x][at:at] = passage
        pairs[a, b] = " ".join(passage)
    return [(i, " ".join(w)) for i, w in docs.items()], pairs


def test_passages_are_found_and_clean_documents_left(spark):
    rows, pairs = planted(150, 51)
    texts = dict(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = substrings.repeated_passages(docs).collect()
    assert {(r["first_doc_id"], r["doc_id"]) for r in got} == set(pairs)
    for r in got:
        span = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert span in texts[r["first_doc_id"]] and len(span.split()) == r["n_words"]
        assert span in pairs[r["first_doc_id"], r["doc_id"]]
    cut = {r["doc_id"]: r["text"] for r in substrings.without_passages(docs).collect()}
    assert len(cut) == len(rows)
    for r in got:
        text = texts[r["doc_id"]]
        assert cut[r["doc_id"]] == text[:r["start"]] + text[r["start"] + r["length"]:]
    assert all(cut[i] == texts[i] for i in texts if i not in {b for _, b in pairs})


def test_boundaries_follow_content():
    rng = random.Random(1)
    text = " ".join(prose(rng, 400))
    shifted = "x yy zzz " + text
    a, b = {c[0] for c in substrings.chunks(text)}, {c[0] for c in substrings.chunks(shifted)}
    assert len(a) > 30 and len(a - b) <= 2
    spans = substrings.chunks("é" * 50 + " " + text)
    assert all(x[2] < y[1] and x[4] == y[3] for x, y in zip(spans, spans[1:])) and spans[-1][4] == 401


def test_rolling_hash_is_the_recurrence():
    import numpy as np
    data = np.frombuffer(bytes(random.Random(2).randrange(256) for _ in range(300)), dtype=np.uint8)
    h, out = 0, []
    for byte in data:
        h = (2 * h + int(substrings.GEARS[byte])) % 65536
        out.append(h)
    assert substrings.gear_hash(data).tolist() == out


def test_odd_documents(odd_docs, make_docs):
    assert substrings.repeated_passages(odd_docs).count() == 0
    stayed = substrings.without_passages(odd_docs)
    assert stayed.columns == odd_docs.columns and stayed.count() == 10
    assert substrings.without_passages(odd_docs.limit(0)).count() == 0
    text = " ".join(prose(random.Random(4), 80))
    copies = make_docs([(1, text), (2, text), (3, text + " more"), (3, text + " more"), (4, None)])
    left = {r["doc_id"] for r in substrings.without_passages(copies).collect()}
    assert {1, 4} <= left and 2 not in left


def found(spark, pieces, passage, seed):
    """The documents in whose middle the copied passage is found: of two each, with surroundings of their own."""
    rng, rows = random.Random(seed), []
    for k in range(40):
        copied = passage(rng)
        for i in (2 * k, 2 * k + 1):
            rows.append((i, pieces(rng) + copied + pieces(rng)))
    texts = dict(rows)
    got = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for r in got:
        assert texts[r["doc_id"]][r["start"]:r["start"] + r["length"]] in texts[r["first_doc_id"]]
    return {(r["first_doc_id"], r["doc_id"]) for r in got} == {(2 * k, 2 * k + 1) for k in range(40)}


def test_passages_without_spaces(spark):
    for low, high in ((0x4E00, 0x9FA0), (0x0E01, 0x0E2E), (0x3041, 0x3090), (0x21, 0x7E)):
        letters = lambda rng, n: "".join(chr(rng.randint(low, high)) for _ in range(n))
        assert found(spark, lambda rng: letters(rng, rng.randint(100, 400)), lambda rng: letters(rng, 51), low)


def test_passages_of_short_words(spark):
    short = lambda rng, n: " " + " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) + " "
    assert found(spark, lambda rng: short(rng, rng.randint(100, 400)), lambda rng: short(rng, 51), 3)


def test_periodic_passages(spark):
    for period in (1, 2, 3, 4, 7):
        def repeated(rng, period=period):
            return " " + " ".join((prose(rng, period) * 51)[:51]) + " "
        assert found(spark, lambda rng: " ".join(prose(rng, rng.randint(60, 200))), repeated, period)


def test_no_passage_of_51_units_is_lost():
    """Shared digests cover 16 units or more of every copied passage, whatever stands around it."""
    rng = random.Random(8)
    makers = [lambda n: " ".join(prose(rng, n)), lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)),
              lambda n: " ".join(["ha", "ho"] * n)[:3 * n - 1], lambda n: " ".join(["no"] * n)]
    for k in range(4000):
        copied = makers[k % 4](51)
        a, b = (substrings.chunks(f"{' '.join(prose(rng, 40))} {copied} {' '.join(prose(rng, 40))}") for _ in range(2))
        known = {c[0] for c in a}
        assert sum(c[4] - c[3] for c in b if c[0] in known) >= substrings.PASSAGE_WORDS
