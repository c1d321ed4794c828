import array
import random
import zlib
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from winnowry.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def pieces_by_hand(rows, capacity):
    tokenizer, out = Tokenizer.from_file(PATH), []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            out.append((doc_id, k // capacity, k, len(part), zlib.crc32(array.array("I", part).tobytes())))
    return sorted(out, key=str)


def check(rows, pieces, capacity):
    assert sorted([tuple(r)[:5] for r in rows], key=str) == pieces
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_documents(documents):
    rows = packing.pack_documents(documents, PATH).collect()
    pieces = pieces_by_hand([(r["doc_id"], r["text"]) for r in documents.collect()], 4096)
    used = check(rows, pieces, 4096)
    assert used <= -(-sum(p[3] for p in pieces) // 4096) + 1


def test_odd_documents(odd_docs):
    rows = packing.pack_documents(odd_docs, PATH).collect()
    check(rows, pieces_by_hand([(r["doc_id"], r["text"]) for r in odd_docs.collect()], 4096), 4096)
    assert packing.pack_documents(odd_docs.limit(0), PATH).count() == 0


def test_words_one_by_one_equal_the_tokenizer():
    rng = random.Random(9)
    plain = [chr(c) for c in (*range(32, 127), *range(161, 256), 9, 10, 13)]
    odd = plain + list(" 漢字İσςΣ́\x1c\x85ǅ½Ⅷ😀")
    encode, tokenizer = packing.encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["".join(rng.choices(plain if i % 2 else odd, k=rng.randint(0, 60))) for i in range(3000)]
    texts += ["a<|endoftext|>b", "it's I'LL we'Ve 'tis don't''s", "é" * 3000, "é x"]
    for text in texts:
        assert encode(text) == array.array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes(), text


def test_rounds_merge_what_groups_leave(spark):
    rng = random.Random(2)
    items = [(i, rng.choice([7, 40, 90, rng.randint(1, 100)])) for i in range(3000)]
    df = spark.createDataFrame(items, "doc_id bigint, length bigint")
    rows = packing.pack(df, 100, group_items=50).collect()
    bins = defaultdict(int)
    for r in rows:
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 100 and len(rows) == 3000
    at_once = len(set(packing.best_fit([n for _, n in items], 100)[0]))
    assert len(bins) <= 1.06 * at_once
    halves = packing.pack(spark.createDataFrame([(i, 60) for i in range(500)], "doc_id bigint, length bigint"), 100, group_items=50).collect()
    assert len({r["sequence_id"] for r in halves}) == 500
