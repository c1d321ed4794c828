import hashlib

from pyspark.sql import functions as F

from winnowry.llm import fingerprints as fp


def edited_by_hand(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for at, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        out[doc_id] = text[:len(text) - third] + after[:third]
    return out


def test_edited_texts_across_bucket_borders(spark, documents, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 1)  # more than 64 buckets, so both steps of the search run
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    wanted = edited_by_hand(rows)
    got = fp.fingerprint_documents(documents).collect()
    assert len(got) == len(rows)
    assert all(r["edited_sha256"] == hashlib.sha256(wanted[r["doc_id"]].encode()).hexdigest() for r in got)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert sum(r["near_edited"] for r in got) / len(got) > 0.4
    by_text = {}
    for doc_id, text in rows:
        by_text.setdefault(text, set()).add(next(r["fingerprint"] for r in got if r["doc_id"] == doc_id))
    assert all(len(v) == 1 for v in by_text.values())


def test_odd_documents(odd_docs):
    got = fp.fingerprint_documents(odd_docs).collect()
    assert len(got) == 10
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["fingerprint"] == by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == ""
    assert by_id[2]["n_chars"] == 0 and by_id[6]["n_chars"] == 1 and by_id[6]["fingerprint"] != ""
    # Ids go down, nulls last; the last document is followed by the first.
    wanted = edited_by_hand([(r["doc_id"], r["text"]) for r in odd_docs.dropDuplicates(["doc_id"]).collect()])
    assert by_id[None]["edited_sha256"] == hashlib.sha256(wanted[None].encode()).hexdigest()
    assert by_id[8]["edited_sha256"] == hashlib.sha256(wanted[8].encode()).hexdigest()


def test_empty_and_single(spark, odd_docs):
    assert fp.fingerprint_documents(odd_docs.limit(0)).count() == 0
    one = fp.fingerprint_documents(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id bigint, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"a b c d e " + b"a b c").hexdigest()
    assert one["near_next"] == 1.0
    assert fp.fingerprint_documents(spark.createDataFrame([(None, "abc")], "doc_id bigint, text string")).count() == 1


def test_merge_and_containment(spark):
    a, b = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(4000))
    row = spark.createDataFrame([(a, b, f"{a} {b}")], "a string, b string, ab string").select(
        fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"), fp.sketch(F.col("ab")).alias("ab")).select(
        fp.containment(F.col("a"), F.col("ab")).alias("c"), fp.likeness(F.col("a"), F.col("ab")).alias("j"),
        F.size(F.array_except(fp.merge(F.col("a"), F.col("b")), "ab")).alias("lost"),
        F.size(F.array_except("ab", fp.merge(F.col("a"), F.col("b")))).alias("border")).first()
    assert row["c"] == 1.0 and row["j"] < 0.2 and row["lost"] == 0 and row["border"] <= fp.SHINGLE_WORDS - 1
