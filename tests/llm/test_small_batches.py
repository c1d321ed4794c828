"""What Python gets of texts at once: batches of bounded size, and no rows it only gives back."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from winnowry.llm import common, languages, neardup, packing, substrings

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def sizes(df):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return [r["n"] for r in df.mapInArrow(run, "n bigint").collect()]


def test_batches_are_small_meanwhile(spark):
    before = spark.conf.get(KEY)
    texts = spark.range(0, 9000, 1, 1).select(F.lit("some words ").alias("a"), F.expr("repeat('abcdefghij', 300)").alias("text"))
    with common.small_batches(spark):
        found = sizes(texts)
    assert sum(found) == 9000 and max(found) <= 1.1 * common.BATCH_BYTES / 3000
    with pytest.raises(ValueError), common.small_batches(spark, 1000):
        raise ValueError
    assert spark.conf.get(KEY) == before and sizes(texts) == [9000]


def test_stages_use_them(spark, make_docs, monkeypatch):
    docs = make_docs([(i, f"some words of text {i} " + " ".join(f"w{i * k}" for k in range(30))) for i in range(20)])
    seen, before = {}, spark.conf.get(KEY)

    def noting(kept):
        def noted(df, label):
            seen[label] = spark.conf.get(KEY)
            return kept(df, label)
        return noted

    for module in (common, neardup, packing):
        monkeypatch.setattr(module, "stored", noting(module.stored))
    assert neardup.without_near_duplicates(docs).count() == 20
    assert substrings.without_passages(docs).count() == 20
    assert packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).count() == 20
    small = str(common.BATCH_BYTES)
    assert [seen[x] for x in ("near-sketches", "near-sets", "cuts", "pack-items")] == [small] * 4
    assert spark.conf.get(KEY) == before


def test_languages_give_back_decisions_only(spark, make_docs):
    docs = make_docs([(i, "the words of one language in here") for i in range(30)] + [(40, None), (41, ""), (42, "12 34 !!")])
    kept = languages.identified(docs, languages.train(docs))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "MapInArrow" not in plan and "ArrowEvalPython" not in plan
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == list(range(30))


def test_a_worker_keeps_one_encoder_of_bounded_size(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = packing.encoder(path)
    assert encode is packing.encoder(path)
    known = [c.cell_contents for c in encode.__closure__ if isinstance(c.cell_contents, packing.WordIds)][0]
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    text = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}z" for i in range(300))
    known.clear()
    assert encode(text) == encode(text) and len(known) <= 50
