"""The pipeline against its stages in plain Python, and its entry points."""

import random
from collections import defaultdict
from pathlib import Path

import oracle_check as oc
import pytest
import test_decontamination as leaks
import test_neardup as near

import __spark_entry__ as entry
import corpus_pipeline
from winnowry import session


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """Twenty documents of each kind the stages act on, beside the given ones."""
    out = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(8)
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    english = [r["text"] for r in given.filter("lang = 'en' and n_chars > 900").collect()]
    words = sorted({w for t in english for w in t.split()})
    say = lambda n: [rng.choice(words) for _ in range(n)]
    passage, item = " ".join(say(60)), items.first()["text"]
    rows = [(10_000 + i, "12 34 !!") for i in range(20)]
    for i in range(20):
        base = say(200)
        edited = list(base)
        edited[100] = "changed"
        rows += [(20_000 + 2 * i, " ".join(base)), (20_001 + 2 * i, " ".join(edited))]
        rows.append((30_000 + i, " ".join(say(80) + [passage] + say(80))))
        rows.append((40_000 + i, " ".join(say(50) + [item] + say(50))))
    extra = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], given.schema)
    given.unionByName(extra).write.parquet(f"{out}/documents.parquet")
    items.write.parquet(f"{out}/benchmark.parquet")
    return out, passage


def test_stages_act_and_keep_columns(spark, folder):
    path, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, [{r["doc_id"]: r["text"] for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, path), "test-stage")
        assert docs.columns == columns, name
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    first, by_language, by_near, by_passage, by_leak = kept
    assert not any(10_000 <= i < 20_000 for i in by_language) and len(by_language) >= len(first) - 22
    wanted = near.by_hand(by_language.items(), 5, 80, 100)
    assert set(by_near) == {i for i, (_, _, stays) in wanted.items() if stays} and by_near.items() <= by_language.items()
    assert sum(passage in t for t in by_near.values()) == 20
    assert sum(passage[60:-60] in t for t in by_passage.values()) == 1
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    told = {r[0]: r[-1] for r in leaks.by_hand(by_passage.items(), items)}
    assert by_leak == {i: t for i, t in by_passage.items() if not told[i]}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r["doc_id"] for r in rows} == set(by_leak)
    fill = defaultdict(int)
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096 and len(fill) <= -(-sum(fill.values()) // 4096) + 1


def test_run_matches_its_stages_and_tidies_up(spark, sf_dir):
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language_id"
    root = Path(session.shared_dir(spark).removeprefix("file:"), "winnowry")
    before = set(root.iterdir()) if root.exists() else set()
    rows = corpus_pipeline.run(spark, sf_dir)
    # Chained without writing in between: no stage may remove what its predecessor's rows still read.
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = set(root.iterdir()) - before
    assert [p.name.rsplit("-", 1)[0] for p in left] == ["stage-best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    by_piece = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert rows.count() > 0 and by_piece(rows) == by_piece(docs)


@pytest.mark.parametrize("name", sorted(entry.LLM_SQL))
def test_queries_match_sql(spark, sf_dir, name):
    assert oc.differences(entry.queries()[name](spark, sf_dir), oc.connect(sf_dir), entry.LLM_SQL[name]) == []


def test_registered():
    names = set(entry.queries())
    assert {f"op{i}_" for i in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")} and "pipeline" in names
