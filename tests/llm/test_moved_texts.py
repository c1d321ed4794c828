"""What the filters of the pipeline move: the texts they judge, and each chunk or set once."""

import random

from pyspark.sql import functions as F

from winnowry.llm import common, decontamination, neardup, substrings


def test_sifting_loses_no_row(spark, monkeypatch):
    """Rows of found keys are all among the others; nulls, repeated rows and keys of another width stay whole."""
    rows = [(i % 900, f"t{i}") for i in range(1000)] + [(None, "x"), (None, None), (-5, "y"), (2**31 - 1, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for keys in ([], [None], list(range(0, 900, 10)) + [-5, 2**31 - 1, 2**40]):
        found = spark.createDataFrame([(k,) for k in keys], "_k bigint")
        for slots in (common.SLOTS, 64):  # with one row of the sieve, more rows pass by chance
            monkeypatch.setattr(common, "SLOTS", slots)
            apart, met = ([tuple(r) for r in df.collect()] for df in common.sifted(docs, found, "_k"))
            assert sorted(apart + met, key=repr) == sorted(rows, key=repr)
            assert not {k for k, _ in apart} & set(keys)
            assert slots == 64 or len(met) < 130


def shuffled(df):
    """What the joins by shuffle take from their left side, where the texts are."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    after = [[x for x in lines[i + 1:] if "Project" not in x][0] for i, line in enumerate(lines) if "Join " in line and "broadcast" not in line]
    return after


def test_filters_move_only_the_texts_they_judge(spark, make_docs):
    """Texts that no decision names meet a broadcast sieve; joins by shuffle get the rest."""
    rng = random.Random(21)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, item = say(60), say(30)
    rows = [(i, say(200)) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(3)] + [(200 + i, f"{say(80)} {passage} {say(80)}") for i in range(3)]
    rows += [(300 + i, f"{say(80)} {item} {say(80)}") for i in range(3)]
    docs, items = make_docs(rows), spark.createDataFrame([(1, item)], "item_id bigint, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out, left in ((neardup.without_near_duplicates(docs), 66), (substrings.without_passages(docs), None),
                          (decontamination.without_leaks(docs, items), 66)):
            assert shuffled(out) and all("LeftSemi" in line and "broadcast" in line for line in shuffled(out))
            assert left is None or out.count() == left
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_chunks_move_once_and_are_not_stored(spark, documents):
    with common.noted() as paths:
        found = substrings.repeated_passages(documents)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not paths and "Join" not in plan and plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning(digest") == 1


def test_sets_are_made_of_wanted_texts_alone(spark, make_docs, monkeypatch):
    """Only texts that the sieve lets through are joined by shuffle; each set moves once."""
    made = []
    monkeypatch.setattr(neardup, "stored", lambda df, label: made.append(df) or df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = make_docs([(1, "a b c d"), (1, "a b c d"), (2, "e f g h"), (3, None)])
        wanted = neardup.sketches(docs, 3, 48).filter("doc_id = 1").select(F.lit(7).cast("bigint").alias("key"), "doc_id", "digest").distinct()
        assert [(r["key"], len(r["hashes"])) for r in neardup.full_sets(docs, wanted, 3).collect()] == [(7, 2)]
        plan = made[-1]._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" in plan and "broadcast" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
