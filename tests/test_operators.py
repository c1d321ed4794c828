"""Operators on hand-built and random rows against brute force."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnowry.config import CleanRules
from winnowry.operators import (
    cleaning, config_rules, evaluating, folds, generation, loglines, pricing, ranking, runs, sequence, training,
)


def replay(seqs, gap=10):
    last, out = None, []
    for s in seqs:
        restarted = last is not None and s < last - gap
        accepted = last is None or restarted or s > last
        out.append((last, restarted, accepted))
        last = s if accepted else last
    return out


def replayed(spark, rows, **blocks):
    df = spark.createDataFrame(rows, "run_id string, pos bigint, seq bigint")
    out = sequence.replay_sequence(df, **blocks).collect()
    return {(r.run_id, r.pos): (r.last_before, r.restarted, r.accepted) for r in out}


def expected(rows):
    want = {}
    for run in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == run), key=lambda r: r[1])
        want.update({(run, p): v for (_, p, _), v in zip(mine, replay([r[2] for r in mine]), strict=True)})
    return want


def test_replay_named_cases(spark):
    rows = [("a", i, s) for i, s in enumerate([20, 12, 9, 9, 10, 5, 0, 0, 30, 19, 20])]
    got = replayed(spark, rows)
    assert got == expected(rows)
    assert got[("a", 2)] == (20, True, True)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6))
def test_replay_in_small_blocks(spark, seed):
    rng = random.Random(seed)
    positions = rng.sample(range(400), 150)
    rows = [(rng.choice(["a", "a", "a", "b", None]), p * 10**9, rng.randrange(rng.choice([15, 40]))) for p in positions]
    assert replayed(spark, rows, fan_bits=1) == expected(rows)


@pytest.mark.parametrize("largest", [True, False])
def test_running_extreme_in_small_blocks(spark, largest):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "b", None]), p * 10**6, rng.randrange(50)) for p in rng.sample(range(300), 120)]
    df = spark.createDataFrame(rows, "k string, pos bigint, v bigint")
    got = {(r.k, r.pos): r.m for r in sequence.running_extreme(
        df, ["k"], "pos", F.col("v"), "m", largest, block_bits=4).collect()}
    for k, p, _ in rows:
        before = [v for k2, p2, v in rows if k2 == k and p2 < p]
        assert got[(k, p)] == ((max if largest else min)(before) if before else None)


def test_sequence_guard_and_stale(spark):
    rows = [("r", 0, 5, "2024-01-01 00:00:00"), ("r", 1, 5, "2024-01-01 00:00:30"), ("r", 2, 5, "2024-01-01 00:00:30.5"),
            ("r", 3, 5, "2024-01-01 00:00:31"), ("r", 4, 6, "2024-01-01 00:01:00"), ("r", 5, 1, "2024-01-01 00:01:10"),
            (None, 0, 3, "2024-01-01 00:00:00"), (None, 1, 3, "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "run_id string, pos bigint, seq bigint, ts string").withColumn(
        "ts", F.to_timestamp_ntz("ts"))
    guarded = {(r.run_id, r.pos): r.accepted for r in sequence.guard_sequence(df, ["run_id"]).collect()}
    assert guarded == {("r", 0): True, ("r", 1): False, ("r", 2): False, ("r", 3): False, ("r", 4): True, ("r", 5): False,
                       (None, 0): True, (None, 1): False}
    stale = {(r.run_id, r.pos) for r in sequence.stale_flags(sequence.replay_sequence(df, ts="ts")).collect() if r.stale}
    assert stale == {("r", 2), ("r", 3), (None, 1)}


def test_top_n_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 50}", rng.randrange(1000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, pos int").repartition(12)
    got = ranking.top_n_per_group(df, ["k"], [F.col("v").desc(), F.col("pos")], 5, slots=3, rank_name="rn").collect()
    want = set()
    for k in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))[:5]
        want |= {(k, r[2], i + 1) for i, r in enumerate(best)}
    assert {(r.k, r.pos, r.rn) for r in got} == want


def test_top_n_keeps_the_group_limit_in_the_plan(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = ranking.top_n_per_group(df, ["k"], [F.col("id")], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4
    plan = ranking.first_per_group(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


SAMPLE = "pos bigint, instruction string, context string, response string, quality_score double"


def test_dedupe_keeps_the_first(spark):
    rows = [(3, "a", "", "bc", 1.0), (1, "ab", "", "c", 0.0), (2, "x", "", "y", 0.0)]
    got = cleaning.deduplicate(spark.createDataFrame(rows, SAMPLE), ["pos"]).collect()
    assert sorted(r.pos for r in got) == [1, 2]


def reasons(spark, rows, rules=CleanRules()):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SAMPLE)
    return {r.pos: r.reject_reason for r in cleaning.judge(df, rules).collect()}


def test_filter_reasons_in_order(spark):
    words = "some ordinary words about code and data, number %d. "
    long = "".join(words % i for i in range(400))
    rows = [
        ("short", "", long[:100], 1.0), (None, "", long[:100], 1.0), ("instruction", "", "a soldier " * 10, 1.0),
        ("idiot trash instruction", "", long[:100], 1.0), ("i" * 19, "", long[:30], 1.0), ("i" * 20, "", long[:30], 1.0),
        ("i" * 20, "", long[:7980], 1.0), ("i" * 20, "c" * 9000, long[:7981], 1.0), ("i" * 20, "", "a" * 40, 0.0),
        ("i" * 20, "x", "a" * 600, 1.0),
    ]
    assert reasons(spark, rows) == {
        0: "format", 1: "format", 2: "toxic", 3: None, 4: "length", 5: None, 6: None, 7: "length", 8: "quality", 9: "entropy"}


def test_balance_and_stats(spark):
    rows = [(i, "python" if i % 2 else "go", float(i % 5), "r" * i) for i in range(20)]
    df = spark.createDataFrame(rows, "pos bigint, detected_language string, quality_score double, response string")
    kept = cleaning.balance_by_language(df, ["pos"], CleanRules(max_per_language=3))
    assert sorted(r.pos for r in kept.collect()) == [3, 4, 8, 9, 14, 19]
    stats = cleaning.cleaning_stats(kept).first()
    assert stats.total_samples == 6 and stats.language_distribution == {"go": 3, "python": 3}
    empty = cleaning.cleaning_stats(df.filter("pos < 0")).first()
    assert (empty.total_samples, empty.avg_quality_score, empty.avg_response_length) == (0, 0.0, 0.0)


def test_generation_templates(spark):
    files = spark.createDataFrame(
        [("ai-lab/repos/r/a.py", "x = 1"), ("ai-lab/repos/r/b.py", " \n")], "path string, text string")
    got = {r.instruction: r.response for r in generation.generate_samples(files).collect()}
    assert len(got) == 9 and got["bug_hunt"].startswith("No obvious") and got["refactor_premium"] == "x = 1"
    assert got["explain_deep"] == got["architecture_notes"] == "Generated sample."
    assert got["tests_premium"].startswith("def test_example")
    plan = generation.generate_samples(files)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_counter_fold(spark):
    rows = [("r", 2, {"train_loss": 0.5, "made": 2.0}), ("r", 1, {"train_loss": 0.9, "made": -1.0}), ("r", 3, {"new": 4.0})]
    df = spark.createDataFrame(rows, "run_id string, pos bigint, counters_delta map<string,double>")
    assert {r.counter: r.value for r in folds.fold_deltas(df).collect()} == {"train_loss": 0.5, "made": 1.0, "new": 4.0}


def test_upsert_state(spark):
    stored = spark.createDataFrame([("a", "idle", 1, "t0", 4), ("z", "idle", 1, "t0", 9)],
                                   "run_id string, status string, step int, updated_at string, sequence_number bigint")
    updates = spark.createDataFrame([("a", 1, "running", None, "t1"), ("a", 2, None, 7, "t2"), ("b", 1, "new", None, "t1")],
                                    "run_id string, pos bigint, status string, step int, updated_at string")
    got = {r.run_id: tuple(r)[1:] for r in folds.upsert_state(stored, updates, ["status", "step"]).collect()}
    assert got == {"a": ("running", 7, "t2", 6), "z": ("idle", 1, "t0", 9), "b": ("new", None, "t1", 1)}


def test_prices(spark):
    usage = spark.createDataFrame([("gpt-4o", 10**6, 10**6), ("nope", 10**6, 0)], "model string, i bigint, o bigint")
    table = pricing.price_table(spark)
    assert {r.model: r.cost_usd for r in pricing.add_cost(usage, table, "i", "o").collect()} == {"gpt-4o": 12.5, "nope": 0.0}
    plan = pricing.add_cost(usage, table, "i", "o")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    names = spark.createDataFrame([("x/GROK-4-1-fast-2",), ("xai/grok.4.1.fast",), ("my-gpt-4o",), ("other",)], "m string")
    cost = pricing.rule_cost(F.col("m"), F.lit(1000), F.lit(1000))
    assert [r[0] for r in names.select(cost).collect()] == pytest.approx([0.7, 0.7, 12.5, 0.0])


def test_progress_choice(spark):
    bars = [(1, 10, 500), (2, 20, 2000), (3, 30, 500), (4, 40, 2000)]
    rows = [(s, p, step, total, 0.5, cfg) for s, cfg in (("seen", 500), ("unseen", 999), ("none", None)) for p, step, total in bars]
    df = spark.createDataFrame(rows, "source string, pos bigint, bar_step bigint, bar_total bigint, sec_per_it double, configured_total int")
    got = {r.source: r.training_step for r in loglines.pick_progress(df).collect()}
    assert got == {"seen": 30, "unseen": 20, "none": 40}


def test_training_lines_fall_back_to_all(spark):
    rows = [("a", 1, "Step 1/2"), ("a", 2, "hello"), ("b", 1, "hello"), ("b", 2, "there")]
    df = spark.createDataFrame(rows, "source string, pos bigint, line string")
    assert sorted((r.source, r.pos) for r in loglines.training_lines(df).collect()) == [("a", 1), ("b", 1), ("b", 2)]


def test_best_run(spark):
    rows = [("r1", 1, None, 0.5), ("r2", 2, 0.0, 0.4), ("r3", 3, 0.4, 0.1), ("r4", 4, None, None)]
    df = spark.createDataFrame(rows, "run_id string, pos bigint, best_eval_loss double, final_loss double")
    losses = df.withColumn("loss", runs.effective_loss(F.col("best_eval_loss"), F.col("final_loss")))
    assert runs.best_run(losses, "loss", "pos").first().run_id == "r2"
    history = {r.run_id: r.is_best for r in sequence.best_so_far(losses, "pos", "loss").collect()}
    assert history == {"r1": True, "r2": True, "r3": False, "r4": False}


def test_config_rules(spark):
    rows = [("ok", "ROUNDS", "int", "3"), ("ok", "OUT_DIR", "str", "x"), ("bad", "ROUNDS", "int", "0"), ("bad", "SEQ_LEN", "int", "9000"),
            ("bad", "NOPE", "str", "1"), ("bad", "LORA_R", "str", "5"), ("bad", "RUN_UNIT_TESTS", "str", "2"), ("bad", "SEED", "str", "1")]
    configs = spark.createDataFrame(rows, "run_id string, key string, type string, value string")
    found = config_rules.violations(configs, config_rules.rule_table(spark, required=("OUT_DIR",))).collect()
    assert {(r.run_id, r.key, r.violation) for r in found} == {
        ("bad", "ROUNDS", "too small"), ("bad", "SEQ_LEN", "too large"), ("bad", "NOPE", "unknown"), ("bad", "LORA_R", "type"),
        ("bad", "RUN_UNIT_TESTS", "not allowed"), ("bad", "OUT_DIR", "missing")}


def test_split_and_gate(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    split = training.split_validation(df, training.hashed_bucket("k"), 0.05)
    held = split.filter("split = 'validation'").count()
    assert 60 < held < 140 and held == split.repartition(7).filter("split = 'validation'").count()
    assert training.split_validation(df, training.hashed_bucket("k"), 0.0).filter("split = 'validation'").count() == 0
    assert tuple(training.has_at_least(df, 200).first()) == (200, True)
    assert tuple(training.has_at_least(df.limit(3), 200).first()) == (3, False)


def test_missing_fields_and_reports(spark):
    docs = spark.createDataFrame([("a", "ok", None)], "run_id string, status string, usage string")
    assert {r.missing for r in runs.missing_fields(docs).collect()} == {"usage", "current_stage", "stage_percent", "sequence_number"}
    reports = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("", 3, "z"), (None, 4, "z")], "run_id string, pos bigint, s string")
    good, bad = runs.merge_reports(reports)
    assert [tuple(r) for r in good.collect()] == [("a", 2, "y")] and bad.count() == 2


def test_latest_round_is_numeric(spark):
    df = spark.createDataFrame([(99, "success", 0.5), (141, "success", 0.1)], "round bigint, status string, overall_score double")
    assert evaluating.latest_result(df).first()["round"] == 141
    row = evaluating.rounds_summary(df).first()
    assert (row.rounds, row.latest_round, row.latest_score, row.best_score) == (2, 141, 0.1, 0.5)


def test_parallel_log(spark):
    lines = ["Searching with query: x", "Processing 50 files with 2 workers...", "Generating:  10%|# | 5/50 [00:1, samples=45 file=a]",
             "INFO Generated 90 samples from 10 files", "x samples=12"]
    df = spark.createDataFrame([("l", i, x) for i, x in enumerate(lines)], "source string, pos bigint, line string")
    assert tuple(loglines.parallel_progress(df).first()) == ("l", "done", 10, 10, 90)


def test_second_progress_form(spark):
    from winnowry.operators import loglines

    rows = [(" 12%|##  | 30/250 | loss", 30, 250), ("Step 4/9", 4, 9), ("Step 4/9 5%| 7/8 |", 7, 8), ("| 1/2 | no sign", None, None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "line string")
    assert [(r.step, r.steps) for r in loglines.with_training_metrics(df).collect()] == [r[1:] for r in rows]


def test_every_task_is_answered(spark):
    from winnowry.sources import tables

    sf_dir = "/root/testdata/sf0.1"
    tasks = tables.eval_tasks(spark, sf_dir)
    answered = tables.eval_responses(spark, sf_dir).select("task_id").distinct()
    assert tasks.count() == 200 and tasks.join(answered, "task_id", "left_anti").count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6))
def test_replay_with_updates_of_others(spark, seed):
    """Others' numbers are accepted above the last one, and restart nothing."""
    rng = random.Random(seed)
    share = rng.choice([0.0, 0.2, 0.8, 1.0])
    rows = [(rng.choice(["a", "a", "b"]), p, rng.randrange(rng.choice([15, 40, 90])), rng.random() >= share) for p in rng.sample(range(400), 120)]
    df = spark.createDataFrame(rows, "run_id string, pos bigint, seq bigint, own boolean")
    got = {(r.run_id, r.pos): (r.last_before, r.restarted, r.accepted) for r in sequence.replay_sequence(df, own="own", fan_bits=rng.choice([1, 2, 6])).collect()}
    want = {}
    for run in ("a", "b"):
        last = None
        for _, pos, seq, own in sorted((r for r in rows if r[0] == run), key=lambda r: r[1]):
            restarted = last is not None and own and seq < last - 10
            accepted = last is None or restarted or seq > last
            want[run, pos] = (last, restarted, accepted)
            last = seq if accepted else last
    assert got == want


def test_top_by_threshold_is_exact(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([0.1, 0.5, 0.5, 0.9, rng.random(), None]), p, "text" * 20) for p in range(3000)]
    rows += [("few", None, 9000, "t"), ("few", float("nan"), 9001, "t"), ("a", 0.9, 2, "again")]
    df = spark.createDataFrame(rows, "k string, v double, pos bigint, text string").repartition(6)
    for n in (1, 40, 700):
        got = ranking.top_n_by_threshold(df, "k", "v", ["pos"], n)
        assert got.columns == df.columns
        want = ranking.top_n_per_group(df, ["k"], [F.col("v").desc(), F.col("pos")], n)
        assert sorted(map(repr, got.drop("text").collect())) == sorted(map(repr, want.drop("text").collect()))
    assert ranking.top_n_by_threshold(df.limit(0), "k", "v", ["pos"], 3).count() == 0


def test_texts_are_not_ranked(spark, monkeypatch):
    ranked = []
    whole = ranking.top_n_per_group
    monkeypatch.setattr(ranking, "top_n_per_group", lambda df, *a, **k: (ranked.append(df.columns), whole(df, *a, **k))[1])
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v"), F.col("id").alias("pos"), F.lit("t" * 500).alias("text"))
    assert ranking.top_n_by_threshold(df, "k", "v", ["pos"], 10).count() == 30
    assert ranked == [["k", "_score", "pos", "_row"]]


def test_large_rule_table_equals_the_nested_loop(spark):
    from winnowry.operators import joining
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("ab-.C") for _ in range(n))
    rules = [(i, word(rng.randint(3, 9)), rng.choice([1000, 10**6]), rng.random(), rng.random(), rng.random() < 0.5) for i in range(3000)] + [(9999, "", 1, 0.0, 1.0, False)]
    names = [word(rng.randint(0, 25)) for _ in range(150)] + ["same-Name"] * 200 + [None]
    usage = spark.createDataFrame([(i, n, 10 * i, i) for i, n in enumerate(names)], "id int, model string, pt bigint, ct bigint")
    fold = lambda s: s.lower().replace("-", "_").replace(".", "_")

    def cost(name, pt, ct):
        for _, key, unit, pin, pout, folded in rules:
            if name is not None and (fold(key) in fold(name) if folded else key.lower() in name.lower()):
                return pt / unit * pin + ct / unit * pout
        return 0.0

    table = spark.createDataFrame(rules, "rank int, key string, unit_tokens bigint, input_price double, output_price double, folded boolean")
    out = pricing.cost_by_rules(usage, table, "model", "pt", "ct")
    assert {r.id: round(r.cost_usd, 9) for r in out.collect()} == {i: round(cost(n, 10 * i, i), 9) for i, n in enumerate(names)}
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
    few = pricing.cost_by_rules(usage, table.limit(0), "model", "pt", "ct")
    assert {r.cost_usd for r in few.collect()} == {0.0}
    left = spark.createDataFrame([(1 if i % 2 else i, i) for i in range(500)] + [(None, -1)], "k bigint, v int")
    right = spark.createDataFrame([(i, f"s{i}") for i in range(0, 300, 2)] + [(1, "hot")], "k bigint, s string")
    assert sorted(map(repr, joining.left_join_skewed(left, right, "k", 3).collect())) == sorted(map(repr, left.join(right, "k", "left").collect()))
