"""Readers on small trees, and streams with timers and restarts."""

import contextlib
import json
import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from winnowry import session
from winnowry.config import ScanRules
from winnowry.functions import json_text
from winnowry.sources import byte_tail, json_ranges, readers, writers
from winnowry.streaming import state, tail, versions


def test_source_tree(spark, tmp_path):
    root = tmp_path / "build" / "repo"
    for name, data in {"src/a.py": b"x = 1", "src/b.PY": b"caf\xe9 ok", "tests/c.py": b"x", "src/d.md": b"x",
                       "src/e.c": b" \n\t", "node_modules/deep/f.go": b"x"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    listed = {r.path: r.length for r in readers.list_source_files(spark, str(root)).collect()}
    assert listed == {f"{root}/src/a.py": 5, f"{root}/src/b.PY": 7, f"{root}/src/e.c": 3}
    files = readers.read_source_files(spark, str(root))
    assert {r.path: r.text for r in files.collect()} == {f"{root}/src/a.py": "x = 1", f"{root}/src/b.PY": "caf ok"}
    assert scanned(files) == 3  # the content below ignored folders is never read


def test_source_tree_with_encoded_names(spark, tmp_path):
    """Roots and folders that a URL spells otherwise are told by their plain paths."""
    root = tmp_path / "a tree" / "build"
    for name in ("src/a.py", "my dir/b.py", "skip me/c.py", "build/d.py"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("x")
    rules = ScanRules(extensions=(".py",), ignored_directories=("build", "skip me"))
    read = {r.path for r in readers.read_source_files(spark, str(root), rules).collect()}
    assert read == {f"{root}/src/a.py", f"{root}/my dir/b.py"}


def scanned(df):
    """Files read by the one scan of a query that has run."""
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value()


def test_jsonl_skips_bad_lines(spark, tmp_path):
    good = json.dumps({"instruction": "i", "response": "r", "quality_score": 0.5})
    (tmp_path / "a.jsonl").write_text(f"{good}\n\nnot json\n{{\"instruction\": \n{good}\n")
    rows = readers.read_jsonl(spark, str(tmp_path)).orderBy("file_path", "pos").collect()
    assert [(r.instruction, r.context, r.quality_score) for r in rows] == [("i", None, 0.5)] * 2


def test_json_array_count(spark, tmp_path):
    for name, body in {"a": "[{}, {}, 3]", "b": "{}", "c": "[1, 2"}.items():
        (tmp_path / name).write_text(body)
    counts = [readers.count_json_array(spark, str(tmp_path / n)) for n in ("a", "b", "c", "missing")]
    assert counts == [3, 0, 0, 0]


def test_key_values_last_line_wins(spark, tmp_path):
    (tmp_path / "env").write_text("# c=1\nA = 1=2 \n\nB=\nnothing\nA=3\n")
    assert {r.key: r.value for r in readers.read_key_values(spark, str(tmp_path)).collect()} == {"A": "3", "B": ""}


def test_lines_and_tokens(spark, tmp_path):
    (tmp_path / "l").write_text(" a \n\n# b\n\tc\n")
    assert [r.value for r in readers.read_lines(spark, str(tmp_path / "l"), True).collect()] == ["a", "c"]
    rows = spark.createDataFrame([(1, 5), (2, 0), (3, -1)], "ts bigint, tokens bigint")
    writers.append_tokens(rows, str(tmp_path / "t"))
    assert [tuple(r) for r in readers.read_token_log(spark, str(tmp_path / "t")).collect()] == [(1, 5)]


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get(session.SHARED_DIR_KEY, None)
    path = session.scratch(spark, "x")
    assert "x-" in path and (configured is None or path.startswith(configured.rstrip("/")))


def test_last_lines_follow_file_order(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(3):
        (source / f"z{9 - i}.log").write_text("".join(f"{i}-{j}\n" for j in range(4)) + "\n")
        time.sleep(1.1)
    stream = tail.line_stream(tail.stream_session(spark), str(source), 1)
    query = tail.start(tail.keep_last_lines(stream, out, n=6), str(tmp_path / "cp"))
    assert query.awaitTermination(60)
    got = tail.read_last_lines(spark, out).orderBy("file_time", "file_path", "start", "row").collect()
    assert [r.line for r in got] == ["1-2", "1-3", "2-0", "2-1", "2-2", "2-3"]


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "run_id bigint, pos bigint, counters_delta map<string,double>"
    s = tail.stream_session(spark)

    def step(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        folded = state.fold_counters(tail.json_stream(s, source, schema))
        assert tail.start(versions.write_versions(folded, out, ["run_id", "counter"]), str(tmp_path / "cp")).awaitTermination(60)
        return {(r.run_id, r.counter): r.value for r in versions.read_versions(spark, out, ["run_id", "counter"]).collect()}

    assert step([(1, 1, {"a": 2.0, "train_loss": 0.9})]) == {(1, "a"): 2.0, (1, "train_loss"): 0.9}
    assert step([(1, 2, {"a": 3.0, "train_loss": 0.4}), (2, 3, {"a": 1.0})]) == {
        (1, "a"): 5.0, (1, "train_loss"): 0.4, (2, "a"): 1.0}


def test_silent_runs_are_reported(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "run_id bigint, pos bigint, seq bigint"
    spark.createDataFrame([(1, 1, 20), (1, 2, 12), (1, 3, 9), (2, 1, 4), (None, 1, 1)], schema).coalesce(1).write.json(source)
    stream = tail.json_stream(tail.stream_session(spark), source, schema)
    query = tail.start(tail.append_files(state.silent_runs(stream, 2), out, "parquet"), str(tmp_path / "cp"), interval="1 second")
    rows = []
    try:
        for _ in range(60):
            time.sleep(1)
            with contextlib.suppress(Exception):
                rows = spark.read.schema(schema).parquet(out).collect()
            if len(rows) >= 3:
                break
    finally:
        query.stop()
    assert {tuple(r) for r in rows} == {(1, 3, 9), (2, 1, 4), (None, 1, 1)}


def brute_flags(rows, gap=10, wait=30):
    """run, pos -> restarted, accepted, mismatch, stale, update by update."""
    out, last = {}, {}
    for run, pos, seq, ts, reported in rows:
        own, (number, time_) = run == reported, last.get(run, (None, None))
        restarted = number is not None and own and seq < number - gap
        accepted = number is None or restarted or seq > number
        late = time_ is not None and ts - time_ > timedelta(seconds=wait)
        out[run, pos] = (restarted, accepted, not accepted and not own, not accepted and own and late)
        if accepted:
            last[run] = (seq, ts)
    return out


def test_flags_go_on_from_batch_to_batch(spark, tmp_path):
    rng, path, begun = random.Random(4), str(tmp_path / "out"), datetime(2024, 1, 1)
    rows = [(rng.choice([1, 1, 1, 2]), i, rng.randrange(40), begun + timedelta(seconds=9 * i), rng.choice([1, 1, 2])) for i in range(240)]
    schema = "run_id bigint, pos bigint, seq bigint, ts timestamp, reported_run_id bigint"
    for k in range(4):
        batch = spark.createDataFrame(rng.sample(rows[60 * k:60 * k + 60], 60), schema)
        for _ in range(1 + (k == 2)):  # the third is repeated
            flags, last = state.flag_batch(batch, versions.read_versions(spark, f"{path}/last", ["run_id"], k))
            versions.commit(flags, k, f"{path}/flags", None)
            versions.commit(last, k, f"{path}/last", ["run_id"])
    got = {(r.run_id, r.pos): (r.restarted, r.accepted, r.mismatch, r.stale) for r in versions.read_versions(spark, f"{path}/flags", None).collect()}
    assert got == brute_flags(rows)
    assert {k for k, v in enumerate(zip(*got.values(), strict=True)) if any(v)} == {0, 1, 2, 3}


def test_versions_stay_few_and_newest(spark, tmp_path):
    path, want, rows = str(tmp_path / "out"), {}, []
    for k in range(20):
        rows = [(i, k * 100 + i) for i in range(k % 4, 8, 2)]
        want.update(rows)
        versions.commit(spark.createDataFrame(rows, "k bigint, v bigint").coalesce(1), k, path, ["k"])
        assert versions.live_runs(spark, path) <= 2 * 3
    assert {r.k: r.v for r in versions.read_versions(spark, path, ["k"]).collect()} == want
    named = {r["name"] for m in versions.manifests(versions.Folder(spark, path)) for r in versions.runs_of(versions.Folder(spark, path), m)}
    assert set(os.listdir(tmp_path / "out" / "runs")) == named
    assert len(versions.manifests(versions.Folder(spark, path))) == versions.KEPT


def test_an_interrupted_merge_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    row = lambda k: spark.createDataFrame([(1, k), (k + 2, k)], "k bigint, v bigint").coalesce(1)
    for k in range(2):
        versions.commit(row(k), k, path, ["k"])
    published = versions.Folder.publish
    monkeypatch.setattr(versions.Folder, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        versions.commit(row(2), 2, path, ["k"])  # the third run is merged, then the driver goes
    before = {r.k: r.v for r in versions.read_versions(spark, path, ["k"]).collect()}
    assert before == {1: 1, 2: 0, 3: 1}
    monkeypatch.setattr(versions.Folder, "publish", published)
    for _ in range(2):  # and once more, as when the stream did not note the batch as done
        versions.commit(row(2), 2, path, ["k"])
        assert {r.k: r.v for r in versions.read_versions(spark, path, ["k"]).collect()} == {1: 2, 2: 0, 3: 1, 4: 2}
        assert versions.live_runs(spark, path) == 1
    versions.commit(row(3), 3, path, ["k"])
    assert len(versions.read_versions(spark, path, ["k"]).collect()) == 5


def test_logs_that_grow_shrink_and_change(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    session = tail.stream_session(spark)

    def lines(name, content, mode="a"):
        with open(source / name, mode + "b") as f:
            f.write(content)

    def caught_up():
        stream = tail.growing_text(session, str(source), ".log", 7)  # ranges of seven bytes
        assert tail.start(tail.append_files(stream, out, "parquet"), str(tmp_path / "cp")).awaitTermination(60)
        return sorted((os.path.basename(r.file_path), r.start, r.line) for r in spark.read.parquet(out).collect())

    lines("a.log", b"one\ntwo\n\n  \nthr")
    lines("b.log", "\u00fcber\r\nbad \xff\n".encode("latin-1"))
    lines("other.txt", b"no\n")
    first = [("a.log", 0, "one"), ("a.log", 4, "two"), ("b.log", 0, "\ufffdber"), ("b.log", 6, "bad \ufffd")]
    assert caught_up() == first
    lines("a.log", b"ee is longer than a range\nfour\n")
    second = first + [("a.log", 12, "three is longer than a range"), ("a.log", 41, "four")]
    assert caught_up() == sorted(second) and caught_up() == sorted(second)
    lines("a.log", b"new\n", "w")  # shorter
    lines("b.log", b"quite other lines\nin a longer file\n", "w")
    third = second + [("a.log", 0, "new"), ("b.log", 0, "quite other lines"), ("b.log", 18, "in a longer file")]
    assert caught_up() == sorted(third)


def test_ranges_cover_every_line_once(tmp_path):
    rng = random.Random(9)
    lines = ["x" * rng.choice([0, 1, 3, 50]) for _ in range(200)]
    (tmp_path / "a.log").write_text("".join(f"{x}\n" for x in lines))
    size = (tmp_path / "a.log").stat().st_size
    for piece in (1, 2, 5, 51, 1000, 10**6):
        got = [row[3] for begin in range(0, size, piece) for row in byte_tail.lines_in(
            str(tmp_path), byte_tail.Range(str(tmp_path / "a.log"), 0.0, 0, begin, min(size, begin + piece), size))]
        assert got == lines


def test_the_end_of_a_huge_file(spark, tmp_path):
    """Eight gigabytes of nothing are not read."""
    with open(tmp_path / "huge.log", "wb") as f:
        f.truncate(8 << 30)
        f.seek(0, 2)
        f.write(b"cut line\nlast but one\nlast")
    (tmp_path / "small.log").write_text("a\nb\u2028c\n")
    (tmp_path / "empty.log").write_text("")
    got = [(os.path.basename(r.file), r.line) for r in byte_tail.last_lines(spark, str(tmp_path), 2, 25, ".log").collect()]
    assert sorted(got) == [("huge.log", "last"), ("huge.log", "last but one"), ("small.log", "b"), ("small.log", "c")]
    assert byte_tail.last_lines(spark, str(tmp_path / "none"), 2).count() == 0


@pytest.mark.parametrize("broken", ['{"pos": ', "plain"])
def test_event_stream_skips_broken_lines(spark, tmp_path, broken):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.json").write_text(f'{{"run_id": "a", "message": "m"}}\n{broken}\n')
    out = str(tmp_path / "out")
    stream = tail.prepared_events(tail.json_stream(tail.stream_session(spark), str(tmp_path / "in")))
    assert tail.start(tail.append_files(stream, out), str(tmp_path / "cp")).awaitTermination(60)
    rows = spark.read.json(out).select("run_id", "message", F.col("event_version")).collect()
    assert [tuple(r) for r in rows] == [("a", "m", "1.0")]


def test_jsonl_keeps_every_decodable_object(spark, tmp_path):
    from pyspark.sql import functions as F

    from winnowry.functions import text
    from winnowry.sources import readers

    lines = ['{"instruction":"i","response":"r","quality_score":"0.9"}', '{"instruction":"i","response":"r","quality_score":true}',
             '{"instruction":["x"],"response":"r","quality_score":0.5}', '{"instruction":5,"response":"r","quality_score":[1]}',
             '{"instruction":null,"response":"r"}', '{"instruction":"a","instruction":"b","response":"r"}',
             ' {"response":"NaN","quality_score":Infinity, "x": NaN}', '{"instruction":NaN,"response":"r","quality_score":"NaN","x":NaN}',
             '{"broken', "", "[1]", "7", "NaN", '{"x":NaN']
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    rows = readers.read_jsonl(spark, str(tmp_path)).orderBy("pos")
    got = [(r.instruction, r.response, "nan" if r.quality_score != r.quality_score else r.quality_score) for r in rows.collect()]
    assert got == [("i", "r", 0.9), ("i", "r", 1.0), (None, "r", 0.5), (None, "r", None), (None, "r", None), ("b", "r", None), (None, "NaN", float("inf")), (None, "r", "nan")]
    valid = [r.v for r in rows.select(text.valid_format(F.col("instruction"), F.col("response")).alias("v")).collect()]
    assert not any(valid[2:5])


@pytest.mark.parametrize("text,rows", [
    ("[]", 0), (" [ ]\n", 0), ("[1]", 1), ('["a,b", "c\\"],[", {"d": [1, 2, "}"]}, [], null]', 5), ('["\\\\", "\\\\\\" ,"]', 2),
    ('[{"a": NaN, "a": 2}, Infinity]', 2), ("[1,]", 0), ("[,1]", 0), ("[1 2]", 0), ("[1", 0), ("[1]]", 0), ("[1][2]", 0), ("[1] x", 0), ('"[1]"', 0),
    ("{}", 0), ("[1}", 0), ("", 0), ("  ", 0), ('["a]', 0), ("[" + ", ".join(f'"{"x" * i}"' for i in range(60)) + "]", 60)])
def test_arrays_cut_at_every_byte(spark, tmp_path, text, rows):
    (tmp_path / "a.json").write_text(text)
    for size in (1, 2, 3, 7, 1 << 20):
        reader = json_ranges.Ranges({"path": str(tmp_path), "rangeBytes": str(size)})
        starts, state, depth, begun = [], 0, 0, False
        for piece in reader.partitions():
            if piece.file:
                starts.append([state, depth, begun])
                state, change, solid = json_ranges.effects(str(tmp_path), piece)[state]
                depth, begun = depth + change, begun or solid
        whole = json_ranges.Ranges({"path": str(tmp_path), "rangeBytes": str(size), "starts": json.dumps({str(tmp_path / "a.json"): starts})})
        found = [x for p in whole.partitions() if p.file for x in json_ranges.elements(str(tmp_path), p)]
        fine = bool(found) and all(v is not None and (v == "" or json_text.loaded(v) is not None or v == "null") for _, v in found)
        assert (sum(v != "" for _, v in found) if fine else 0) == rows, size
        if rows:
            assert [json.loads(v) for _, v in found if v] == json.loads(text) or "NaN" in text


def test_counts_of_large_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"i": i, "t": '],"\\' * (i % 50)} for i in range(5000)], indent=1))
    (tmp_path / "b.json").write_text("[1, 2")
    (tmp_path / "c.json").write_text('[{"a": 1, "a": 2}, NaN]')
    got = {os.path.basename(r.file_path): r.rows for r in readers.json_array_counts(spark, str(tmp_path), 10_000).collect()}
    assert got == {"a.json": 5000, "b.json": 0, "c.json": 2}
