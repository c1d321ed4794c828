import json

from pyspark.sql import functions as F

from winnowry.llm import chat


def formatted(spark, records):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "id int, record string")
    return [r for r in chat.formatted(chat.canonical_turns(df)).withColumns({
        "back": chat.read_back(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))}).orderBy("id").collect()]


def test_layouts_become_turns(spark):
    records = [
        {"prompt": "p", "response": "r"}, {"system": "s", "instruction": "i", "output": None},
        {"instruction": "i", "input": 5, "output": "o"},
        {"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}, {"messages": []},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "tool", "value": "t"}]},
        {"chat": {"turns": [{"author": {"role": "user"}, "text": "n"}]}}, {"unknown": 1}]
    got = formatted(spark, [json.dumps(r) for r in records] + ["{broken", None])
    assert [r["layout"] for r in got] == ["prompt", "instruction", "instruction_input", "messages", "no_messages", "shared", "nested",
                                          None, None, None]
    turns = [[(t["role"], t["text"]) for t in r["turns"]] for r in got[:7]]
    assert turns == [
        [("user", "p"), ("assistant", "r")], [("system", "s"), ("user", "i"), ("assistant", "")],
        [("user", "i"), ("user", "5"), ("assistant", "o")], [("user", "a"), ("assistant", "b")], [],
        [("user", "h"), ("assistant", "g"), ("tool", "t")], [("user", "n")]]
    assert [[(t["role"], t["text"]) for t in r["back"]] for r in got[:7]] == turns
    assert [r["loss"] for r in got[:7]] == ["r", "", "o", "b", "", "g", ""]
    assert got[7]["turns"] is None and got[7]["formatted"] is None


def test_fingerprint_ignores_order_and_types_only(spark):
    records = ['{"a":1,"b":["x"]}', '{"b":[2.5],"a":null}', '{"a":1,"b":"x"}', '{"a":{"b":1}}', '{"a":1,"b":["x"],"c":1}']
    df = spark.createDataFrame([(r,) for r in records], "r string").select(chat.schema_fingerprint(F.parse_json("r")).alias("f"))
    marks = [r["f"] for r in df.collect()]
    assert marks[0] == marks[1] and len(set(marks)) == 4


def test_control_strings_survive(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "~", "~0", "<~1|", "~1|<|~2", "", "\n", "<|", "é😀<|im_start|>", "~~0<~~1|"]
    rows = [(1, i, ("assistant", "user", "a\n<|~2")[i % 3], t) for i, t in enumerate(texts)]
    rows += [(2, 1, None, None), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (None, 0, "user", "no id")]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = {r["conv_id"]: r for r in made.withColumns({
        "back": chat.read_back(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))}).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["back"]] == [(r[2], r[3]) for r in rows if r[0] == 1]
    assert got[1]["loss"] == "".join(t for i, t in enumerate(texts) if i % 3 == 0)
    assert got[1]["formatted"].count("<|im_start|>") == got[1]["formatted"].count("<|im_end|>") == len(texts)
    assert [(t["role"], t["text"]) for t in got[2]["back"]] == [("assistant", "tie"), ("assistant", "tie"), ("", "")]
    assert got[None]["back"][0]["text"] == "no id"
    for r in got.values():
        assert [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss_spans"]] == [
            t["text"].replace("~", "~0").replace("<|", "<~1|") for t in r["turns"] if t["role"] == "assistant"]


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string, record string, turns int")
    assert chat.format_conversations(empty).count() == 0
