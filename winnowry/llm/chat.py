"""Chat records of any known layout as templated text, told apart by the fingerprint of their fields.

A record is JSON.  Its schema fingerprint is a hash of its nested field names without types; it selects
a declarative mapping (which fields are turns, of which role) that yields canonical turns.  Turns are
rendered with control strings around them; the same strings inside a text are escaped reversibly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import let

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"
SCALARS = "(?:STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\\([0-9,]+\\)|DATE|TIMESTAMP(?:_NTZ)?|BINARY)"


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns: fields of fixed roles, or one list with a role and a text field."""

    name: str
    example: str
    fields: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role_field: str = ""
    text_field: str = ""
    role_names: tuple[tuple[str, str], ...] = ()


MAPPINGS = (
    Mapping("prompt", '{"prompt":"","response":""}', (("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", '{"system":"","instruction":"","output":""}',
            (("system", "system"), ("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", '{"instruction":"","input":"","output":""}',
            (("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("messages", '{"messages":[{"role":"","content":""}]}', (), "messages", "role", "content"),
    Mapping("no_messages", '{"messages":[]}', (), "messages", "role", "content"),
    Mapping("shared", '{"conversations":[{"from":"","value":""}]}', (), "conversations", "from", "value",
            (("human", "user"), ("gpt", "assistant"))),
    Mapping("nested", '{"chat":{"turns":[{"author":{"role":""},"text":""}]}}', (), "chat.turns", "author.role", "text"),
)


def schema_fingerprint(record: Column) -> Column:
    """Hash of a variant's nested field names; the types of plain values do not count.  Null for null."""
    return F.sha2(F.regexp_replace(F.schema_of_variant(record), f"\\b{SCALARS}(?=[,>]|$)", "_"), 256)


def turns_by(mapping: Mapping, record: Column) -> Column:
    """The record's turns under one mapping; missing and null texts are empty."""
    def field(v: Column, path: str) -> Column:
        return F.coalesce(F.try_variant_get(v, f"$.{path}", "string"), F.lit(""))

    if mapping.fields:
        return F.array(*[F.struct(F.lit(role).alias("role"), field(record, path).alias("text"))
                         for role, path in mapping.fields])
    def one(item: Column) -> Column:
        role = field(item, mapping.role_field)
        named = role
        for theirs, ours in mapping.role_names:
            named = F.when(role == theirs, F.lit(ours)).otherwise(named)
        return F.struct(named.alias("role"), field(item, mapping.text_field).alias("text"))
    return F.transform(F.try_variant_get(record, f"$.{mapping.items}", "array<variant>"), one)


def canonical_turns(records: DataFrame, json: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds ``layout`` and ``turns``; broken JSON and unknown layouts have null in both and stay."""
    parsed = records.withColumn("_record", F.try_parse_json(json))
    parsed = parsed.withColumn("_schema", schema_fingerprint(F.col("_record")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        same = F.col("_schema") == schema_fingerprint(F.parse_json(F.lit(m.example)))
        layout = F.when(same, F.lit(m.name)).otherwise(layout)
        turns = F.when(same, turns_by(m, F.col("_record")).cast(TURNS)).otherwise(turns)
    return parsed.withColumns({"layout": layout, "turns": turns}).drop("_record", "_schema")


def escaped(text: Column) -> Column:
    """Control strings cannot occur in the result: ~ becomes ~0, then <| becomes <~1|."""
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("<~1|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<~1|"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def escaped_role(role: Column) -> Column:
    """Roles stand on the first line of a turn, so their line ends are escaped too."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("~2"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("~2"), F.lit("\n")))


def formatted(rows: DataFrame) -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` (start, length in code points of each assistant text)."""
    drawn = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"),
        F.concat(escaped(t["text"])).alias("body"), (t["role"] == "assistant").alias("learn")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        start, size = acc["at"] + F.length(p["head"]), F.length(p["body"])
        span = F.struct(start.alias("start"), size.alias("length"))
        return F.struct((start + size + len(END) + 1).alias("at"),
                        F.when(p["learn"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    parts = rows.withColumn("_parts", drawn)
    return parts.withColumns({
        "formatted": F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(f"{END}\n"))), ""),
        "loss_spans": F.aggregate("_parts", zero, step, lambda acc: acc["spans"]),
    }).drop("_parts")


def read_back(text: Column) -> Column:
    """The turns of a formatted text."""
    def turn(part: Column) -> Column:
        return let(F.substring_index(part, "\n", 1), lambda role: F.struct(
            unescaped_role(role).alias("role"),
            unescaped(F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - 2 - len(END))).alias("text")))
    parts = F.split(text, START.replace("|", "\\|"))
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))), "")


def records_from_turns(turns: DataFrame) -> DataFrame:
    """conv_id and one JSON record per conversation, in the layout that suits its roles.

    Rows go by turn, then role and text.  A question with its answer is a prompt record, a system text
    before it makes an instruction record, all others are lists, written in two ways.  Null texts and
    roles are empty.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    roles = F.array_join(F.transform("rows", lambda r: r["role"]), "\n")
    text = lambda i: F.get("rows", F.lit(i))["text"]
    prompt = F.struct(text(0).alias("prompt"), text(1).alias("response"))
    instruction = F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))
    shared = F.struct(F.transform("rows", lambda r: F.struct(
        F.when(r["role"] == "user", F.lit("human")).when(r["role"] == "assistant", F.lit("gpt")).otherwise(r["role"])
        .alias("from"), r["text"].alias("value"))).alias("conversations"))
    messages = F.struct(F.transform("rows", lambda r: F.struct(r["role"], r["text"].alias("content"))).alias("messages"))
    shareable = ~F.exists("rows", lambda r: r["role"].isin("human", "gpt"))
    record = (
        F.when(roles == "user\nassistant", F.to_json(prompt))
        .when(roles == "system\nuser\nassistant", F.to_json(instruction))
        .when(shareable & (F.size("rows") % 2 == 1), F.to_json(shared)).otherwise(F.to_json(messages)))
    return grouped.select("conv_id", record.alias("record"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, layout, turns, formatted, loss_spans of every conversation."""
    return formatted(canonical_turns(records_from_turns(turns)).drop("record"))
