"""The given tables, and the shapes the operators work on derived from them.

Every adapter is a projection or an equi-join; ``pos`` is the explicit input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CALL_MODELS = ("github-copilot/gpt-5.3-codex", "xai/grok-4-1-fast", "gpt-4o", "unlisted-model")
NAMED_MODELS = ("azure/gpt-4o-mini", "xAI/Grok-4-1-Fast-beta", "github-copilot/GPT-5.3-Codex", "XAI/grok-4.1.fast")
FILE_SUFFIXES = (".py", ".CPP", ".h", ".rs", ".md")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple, index: Column) -> Column:
    """values[index] of a fixed list."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def samples_from_documents(spark: SparkSession, sf_dir: str, scored: bool = True) -> DataFrame:
    """Documents as samples, asked for by their first line; without ``scored`` no label is joined and the base score is 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    if not scored:
        docs = docs.withColumn("quality", F.lit(None).cast("int"))
    else:
        docs = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return docs.select(
        F.col("doc_id").alias("pos"),
        F.substring_index("text", "\n", 1).alias("instruction"),
        F.col("source").alias("context"),
        F.col("text").alias("response"),
        F.coalesce(F.col("quality").cast("double"), F.lit(0.0)).alias("quality_score"),
    )


def samples_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn followed by an assistant turn; context is the conversation's system text."""
    turns = table(spark, sf_dir, "conversations")
    system = turns.filter("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("system"))
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    answers = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return asked.join(answers, ["conv_id", "turn"]).join(system, "conv_id", "left").select(
        "conv_id", "turn", "instruction", "response", F.coalesce("system", F.lit("")).alias("context"))


def files_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as source files: some below a tests folder, five suffixes."""
    doc = F.col("doc_id")
    folder = F.when(doc % 7 == 0, F.lit("/tests")).otherwise(F.lit(""))
    path = F.concat(F.lit("data/ai-lab/repos/"), F.col("source"), folder, F.lit("/f"), doc.cast("string"),
                    pick(FILE_SUFFIXES, doc % 5))
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")


def repos_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("repo_id"),
        F.concat(F.col("p_name"), F.col("p_partkey").cast("string")).alias("name"),
        F.concat(F.lit("https://example.org/"), F.replace("p_name", F.lit(" "), F.lit("/")), F.lit("-"),
                 F.col("p_partkey").cast("string"), F.lit(".git")).alias("url"),
        F.col("p_brand").alias("language"),
        F.col("p_size").cast("bigint").alias("stars"),
        F.col("p_retailprice").cast("bigint").alias("forks"),
    )


def api_calls_from_lineitem(spark: SparkSession, sf_dir: str, models: tuple = CALL_MODELS) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("provider"),
        pick(models, F.col("l_linenumber") % 4).alias("model"),
        (F.col("l_quantity").cast("bigint") * 100).alias("prompt_tokens"),
        F.col("l_extendedprice").cast("bigint").alias("completion_tokens"),
        (F.col("l_discount") < 0.08).alias("success"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as telemetry: one run per user, counter and usage deltas from ``props.k``."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("bigint")
    number = k.cast("double")
    delta = F.when(kind == "view", F.create_map(kind, number, F.lit("train_loss"), F.col("value"))).otherwise(
        F.create_map(kind, number))
    usage = F.create_map(
        F.lit("requests_sent"), F.lit(1.0), F.lit("input_tokens"), number * 10, F.lit("output_tokens"), number)
    level = (
        F.when(kind == "error", F.lit("error")).when(kind == "purchase", F.lit("success"))
        .when(kind == "signup", F.lit("warn")).otherwise(F.lit("info"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"), F.col("user_id").alias("run_id"), "ts", level.alias("level"),
        kind.alias("stage"), kind.alias("event_type"), F.concat(kind, F.lit(" "), F.col("props")).alias("message"),
        delta.alias("counters_delta"), usage.alias("usage_delta"),
        F.when(k % 5 != 4, pick(CALL_MODELS, k % 5)).alias("model"), k.alias("k"), "value",
    )


def sequence_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence numbers that mostly rise, repeat, fall a little and sometimes restart."""
    pos = F.col("event_id")
    seq = (F.floor(pos / 150) * 3 + F.get_json_object("props", "$.k").cast("bigint") % 5) % 40
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), pos.alias("pos"), seq.alias("seq"), "ts")


def eval_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as evaluation outcomes: the day is the round."""
    category = F.when(F.col("event_type") == "click", F.lit("python")).when(
        F.col("event_type") == "view", F.lit("cpp")).otherwise(F.lit("instruction"))
    return table(spark, sf_dir, "events").select(
        F.day("ts").cast("bigint").alias("round"), category.alias("category"),
        (F.col("value") >= 50).alias("passed"))


def eval_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split("text", "[ \n]+"), lambda w: w != "")
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("task_id"), F.get(words, F.lit(0)).alias("expected"),
        F.slice(words, 1, 4).alias("keywords"),
        F.struct(F.lit(20).alias("min"), F.lit(2000).alias("max")).alias("expected_length"))


def eval_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document answers the task its id falls on, going round all benchmark items."""
    tasks = table(spark, sf_dir, "benchmark").agg(F.count("*")).scalar()
    return table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % tasks).alias("task_id"), F.col("doc_id").alias("pos"), F.col("text").alias("response"))


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event in the shapes a training loop prints; one log per user."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind, pos = F.col("event_type"), F.col("event_id")
    step, total = (pos % 500).cast("string"), F.when(k % 2 == 0, F.lit("500")).otherwise(F.lit("2000"))
    hundredths = F.concat(F.lit("0."), F.lpad(k.cast("string"), 2, "0"))
    line = (
        F.when(kind == "click", F.concat(F.lit(" 10%|#         | "), step, F.lit("/"), total,
                                         F.lit(" [04:21<35:18,  "), hundredths, F.lit("s/it]")))
        .when(kind == "view", F.concat(F.lit("{'loss': '"), hundredths, F.lit("', 'learning_rate': '2e-0"),
                                       (k % 9 + 1).cast("string"), F.lit("'}")))
        .when(kind == "purchase", F.concat(F.lit("INFO Round "), (k % 10).cast("string"), F.lit("/10 Step "), step,
                                           F.lit("/"), total))
        .when(kind == "error", F.concat(F.lit("ERROR worker failed with code "), k.cast("string")))
        .otherwise(F.concat(F.lit("warning: trainable params: 1,"), F.lpad(k.cast("string"), 3, "0"),
                            F.lit(",000 || all params: 7,"), F.lpad(k.cast("string"), 3, "0"), F.lit(",000")))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source"), pos.alias("pos"), line.alias("line"))


def generation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event in the shapes sample generation prints."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind, n = F.col("event_type"), k.cast("string")
    line = (
        F.when((kind == "click") & (k % 2 == 0), F.concat(F.lit("prompt tokens: 1,"), F.lpad(n, 3, "0")))
        .when(kind == "click", F.concat(F.lit("completion tokens: "), n))
        .when(kind == "view", F.concat(F.lit("Generated: "), n, F.lit(" samples")))
        .when(kind == "purchase", F.concat(F.lit("API requests: "), n, F.lit(" requests so far")))
        .when(kind == "error", F.lit("Stage: generate"))
        .otherwise(F.concat(F.lit("prompt and completion, total tokens: 2,"), F.lpad(n, 3, "0")))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source"), F.col("event_id").alias("pos"), line.alias("line"))


def parallel_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event in the shapes a parallel generation run prints."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind, n = F.col("event_type"), k.cast("string")
    line = (
        F.when(kind == "click", F.concat(F.lit("Generating:  10%|# | "), n, F.lit("/100 [00:10<01:00, samples="),
                                         (k * 9).cast("string"), F.lit(" file=a.py]")))
        .when(kind == "view", F.concat(F.lit("\tProcessing "), n, F.lit(" files with 2 workers...\x0b")))
        .when(kind == "purchase", F.concat(F.lit("INFO Generated "), (k * 3).cast("string"), F.lit(" samples from "),
                                           n, F.lit(" files")))
        .when(kind == "error", F.lit("Searching with query: devops"))
        .otherwise(F.lit("Cloning https://example.org/a/b"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source"), F.col("event_id").alias("pos"), line.alias("line"))
