"""Scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry.config import ScanRules
from winnowry.functions import json_text, languages, text
from winnowry.sources import json_ranges

SAMPLE_SCHEMA = (
    "instruction string, instruction_detail string, prompt string, context string, response string, "
    "language string, source_repo string, quality_score double"
)
EVENT_SCHEMA = (
    "event_version string, ts string, run_id string, round int, stage string, level string, event_type string, "
    "message string, counters_delta map<string,double>, usage_delta map<string,double>, "
    "artifact_paths array<string>, error string"
)
TOKEN_SCHEMA = "ts bigint, tokens bigint"
CORRUPT = "_corrupt_record"


def line_position() -> list[Column]:
    """File, split start and a number rising within the split: sorts lines in file order."""
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n")).alias("pos"),
    ]


def read_jsonl(spark: SparkSession, path: str, schema: str = SAMPLE_SCHEMA) -> DataFrame:
    """JSON Lines with blank and broken lines and lines that are no object skipped, plus (file_path, pos).

    Every decodable object stays, also with repeated keys (the last counts), NaN or Infinity: what the
    native parser refuses is decoded a second time, in a pass of its own: no other row waits for Python.
    A text field that holds no string is null, so that the format rule rejects the row; other fields are
    cast, or null where that fails.
    """
    fields = T.StructType.fromDDL(schema)

    def parsed(f: T.StructField) -> Column:
        value = F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString())
        if isinstance(f.dataType, T.StringType):
            value = F.when(F.schema_of_variant(F.try_variant_get("_v", f"$.{f.name}", "variant")) == "STRING", value)
        return value.alias(f.name)

    def decoded(f: T.StructField) -> Column:
        value = F.col("_d")[f.name]
        if not isinstance(f.dataType, T.StringType):
            value = value.try_cast(f.dataType) if isinstance(f.dataType, T.AtomicType) else F.from_json(value, f.dataType)
        return value.alias(f.name)

    rows = spark.read.text(path).select("value", F.try_parse_json("value").alias("_v"), *line_position())
    objects = rows.filter(F.schema_of_variant("_v").startswith("OBJECT")).select(*map(parsed, fields), "file_path", "pos")
    refused = rows.filter(F.col("_v").isNull() & F.startswith(F.ltrim("value"), F.lit("{")))
    found = F.array_compact(F.array(json_text.object_fields(F.col("value"), fields)))
    second = refused.select(F.explode(found).alias("_d"), "file_path", "pos")
    return objects.unionByName(second.select(*map(decoded, fields), "file_path", "pos"))


def json_array_counts(spark: SparkSession, path: str, range_bytes: int = 32 << 20) -> DataFrame:
    """(file_path, rows) of JSON array files of any size; 0 for a document that is broken or no array."""
    return json_ranges.array_counts(spark, path, range_bytes=range_bytes).withColumnRenamed("file", "file_path")


def count_json_array(spark: SparkSession, path: str) -> int:
    """Rows of one JSON array file; 0 when it is missing, unreadable or no array."""
    return json_array_counts(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def read_json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Elements of JSON array files, each file one document, plus ``file_path``."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select("*", F.col("_metadata.file_path").alias("file_path"))


def read_keyed_json(spark: SparkSession, path: str, schema: str, key_pattern: str, key: str = "key") -> DataFrame:
    """Small JSON documents; ``key`` is what ``key_pattern`` captures in each file's path."""
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return rows.select("*", F.regexp_extract("_metadata.file_path", key_pattern, 1).alias(key))


def _wanted_files(spark: SparkSession, root: str, rules: ScanRules) -> DataFrame:
    """Binary-file scan below ``root`` with ``path`` rewritten to start with ``root`` as given.

    Files of other suffixes are left out when files are listed, and files below ignored folders by their
    listed paths, so their content is never read.
    """
    base = root.rstrip("/") + "/"
    either = lambda c: f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() else c
    suffixes = ",".join("".join(map(either, e)) for e in rules.extensions)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.option("pathGlobFilter", f"*{{{suffixes}}}").load(root)
    below = F.regexp_replace("path", rf"^.*?\Q{base}\E", "")
    named = files.withColumn("path", F.concat(F.lit(base), below))
    # Listed paths are URL-encoded; only names and roots that encoding leaves as they are can be told there already.
    plain = tuple(d for d in rules.ignored_directories if "%" not in d + base)
    listed = F.col("_metadata.file_path")
    outside = languages.outside_ignored(F.regexp_replace(listed, rf"^.*?\Q{base}\E", base), F.lit(base), plain) if plain else F.lit(True)
    return named.filter(~F.contains(listed, F.lit(base)) | outside).filter(
        languages.extension_in(F.col("path"), rules.extensions)
        & languages.outside_ignored(F.col("path"), F.lit(base), rules.ignored_directories)
    )


def list_source_files(spark: SparkSession, root: str, rules: ScanRules = ScanRules()) -> DataFrame:
    """(path, length, modificationTime) of wanted files below ``root``; no content is read."""
    return _wanted_files(spark, root, rules).select("path", "length", "modificationTime")


def read_source_files(spark: SparkSession, root: str, rules: ScanRules = ScanRules()) -> DataFrame:
    """(path, text) of wanted files; undecodable bytes are dropped, blank files left out."""
    decoded = F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("\ufffd"), F.lit(""))
    files = _wanted_files(spark, root, rules).select("path", decoded.alias("text"))
    return files.filter(~text.is_blank(F.col("text")))


def read_lines(spark: SparkSession, path: str, comments: bool = False) -> DataFrame:
    """Trimmed non-blank lines; ``comments`` also drops lines starting with ``#``."""
    value = text.strip(F.col("value")).alias("value")
    lines = spark.read.text(path).select(value).filter(F.col("value") != "")
    return lines.filter(~F.startswith("value", F.lit("#"))) if comments else lines


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """KEY=VALUE lines; the first ``=`` splits, both sides are trimmed, the last line of a key wins."""
    lines = spark.read.text(path).select(text.strip(F.col("value")).alias("line"), *line_position())
    useful = lines.filter(~F.startswith("line", F.lit("#")) & F.contains("line", F.lit("=")))
    parts = F.split("line", "=", 2)
    pairs = useful.select(text.strip(parts[0]).alias("key"), text.strip(parts[1]).alias("value"), "file_path", "pos")
    return pairs.groupBy("key").agg(F.max_by("value", F.struct("file_path", "pos")).alias("value"))


def read_text_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("text string").json(path)


def read_token_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOKEN_SCHEMA).csv(path)
