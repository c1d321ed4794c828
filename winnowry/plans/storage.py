"""Sources and sinks, exercised as round trips of table-derived rows through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.config import ScanRules
from winnowry.operators import cleaning, evaluating, generation
from winnowry.plans import oracle as o
from winnowry.plans.curation import cleaned
from winnowry.plans.registry import query, r6
from winnowry.session import scratch
from winnowry.sources import readers, tables, writers


@query("s1_u1_jsonl_scan", f"""
WITH {o.SAMPLES} SELECT context, md5(instruction) AS instruction_md5, md5(response) AS response_md5,
  base AS quality_score, CAST(pos AS VARCHAR) AS source_repo FROM samples
UNION ALL SELECT context, md5(instruction), md5(response), -1.0, 'odd-' || pos FROM samples WHERE pos % 10 = 0""")
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample once, with broken and blank lines between them, in two folders; every tenth again with a repeated key and NaN."""
    samples = tables.samples_from_documents(spark, sf_dir)
    number = F.col("pos").cast("string")
    good = F.to_json(F.struct("instruction", "context", "response", "quality_score", number.alias("source_repo")))
    broken = F.concat(F.lit('{"instruction": "'), F.col("context"))
    told = F.to_json(F.struct("instruction", "context", "response"))
    odd = F.when(F.col("pos") % 10 == 0, F.concat(
        F.lit('{"context": "first", '), F.substr(told, F.lit(2), F.length(told) - 2), F.lit(', "quality_score": NaN, "source_repo": "odd-'), number, F.lit('"}')))
    lines = samples.select((F.col("pos") % 2).alias("half"), F.explode(F.array(good, broken, F.lit(""), F.coalesce(odd, F.lit("[1]")))).alias("value"))
    root = scratch(spark, "jsonl")
    lines.write.partitionBy("half").text(root)
    rows = readers.read_jsonl(spark, f"{root}/half=0").unionByName(readers.read_jsonl(spark, f"{root}/half=1"))
    return rows.select("context", F.md5("instruction").alias("instruction_md5"), F.md5("response").alias("response_md5"),
                       F.nanvl("quality_score", F.lit(-1.0)).alias("quality_score"), "source_repo")


ARRAYS = 16


@query("s2_json_array_count", f"""
SELECT doc_id % {ARRAYS} AS file, count(*) AS rows FROM documents GROUP BY 1""")
def json_array_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in sixteen JSON arrays, however large, each read by as many tasks as it has ranges."""
    number = F.col("doc_id") % ARRAYS
    name = F.concat(F.lit("array-"), number.cast("string"), F.lit(".json"))
    one = F.to_json(F.struct("doc_id", "text", F.array("source", F.lit('],"\\')).alias("odd")))
    docs = tables.table(spark, sf_dir, "documents")
    rows = docs.select(name.alias("file"), F.col("doc_id").alias("at"), F.concat(one, F.lit(",")).alias("line"))
    ends = docs.groupBy(name.alias("file")).agg(F.lit(None).cast("bigint").alias("first"), (F.max("doc_id") + 1).alias("last"))
    edges = ends.select("file", F.explode(F.array(
        F.struct(F.col("first").alias("at"), F.lit(" [").alias("line")), F.struct(F.col("last").alias("at"), F.lit("{}\n]").alias("line")))).alias("e"))
    root = scratch(spark, "arrays")
    writers.write_log_files(rows.unionByName(edges.select("file", "e.at", "e.line")), root).write.format("noop").mode("overwrite").save()
    counted = readers.json_array_counts(spark, root, 1 << 20)
    return counted.select(F.regexp_extract("file_path", r"array-(\d+)", 1).cast("bigint").alias("file"), (F.col("rows") - 1).alias("rows"))


@query("s3_keyed_json_scan", f"""
WITH {o.CHECKS}
SELECT CAST(round AS VARCHAR) AS round, category, count(*) AS total, count(*) FILTER (WHERE passed) AS passed
FROM checks GROUP BY round, category""")
def keyed_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tables.eval_checks(spark, sf_dir).groupBy("round", "category").agg(
        F.count("*").alias("total"), F.count_if("passed").alias("passed"))
    root = scratch(spark, "rounds")
    counts.write.partitionBy("round", "category").json(root)
    docs = readers.read_keyed_json(spark, root, "total bigint, passed bigint", r"round=(\d+)", "round")
    category = F.regexp_extract("_metadata.file_path", r"category=(\w+)", 1)
    return docs.select("round", category.alias("category"), "total", "passed")


@query("s4_source_tree_scan", """
SELECT source AS repo, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents WHERE doc_id % 7 <> 0 GROUP BY source""")
def source_tree_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a tree of text files; those below an ignored folder are not listed."""
    folder = F.when(F.col("doc_id") % 7 == 0, F.lit("tests")).otherwise(F.lit("src"))
    docs = tables.table(spark, sf_dir, "documents").select("source", folder.alias("folder"), "text")
    root = scratch(spark, "tree")
    docs.write.partitionBy("source", "folder").text(root)
    rules = ScanRules(extensions=(".txt",), ignored_directories=("folder=tests",))
    files = readers.list_source_files(spark, root, rules)
    return files.groupBy(F.regexp_extract("path", r"source=([^/]+)", 1).alias("repo")).agg(F.sum("length").alias("bytes"))


@query("s4_source_text", """
SELECT source AS repo, CAST(sum(length(text) + 1) AS BIGINT) AS chars,
  CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines
FROM documents WHERE doc_id % 7 <> 0 GROUP BY source""")
def source_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the wanted files of such a tree, measured by repository."""
    folder = F.when(F.col("doc_id") % 7 == 0, F.lit("tests")).otherwise(F.lit("src"))
    root = scratch(spark, "tree")
    tables.table(spark, sf_dir, "documents").select("source", folder.alias("folder"), "text").write.partitionBy("source", "folder").text(root)
    rules = ScanRules(extensions=(".TXT",), ignored_directories=("folder=tests",))
    files = readers.read_source_files(spark, root, rules)
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return files.groupBy(F.regexp_extract("path", r"source=([^/]+)", 1).alias("repo")).agg(
        F.sum(F.length("text")).cast("bigint").alias("chars"), F.sum(newlines).cast("bigint").alias("lines"))


@query("s5_line_list_scan", "SELECT url AS value FROM pages")
def line_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages")
    lines = pages.select(F.explode(F.array(
        F.concat(F.lit("  "), F.col("url"), F.lit("\t")), F.concat(F.lit(" # "), F.col("url")), F.lit("   "))).alias("value"))
    root = scratch(spark, "lines")
    lines.write.text(root)
    return readers.read_lines(spark, root, comments=True)


@query("s6_key_value_scan", """
SELECT p_brand AS key, arg_max(p_name || '=' || p_partkey, p_partkey) AS value FROM part GROUP BY p_brand""")
def key_value_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.table(spark, sf_dir, "part").orderBy("p_partkey")
    pair = F.concat(F.lit(" "), F.col("p_brand"), F.lit(" = "), F.col("p_name"), F.lit("="), F.col("p_partkey").cast("string"))
    lines = part.select(F.explode(F.array(pair, F.concat(F.lit("#"), pair), F.lit("no separator"), F.lit(""))).alias("value"))
    root = scratch(spark, "env")
    lines.write.text(root)
    return readers.read_key_values(spark, root)


@query("s7_text_sample_scan", "SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY text")
def text_sample_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "text")
    tables.table(spark, sf_dir, "documents").select("text").write.json(root)
    return readers.read_text_samples(spark, root).groupBy(F.md5("text").alias("text_md5")).agg(F.count("*").alias("n"))


@query("s8_token_log", """
SELECT CAST(l_orderkey AS BIGINT) AS ts, CAST(sum(t) AS BIGINT) AS tokens, count(*) AS entries
FROM (SELECT l_orderkey, CAST(trunc(l_quantity) AS BIGINT) - 10 AS t FROM lineitem) WHERE t > 0 GROUP BY l_orderkey""")
def token_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ts"), (F.col("l_quantity").cast("bigint") - 10).alias("tokens"), "l_returnflag")
    root = scratch(spark, "tokens")
    writers.append_tokens(log.filter("l_returnflag = 'A'"), root)
    writers.append_tokens(log.filter("l_returnflag <> 'A'"), root)
    return readers.read_token_log(spark, root).groupBy("ts").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("entries"))


@query("s9_sample_sink", f"""
WITH {o.FILES}, k AS (SELECT sha1(path || t.tag) AS sample_key, t.tag AS instruction, text
  FROM files CROSS JOIN (VALUES {o.values(fv.PROMPT_TEMPLATES)}) t(tag, template) WHERE {o.strip("text")} <> '')
SELECT sample_key, instruction, CAST(length(left(text, 8192)) AS BIGINT) AS context_chars FROM k""")
def sample_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "raw")
    writers.append_samples(generation.generate_samples(tables.files_from_documents(spark, sf_dir)), root)
    rows = readers.read_jsonl(spark, root, f"sample_key string, {readers.SAMPLE_SCHEMA}")
    return rows.select("sample_key", "instruction", F.length("context").cast("bigint").alias("context_chars"))


@query("s10_dataset_sink", f"""
WITH {o.JUDGED}, {o.balanced(1000)}
SELECT 'train' AS part, count(*) AS rows, round(sum(quality) / count(*), 6) AS avg_quality FROM balanced
UNION ALL SELECT 'stats', count(*), round(sum(quality) / count(*), 6) FROM balanced""")
def dataset_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "dataset")
    samples = cleaned(spark, sf_dir)
    samples.write.mode("overwrite").parquet(f"{root}/balanced")
    stored = spark.read.parquet(f"{root}/balanced")
    writers.write_dataset(cleaning.sort_by_quality(stored, ["pos"]), cleaning.cleaning_stats(stored), root)
    stats = spark.read.schema("total_samples bigint, avg_quality_score double").json(f"{root}/stats")
    train = spark.read.parquet(f"{root}/train").agg(F.count("*").alias("rows"), r6(F.avg("quality_score")).alias("avg_quality"))
    return train.select(F.lit("train").alias("part"), "rows", "avg_quality").unionByName(stats.select(
        F.lit("stats").alias("part"), F.col("total_samples").alias("rows"), r6("avg_quality_score").alias("avg_quality")))


@query("s11_repo_sink", f"""
WITH {o.REPOS} SELECT 'urls' AS part, url, '' AS name FROM repos UNION ALL SELECT 'details', url, name FROM repos""")
def repo_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "repos")
    writers.write_repos(tables.repos_from_part(spark, sf_dir), root)
    urls = readers.read_lines(spark, f"{root}/urls", comments=True)
    details = spark.read.schema("url string, name string").json(f"{root}/details")
    return urls.select(F.lit("urls").alias("part"), F.col("value").alias("url"), F.lit("").alias("name")).unionByName(
        details.select(F.lit("details").alias("part"), "url", "name"))


@query("s12_eval_result_sink", f"""
WITH {o.CHECKS}
SELECT round, count(*) AS total, CASE WHEN round > 20 THEN 'rerun' ELSE 'first' END AS status FROM checks GROUP BY round""")
def eval_result_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rounds, then a rerun of the late ones that must replace exactly those."""
    totals = tables.eval_checks(spark, sf_dir).groupBy("round").agg(F.count("*").alias("total"))
    root = scratch(spark, "results")
    writers.write_eval_results(totals.withColumn("status", F.lit("first")), root)
    writers.write_eval_results(totals.filter("round > 20").withColumn("status", F.lit("rerun")), root)
    rows = spark.read.schema("total bigint, status string, round bigint").parquet(root)
    return rows.select("round", "total", "status")


@query("s15_file_list_sink", f"WITH {o.FILES} SELECT path AS value FROM files")
def file_list_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "filelist")
    writers.write_file_list(tables.files_from_documents(spark, sf_dir), root)
    return readers.read_lines(spark, root)
