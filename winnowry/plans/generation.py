"""Sample generation from files."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry import fixed_values as fv
from winnowry.config import ScanRules
from winnowry.functions import languages, repos, text
from winnowry.operators import generation as gen
from winnowry.plans import oracle as o
from winnowry.plans.registry import query, r6
from winnowry.sources import tables

_CHUNK = (f"CASE WHEN length(text) > {fv.CODE_CHUNK_CHARS} THEN left(text, {fv.CODE_CHUNK_CHARS}) || "
          f"{o.quote(fv.CODE_CHUNK_SUFFIX)} ELSE text END")
_STUB = "CASE " + " ".join(
    f"WHEN contains(lower(template), {o.quote(w)}) THEN {'text' if a is None else o.quote(a)}"
    for w, a in fv.STUB_RESPONSES) + f" ELSE {o.quote(fv.STUB_DEFAULT)} END"
_LANGUAGE = ("CASE WHEN ends_with(path, '.py') THEN 'python' WHEN "
             + " OR ".join(f"ends_with(path, '{s}')" for s in fv.CPP_SUFFIXES) + " THEN 'cpp' ELSE 'mixed' END")
_CROSSED = o.FILES + f""",
crossed AS (
  SELECT f.path, f.text, split_part(f.path, '/', 4) AS repo, t.tag, t.template, {_CHUNK} AS chunk, {_STUB} AS response
  FROM files f CROSS JOIN (VALUES {o.values(fv.PROMPT_TEMPLATES)}) t(tag, template)
  WHERE {o.strip("f.text")} <> ''
),
prompts AS (
  SELECT *, {o.quote(fv.SYSTEM_INSTRUCTIONS)} || chr(10) || chr(10) || 'FILE: ' || parse_filename(path) || chr(10)
    || 'REPO: ' || repo || chr(10) || chr(10) || 'INSTRUCTION:' || chr(10) || template || chr(10) || chr(10)
    || 'CODE:' || chr(10) || chunk AS prompt
  FROM crossed
)"""


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.generate_samples(tables.files_from_documents(spark, sf_dir))


@query("j1_generate_samples", f"""
WITH {_CROSSED}
SELECT path, tag AS instruction, md5(template) AS detail_md5, md5(response) AS response_md5, {_LANGUAGE} AS language,
       repo AS source_repo, CAST(length(left(text, {fv.CONTEXT_CHARS})) AS BIGINT) AS context_chars,
       round(least(1.0, CASE WHEN text <> '' THEN 0.3 ELSE 0.0 END + least(length(response) / 1000.0, 0.7)), 6) AS quality_score
FROM prompts""")
def generate_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).select(
        "path", "instruction", F.md5("instruction_detail").alias("detail_md5"), F.md5("response").alias("response_md5"),
        "language", "source_repo", F.length("context").cast("bigint").alias("context_chars"),
        r6("quality_score").alias("quality_score"))


@query("p4_language_of_path", f"WITH {o.FILES} SELECT path, {_LANGUAGE} AS language FROM files")
def language_of_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tables.files_from_documents(spark, sf_dir)
    return files.select("path", languages.language_of_path(F.col("path")).alias("language"))


@query("p8_generation_score", f"""
WITH {_CROSSED}
SELECT tag, CAST(count(*) AS BIGINT) AS samples,
       round(avg(least(1.0, 0.3 + least(length(response) / 1000.0, 0.7))), 6) AS avg_score
FROM crossed GROUP BY tag""")
def generation_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).groupBy(F.col("instruction").alias("tag")).agg(
        F.count("*").alias("samples"), r6(F.avg("quality_score")).alias("avg_score"))


@query("p9_code_chunk", f"""
WITH {o.FILES}
SELECT path, md5({_CHUNK}) AS chunk_md5, length(text) > {fv.CODE_CHUNK_CHARS} AS truncated FROM files""")
def code_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tables.files_from_documents(spark, sf_dir)
    return files.select("path", F.md5(text.code_chunk(F.col("text"))).alias("chunk_md5"),
                        (F.length("text") > fv.CODE_CHUNK_CHARS).alias("truncated"))


@query("p10_context_prefix", f"""
WITH {o.FILES} SELECT path, md5(left(text, {fv.CONTEXT_CHARS})) AS context_md5 FROM files""")
def context_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tables.files_from_documents(spark, sf_dir)
    return files.select("path", F.md5(text.context_prefix(F.col("text"))).alias("context_md5"))


@query("p11_render_prompt", f"WITH {_CROSSED} SELECT path, tag, md5(prompt) AS prompt_md5 FROM prompts")
def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).select(
        "path", F.col("instruction").alias("tag"), F.md5("prompt").alias("prompt_md5"))


@query("p12_repo_of_path", """
WITH p AS (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'data/ai-lab/repos/' || source || '/a.py' WHEN 1 THEN '/srv/repos/' || source
                      WHEN 2 THEN 'ai-lab/' || source || '/repos' ELSE 'ai-lab/repos/' || source || '/repos/x' END AS path,
         source FROM documents)
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source WHEN 3 THEN source ELSE 'unknown' END AS repo FROM p""")
def repo_of_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, source = F.col("doc_id") % 4, F.col("source")
    path = (
        F.when(kind == 0, F.concat(F.lit("data/ai-lab/repos/"), source, F.lit("/a.py")))
        .when(kind == 1, F.concat(F.lit("/srv/repos/"), source))
        .when(kind == 2, F.concat(F.lit("ai-lab/"), source, F.lit("/repos")))
        .otherwise(F.concat(F.lit("ai-lab/repos/"), source, F.lit("/repos/x")))
    )
    docs = tables.table(spark, sf_dir, "documents")
    return docs.select("doc_id", repos.repo_of_path(path).alias("repo"))


@query("p14_sample_keys", f"WITH {_CROSSED} SELECT path, tag, sha1(path || tag) AS sample_key FROM crossed")
def sample_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).select("path", F.col("instruction").alias("tag"), "sample_key")


@query("p16_token_estimate", f"""
WITH {_CROSSED}
SELECT path, tag, CAST(length(prompt) // 4 + length(chunk) // 4 AS BIGINT) AS tokens,
       CAST(length(prompt || chr(10) || chr(10) || chunk) // 4 AS BIGINT) AS joined_tokens
FROM prompts""")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("text")
    rows = gen.cross_templates(gen.source_files(tables.files_from_documents(spark, sf_dir)))
    prompt = gen.render_prompt(F.col("template"), F.col("path"), F.col("repo"), code)
    chunk = text.code_chunk(code)
    return rows.select(
        "path", "tag", text.token_estimate(prompt, chunk).alias("tokens"),
        text.token_estimate(F.concat(prompt, F.lit("\n\n"), chunk)).alias("joined_tokens"))


@query("p42_stub_responder", f"""
WITH {_CROSSED}
SELECT tag, CAST(count(*) AS BIGINT) AS samples, count(DISTINCT response) > 1 AS echoes_code,
       CAST(sum(length(response)) AS BIGINT) AS chars
FROM crossed GROUP BY tag""")
def stub_responder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).groupBy(F.col("instruction").alias("tag")).agg(
        F.count("*").alias("samples"), (F.min("response") != F.max("response")).alias("echoes_code"),
        F.sum(F.length("response")).alias("chars"))


_EXTENSION = "lower(regexp_extract(path, '[^/.][^/]*(\\.[^./]*)$', 1))"


@query("f1_f2_source_filter", f"""
WITH {o.FILES}
SELECT path, {_EXTENSION} AS extension FROM files
WHERE {_EXTENSION} IN ({", ".join(o.quote(e) for e in fv.INCLUDE_EXTENSIONS)})
  AND NOT list_has_any(string_split(path, '/')[5:-2], [{", ".join(o.quote(d) for d in fv.IGNORED_DIRECTORIES)}])""")
def source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tables.files_from_documents(spark, sf_dir)
    path = F.col("path")
    root = F.concat(F.lit("data/ai-lab/repos/"), repos.repo_of_path(path), F.lit("/"))
    return files.filter(languages.extension_in(path) & languages.outside_ignored(path, root)).select(
        "path", languages.file_extension(path).alias("extension"))


@query("f3_nonblank_files", f"""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN chr(9) || ' ' || chr(10) ELSE text END AS text FROM documents)
SELECT doc_id FROM t WHERE {o.strip("text")} <> ''""")
def nonblank_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = F.when(F.col("doc_id") % 5 == 0, F.lit("\t \n")).otherwise(F.col("text"))
    docs = tables.table(spark, sf_dir, "documents").withColumn("text", blanked)
    return docs.filter(~text.is_blank(F.col("text"))).select("doc_id")


@query("x4_custom_scan_rules", f"""
WITH {o.FILES}
SELECT path FROM files WHERE {_EXTENSION} IN ('.md', '.rs')
  AND NOT list_has_any(string_split(path, '/')[5:-2], ['vendor'])""")
def custom_scan_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = ScanRules(extensions=(".md", ".RS"), ignored_directories=("vendor",))
    path = F.col("path")
    root = F.concat(F.lit("data/ai-lab/repos/"), repos.repo_of_path(path), F.lit("/"))
    return tables.files_from_documents(spark, sf_dir).filter(
        languages.extension_in(path, rules.extensions)
        & languages.outside_ignored(path, root, rules.ignored_directories)).select("path")


@query("a15_samples_per_file", f"WITH {_CROSSED} SELECT path, count(*) AS samples FROM crossed GROUP BY path")
def samples_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.samples_per_file(generated(spark, sf_dir))


# Responders see whole prompts and files: as Arrow arrays a batch of them takes its 64 MB once, not again as Python strings.
def _chars(texts: pa.Array) -> pd.Series:
    return pc.utf8_length(texts).to_pandas()


@F.arrow_udf(T.StringType())
def _measure(prompt: pa.Array, code: pa.Array) -> pa.Array:
    return pa.array("prompt " + _chars(prompt).astype(str) + ", code " + _chars(code).astype(str), pa.string())


@F.arrow_udf(T.StringType())
def _even_only(code: pa.Array) -> pa.Array:
    return pa.array([None if pd.isna(n) or n % 2 else f"primary {int(n)}" for n in _chars(code)], pa.string())


@query("x1_custom_responder", f"""
WITH {_CROSSED}
SELECT path, tag, 'prompt ' || length(prompt) || ', code ' || length(text) AS response FROM prompts""")
def custom_responder(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = gen.generate_samples(tables.files_from_documents(spark, sf_dir), responder=_measure)
    return samples.select("path", F.col("instruction").alias("tag"), "response")


@query("x2_fallback_responder", f"""
WITH {_CROSSED}
SELECT path, tag, CASE WHEN length(text) % 2 = 0 THEN 'primary ' || length(text)
                       WHEN length(text) % 3 <> 0 THEN 'fallback' ELSE '' END AS response FROM prompts""")
def fallback_responder(spark: SparkSession, sf_dir: str) -> DataFrame:
    def primary(prompt: Column, code: Column) -> Column:
        return _even_only(code)

    def fallback(prompt: Column, code: Column) -> Column:
        return F.when(F.length(code) % 3 != 0, F.lit("fallback"))

    samples = gen.generate_samples(
        tables.files_from_documents(spark, sf_dir), responder=gen.first_answer(primary, fallback))
    return samples.select("path", F.col("instruction").alias("tag"), "response")
