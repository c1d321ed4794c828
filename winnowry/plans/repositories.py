"""Repository selection and addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.functions import languages, repos
from winnowry.operators import repositories as ops
from winnowry.plans import oracle as o
from winnowry.plans.registry import query
from winnowry.sources import tables

LANGUAGES = ["Brand#1", "Brand#2", "Brand#3", "Brand#17"]
_IN = ", ".join(o.quote(x) for x in LANGUAGES)
TOPICS = tuple(t for t, _ in fv.TOPIC_QUERIES) + ("data engineering",)
LANGUAGE_LISTS = ("python, go", "javascript,typescript", "Rust,,cpp", "c,cpp", "cobol", "")
_LISTS = "[" + ", ".join(o.quote(x) for x in LANGUAGE_LISTS) + "]"
_SPLIT = f"list_filter(list_transform(string_split(({_LISTS})[p_partkey % 6 + 1], ','), lambda x: trim(x)), lambda x: x <> '')"


@query("p13_repo_key_from_url", r"""
WITH paths AS (
  SELECT page_id, url || CASE WHEN page_id % 3 = 0 THEN '.git/' ELSE '' END AS url FROM pages),
cut AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(url,
    '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''), '/+$', '') AS path FROM paths)
SELECT page_id, replace(replace(regexp_replace(path, '^/+', ''), '.git', ''), '/', '_') AS repo_key FROM cut""")
def repo_key_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.col("url"), F.when(F.col("page_id") % 3 == 0, F.lit(".git/")).otherwise(F.lit("")))
    return tables.table(spark, sf_dir, "pages").select("page_id", repos.repo_key(url).alias("repo_key"))


@query("f6_select_repos", f"""
WITH {o.REPOS} SELECT repo_id, name, stars, forks FROM repos
WHERE language IN ({_IN}) AND stars >= 10 AND forks >= 950""")
def select_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = ops.select_repos(tables.repos_from_part(spark, sf_dir), LANGUAGES, 10, 950)
    return chosen.select("repo_id", "name", "stars", "forks")


@query("k2_top_repos", f"""
WITH {o.REPOS} SELECT repo_id, name, url, language, stars, forks FROM repos
WHERE language IN ({_IN}) AND stars >= 1 AND forks >= 0 ORDER BY stars DESC, forks DESC, repo_id LIMIT 50""")
def top_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = ops.select_repos(tables.repos_from_part(spark, sf_dir), LANGUAGES, 1, 0)
    return ops.top_repos(chosen, 50).select("repo_id", "name", "url", "language", "stars", "forks")


@query("p34_topic_queries", f"""
SELECT p_partkey, CASE t {" ".join(f"WHEN {o.quote(a)} THEN {o.quote(b)}" for a, b in fv.TOPIC_QUERIES)} ELSE t END AS query
FROM (SELECT p_partkey, ([{", ".join(o.quote(t) for t in TOPICS)}])[p_partkey % 6 + 1] AS t FROM part)""")
def topic_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = tables.pick(TOPICS, F.col("p_partkey") % 6)
    return tables.table(spark, sf_dir, "part").select("p_partkey", repos.topic_query(topic).alias("query"))


@query("p34_u3_extension_sets", f"""
WITH l AS (SELECT p_partkey, {_SPLIT} AS langs FROM part),
e AS (SELECT l.p_partkey, unnest(m.exts) AS extension FROM l
      JOIN (VALUES {o.values(fv.LANGUAGE_EXTENSIONS)}) m(lang, exts)
      ON list_contains(list_transform(l.langs, lambda x: lower(x)), m.lang))
SELECT DISTINCT p_partkey, extension FROM e""")
def extension_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = languages.split_list(tables.pick(LANGUAGE_LISTS, F.col("p_partkey") % 6))
    return tables.table(spark, sf_dir, "part").select(
        "p_partkey", F.explode(languages.extensions_of_languages(wanted)).alias("extension"))


@query("p35_search_query", f"""
WITH l AS (SELECT p_partkey, p_name, p_size, {_SPLIT} AS langs FROM part)
SELECT p_partkey, p_name || ' ' || coalesce(array_to_string(list_transform(langs, lambda x: 'language:' || x), ' '), '')
       || ' stars:>=' || p_size || ' forks:>=' || (p_partkey % 7) AS query FROM l""")
def search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = languages.split_list(tables.pick(LANGUAGE_LISTS, F.col("p_partkey") % 6))
    text = repos.search_text(F.col("p_name"), wanted, F.col("p_size"), F.col("p_partkey") % 7)
    return tables.table(spark, sf_dir, "part").select("p_partkey", text.alias("query"))


@query("a14_repo_status", """
WITH s AS (SELECT ['pending', 'cloned', 'processed', 'failed'][p_size % 4 + 1] AS state FROM part)
SELECT count(*) AS total, count(*) FILTER (WHERE state IN ('cloned', 'processed')) AS cloned,
       count(*) FILTER (WHERE state = 'processed') AS processed, count(*) FILTER (WHERE state = 'failed') AS failed
FROM s""")
def repo_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = tables.pick(("pending", "cloned", "processed", "failed"), F.col("p_size") % 4)
    return ops.repo_status(tables.table(spark, sf_dir, "part").select(state.alias("state")))
