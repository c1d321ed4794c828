"""Repository addresses and search text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnowry import fixed_values as fv


def repo_of_path(path: Column) -> Column:
    """The path segment after the first ``repos`` of a lab path, else ``unknown``."""
    parts = F.split(path, "/")
    marked = F.array_contains(parts, fv.REPO_PATH_MARKER) & F.array_contains(parts, fv.REPO_PATH_PARENT)
    following = F.try_element_at(parts, (F.array_position(parts, fv.REPO_PATH_PARENT) + 1).cast("int"))
    return F.when(marked, F.coalesce(following, F.lit("unknown"))).otherwise(F.lit("unknown"))


def url_path(url: Column) -> Column:
    """Path component by the generic URI grammar, so text that is no URL still yields one."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def repo_key(url: Column) -> Column:
    """owner_repo: outer slashes off, every ``.git`` deleted, inner slashes to underscores."""
    path = F.regexp_replace(F.regexp_replace(url_path(url), r"/+$", ""), r"^/+", "")
    return F.replace(F.replace(path, F.lit(".git"), F.lit("")), F.lit("/"), F.lit("_"))


def topic_query(topic: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in fv.TOPIC_QUERIES for x in pair])
    return F.coalesce(F.try_element_at(table, topic), topic)


def search_text(query: Column, languages: Column, min_stars: Column, min_forks: Column) -> Column:
    tags = F.concat_ws(" ", F.transform(languages, lambda x: F.concat(F.lit("language:"), x)))
    return F.concat(
        query, F.lit(" "), tags,
        F.lit(" stars:>="), min_stars.cast("string"), F.lit(" forks:>="), min_forks.cast("string"),
    )
