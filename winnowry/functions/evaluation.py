"""Rule-based checks of model responses and code."""

from __future__ import annotations

import ast
import warnings

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry.functions.text import SPACE, strip


def keyword_count(response: Column, keywords: Column) -> Column:
    low = F.lower(response)
    return F.size(F.filter(keywords, lambda k: F.contains(low, F.lower(k))))


def keyword_match(response: Column, keywords: Column) -> Column:
    """At least half (rounded down) of the keywords occur."""
    return keyword_count(response, keywords) >= F.floor(F.size(keywords) / 2)


def length_ok(response: Column, low: Column, high: Column) -> Column:
    return F.length(response).between(low, high)


def pattern_hit(response: Column, expected: Column) -> Column:
    return F.contains(response, expected)


def has_test_function(response: Column) -> Column:
    return F.contains(response, F.lit("def test_"))


@F.pandas_udf(T.BooleanType())
def python_parses(code: pd.Series) -> pd.Series:
    """Whether each text parses as Python.  Texts the parser gives up on do not."""
    def parses(text: str | None) -> bool:
        if text is None:
            return False
        try:
            ast.parse(text)
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return False
        return True

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return code.map(parses).astype(bool)


def code_metrics(code: Column) -> dict[str, Column]:
    """Line, comment, indentation and naming measures of one text."""
    lines = F.split(code, "\n")
    comments = F.filter(lines, lambda x: F.startswith(strip(x), F.lit("#")) | F.contains(x, F.lit("//")))
    indents = F.filter(
        F.transform(
            F.filter(lines, lambda x: x.rlike(r"(?U)[^\s\x1c-\x1f]")),
            lambda x: F.length(F.regexp_extract(x, rf"(?U)\A{SPACE}+", 0)),
        ),
        lambda n: n > 0,
    )
    names = F.regexp_extract_all(code, F.lit(r"(?U)def\s+([a-zA-Z_][a-zA-Z0-9_]*)"), F.lit(1))
    snake = F.filter(names, lambda n: F.contains(n, F.lit("_")) | ((n == F.lower(n)) & n.rlike("[a-z]")))
    return {
        "line_count": F.size(lines).cast("bigint"),
        "char_count": F.length(code).cast("bigint"),
        "comment_ratio": F.size(comments) / F.size(lines),
        "indentation_consistency": _modal_share(indents),
        "naming_convention_score": F.when(F.size(names) > 0, F.size(snake) / F.size(names)).otherwise(F.lit(0.0)),
    }


def _modal_share(values: Column) -> Column:
    """Share of the most frequent value; one pass over the sorted values."""
    start = F.struct(
        F.lit(-1).alias("value"), F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(0).alias("n"),
    )

    def add(acc: Column, v: Column) -> Column:
        run = F.when(acc["value"] == v, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(
            v.alias("value"), run.alias("run"),
            F.greatest(acc["best"], run).alias("best"), (acc["n"] + 1).alias("n"),
        )

    return F.aggregate(
        F.sort_array(values), start, add,
        lambda acc: F.when(acc["n"] > 0, acc["best"] / acc["n"]).otherwise(F.lit(0.0)),
    )
