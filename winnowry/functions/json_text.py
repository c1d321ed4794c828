"""JSON that Spark's own parser refuses and others take: repeated keys (the last counts), NaN and Infinity.

Columns are null for text that needs no second look, so that Python reads the rare lines alone.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def loaded(text: str | None) -> object:
    try:
        return json.loads(text) if text is not None else None
    except (ValueError, RecursionError):
        return None


def decodes(text: Column) -> Column:
    """Whether a text is a JSON value; null for null."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else t.strip() == "null" or loaded(t) is not None for t in texts], dtype=object)

    return F.pandas_udf(run, T.BooleanType())(text)


def plain(value: object, kind: T.DataType) -> str | None:
    """A field's value as text to cast: text fields take strings alone, numbers also truth values and numeric strings."""
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else None
    if value is None or isinstance(kind, T.AtomicType) and isinstance(value, (dict, list)):
        return None
    if isinstance(value, bool):
        return str(int(value)) if isinstance(kind, T.NumericType) else str(value).lower()
    return value if isinstance(value, str) else json.dumps(value) if isinstance(value, (dict, list)) else str(value)


def object_fields(text: Column, schema: T.StructType) -> Column:
    """The wanted fields of a JSON object as a map of texts; null for null and for what is no object."""
    def run(texts: pd.Series) -> pd.Series:
        def fields(t: str | None) -> dict | None:
            value = loaded(t)
            return {f.name: plain(value.get(f.name), f.dataType) for f in schema} if isinstance(value, dict) else None

        return pd.Series([fields(t) for t in texts], dtype=object)

    return F.pandas_udf(run, T.MapType(T.StringType(), T.StringType()))(text)
