"""Quality scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnowry import fixed_values as fv


def quality_score(base: Column, instruction: Column, context: Column, response: Column,
                  entropy: Column, language: Column) -> Column:
    """Weighted sum of base score, lengths, entropy, context and language, at most 1."""
    one = F.lit(1.0)
    has_context = F.coalesce(context, F.lit("")) != ""
    total = (
        F.coalesce(base, F.lit(0.0)) * 0.3
        + F.least(F.length(response) / 500, one) * 0.2
        + entropy * 0.2
        + F.least(F.length(instruction) / 200, one) * 0.1
        + F.when(has_context, 0.1).otherwise(0.0)
        + F.when(language != fv.UNKNOWN_LANGUAGE, 0.1).otherwise(0.0)
    )
    return F.least(total, one)


def generation_score(context: Column, response: Column) -> Column:
    has_context = F.coalesce(context, F.lit("")) != ""
    length_part = F.least(F.length(response) / 1000, F.lit(0.7))
    return F.least(F.when(has_context, 0.3).otherwise(0.0) + length_part, F.lit(1.0))
