"""Run status, rates, progress and display values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.functions.text import strip


def resolve_status(stop_requested: Column, status: Column, last_error: Column, health: Column,
                   run_id: Column, teacher_generated: Column, requests_sent: Column,
                   train_step: Column) -> Column:
    def positive(c: Column) -> Column:
        return F.coalesce(c > 0, F.lit(False))

    active = positive(teacher_generated) | positive(requests_sent) | positive(train_step)
    failed = (F.coalesce(last_error, F.lit("")) != "") | (F.coalesce(health, F.lit("")) == "degraded")
    return (
        F.when(F.coalesce(stop_requested, F.lit(False)), F.lit("stopped"))
        .when(status.isin(*fv.TERMINAL_STATUSES), status)
        .when(failed, F.lit("error"))
        .when((F.coalesce(run_id, F.lit("")) != "") & active, F.lit("running"))
        .otherwise(F.lit("idle"))
    )


def health_of(status: Column) -> Column:
    return F.when(status == "error", F.lit("degraded")).otherwise(F.lit("ok"))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, and 0 where there is no whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def overall_percent(stage_index: Column, total_stages: Column, stage_percent: Column) -> Column:
    weight = F.lit(100.0) / total_stages
    return F.when(total_stages > 0, stage_index * weight + weight * stage_percent / 100).otherwise(F.lit(0.0))


def steps_per_second(seconds_per_step: Column) -> Column:
    return F.when(seconds_per_step > 0, F.lit(1.0) / seconds_per_step).otherwise(F.lit(0.0))


def eta_seconds(done: Column, total: Column, speed: Column) -> Column:
    left = total - done
    return F.when((left > 0) & (speed > 0), left / speed)


def estimated_total_seconds(elapsed: Column, progress_percent: Column) -> Column:
    return F.when(progress_percent > 0, elapsed / (progress_percent / 100))


def _fixed(value: Column, digits: int, unit: str) -> Column:
    """Half-even decimal text without grouping."""
    return F.concat(F.replace(F.format_number(value.cast("double"), digits), F.lit(","), F.lit("")), F.lit(unit))


def humanize_eta(seconds: Column) -> Column:
    return (
        F.when(seconds >= 3600, _fixed(seconds / 3600, 1, "h"))
        .when(seconds >= 60, _fixed(seconds / 60, 1, "m"))
        .otherwise(_fixed(seconds, 0, "s"))
    )


def humanize_age(seconds: Column) -> Column:
    return (
        F.when(seconds < 60, _fixed(seconds, 0, "s"))
        .when(seconds < 3600, _fixed(seconds / 60, 0, "m"))
        .otherwise(_fixed(seconds / 3600, 1, "h"))
    )


def clock_time(iso: Column) -> Column:
    """HH:MM:SS as written in an ISO timestamp; the first eight characters of anything else."""
    written = F.regexp_extract(iso, r"^\d{4}-\d{2}-\d{2}[T ](\d{2}:\d{2}(?::\d{2})?)", 1)
    full = F.when(F.length(written) == 5, F.concat(written, F.lit(":00"))).otherwise(written)
    parses = iso.try_cast("timestamp").isNotNull()
    return F.when(parses & (full != ""), full).when(parses, F.lit("00:00:00")).otherwise(
        F.substring(F.coalesce(iso, F.lit("")), 1, 8)
    )


def provider_name(provider: Column) -> Column:
    key = strip(F.lower(provider))
    table = F.create_map(*[F.lit(x) for pair in fv.PROVIDER_NAMES for x in pair])
    words = F.regexp_extract_all(key, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    title = F.array_join(F.transform(words, lambda w: F.initcap(w)), "")
    titled = F.when(key == "", F.lit("Unknown")).otherwise(title)
    return F.coalesce(F.try_element_at(table, key), titled)


def usage_band(value: Column) -> Column:
    low, high = fv.BAND_LIMITS
    return F.when(value < low, F.lit("normal")).when(value <= high, F.lit("warning")).otherwise(F.lit("critical"))


def resource_alert(metric: Column, value: Column) -> Column:
    limits = F.create_map(*[F.lit(x) for pair in fv.RESOURCE_ALERTS for x in pair])
    return F.coalesce(value > F.try_element_at(limits, metric), F.lit(False))
