"""Run state, run lists and run comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.functions import text
from winnowry.operators.ranking import top_n_per_group

INFINITY = float("inf")


def prepare_events(events: DataFrame, state: DataFrame | None = None,
                   join: Callable[[DataFrame, DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Defaults from the run's state, redaction and truncation, then the field list plus ``error``.

    ``join`` brings events and state together by the run, a plain left join unless given.
    """
    df = events
    if state is not None:
        known = state.select("run_id", F.col("current_round").alias("_round"), F.col("current_stage").alias("_stage"))
        df = (join(df, known, "run_id") if join else df.join(known, "run_id", "left")).withColumns({
            "round": F.coalesce("round", "_round", F.lit(0)),
            "stage": F.coalesce(F.nullif(F.col("stage"), F.lit("")), "_stage", F.lit("unknown")),
        })
    cleaned = {
        "event_version": F.lit(fv.EVENT_VERSION),
        "message": text.sanitize(F.coalesce("message", F.lit("")), fv.MAX_MESSAGE_LENGTH),
        "artifact_paths": text.truncate_paths(F.col("artifact_paths")),
    }
    if "error" in df.columns:
        cleaned["error"] = text.sanitize(F.col("error"), fv.MAX_ERROR_LENGTH)
    return whitelist(df.withColumns(cleaned), fv.EVENT_FIELDS, keep=("error",))


def whitelist(df: DataFrame, fields: tuple, keep: tuple = ()) -> DataFrame:
    """Only the named columns that exist, in list order."""
    return df.select(*[c for c in (*fields, *keep) if c in df.columns])


def whitelist_map(c: Column, fields: tuple = fv.STATUS_FIELDS) -> Column:
    return F.map_filter(c, lambda k, _: k.isin(*fields))


def merge_live_state(states: DataFrame, configs: DataFrame, live: DataFrame, fields: list[str]) -> DataFrame:
    """Stored state with its config and its live telemetry; live fields win.

    ``live`` is keyed by the run being displayed (``run_id``) and names the run it reports
    (``reported_run_id``); another name raises the mismatch flag and its values are ignored.
    """
    seen = live.select(
        "run_id", F.col("reported_run_id").alias("_reported"), *[F.col(f).alias(f"_{f}") for f in fields])
    joined = states.join(configs, "run_id", "left").join(seen, "run_id", "left")
    mismatch = F.coalesce(F.col("_reported") != F.col("run_id"), F.lit(False))
    merged = [
        F.coalesce(F.when(~mismatch, F.col(f"_{f}")), F.col(f)).alias(f) for f in fields]
    rest = [c for c in states.columns if c not in fields and c != "run_id"]
    extra = [c for c in configs.columns if c != "run_id"]
    return joined.select("run_id", *rest, *extra, *merged, mismatch.alias("mismatch"))


def prefer_local(local: DataFrame, remote: DataFrame, key: str = "run_id") -> DataFrame:
    """Local rows plus the remote rows of runs that are not local."""
    return local.unionByName(remote.join(local.select(key), key, "left_anti"), allowMissingColumns=True)


def overlay_positive(base: DataFrame, derived: DataFrame, fields: list[str], key: str = "run_id") -> DataFrame:
    """Left join in which derived values win where they are above zero."""
    d = derived.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = base.join(d, key, "left")
    return joined.withColumns({
        f: F.when(F.col(f"_{f}") > 0, F.col(f"_{f}")).otherwise(F.col(f)) for f in fields
    }).drop(*[f"_{f}" for f in fields])


def effective_loss(best_eval_loss: Column, final_loss: Column) -> Column:
    """best_eval_loss, or final_loss when that is null or 0, or infinity."""
    return F.coalesce(F.nullif(best_eval_loss, F.lit(0.0)), final_loss, F.lit(INFINITY))


def best_run(runs: DataFrame, loss: str, pos: str, keys: list[str] | None = None) -> DataFrame:
    """The run of smallest loss, the earliest of equals."""
    pick = F.min_by("run_id", F.struct(loss, pos)).alias("run_id")
    value = F.min(loss).alias(loss)
    return runs.groupBy(*keys).agg(pick, value) if keys else runs.agg(pick, value)


def recent_events(events: DataFrame, key: str = "run_id", pos: str = "pos", n: int = fv.RECENT_EVENTS,
                  chars: int = fv.RECENT_EVENT_MESSAGE) -> DataFrame:
    """The last ``n`` events per run, newest first as ``rn``, messages cut to ``chars``."""
    out = top_n_per_group(events, [key], [F.col(pos).desc()], n, rank_name="rn")
    return out.withColumn("message", F.substring("message", 1, chars))


def last_event_ts(events: DataFrame, key: str = "run_id", pos: str = "pos", ts: str = "ts") -> DataFrame:
    return events.groupBy(key).agg(F.max_by(ts, pos).alias("last_event_ts"))


def merge_reports(reports: DataFrame, key: str = "run_id", pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """(latest report per run, rejected reports without a run)."""
    named = F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
    accepted = top_n_per_group(reports.filter(named), [key], [F.col(pos).desc()], 1)
    return accepted, reports.filter(~named)


def missing_fields(docs: DataFrame, key: str = "run_id", fields: tuple = fv.REQUIRED_TELEMETRY_FIELDS) -> DataFrame:
    """(run, missing field) for required fields that are absent or null."""
    checks = [
        F.when(F.col(f).isNull() if f in docs.columns else F.lit(True), F.lit(f)) for f in fields]
    return docs.select(key, F.explode(F.array_compact(F.array(*checks))).alias("missing"))


def checkpoint_sizes(files: DataFrame, suffixes: tuple = (".safetensors", ".bin")) -> DataFrame:
    """MiB of weight files per checkpoint directory, from (path, length) metadata only."""
    weight = F.lit(False)
    for s in suffixes:
        weight = weight | F.endswith("path", F.lit(s))
    directory = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.filter(weight).groupBy(directory.alias("directory")).agg(
        (F.sum("length") / (1024 * 1024)).alias("size_mb"))


def latest_artifacts(files: DataFrame, pattern: str, keys: list[str] | None = None) -> DataFrame:
    """Newest path (by modification time) matching ``pattern``, and the round its name carries."""
    newest = F.max(F.struct("modificationTime", "path"))["path"].alias("path")
    matching = files.filter(F.col("path").rlike(pattern))
    out = matching.groupBy(*keys).agg(newest) if keys else matching.agg(newest)
    return out.withColumn("round", F.regexp_extract("path", r"_round_(\d+)", 1).try_cast("bigint"))


def dataset_info(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Counts of raw, clean, train and validation rows, language counts and last update."""
    per_language = clean.groupBy("detected_language").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("train"),
        F.max("updated_at").alias("updated_at"))
    stats = per_language.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("clean_rows"),
        F.coalesce(F.sum("train"), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum("n") - F.sum("train"), F.lit(0)).alias("validation_rows"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("detected_language", "n")))).alias("languages"),
        F.max("updated_at").alias("last_updated"),
    )
    both = raw.agg(F.count("*").alias("raw_rows")).unionByName(stats, allowMissingColumns=True)
    plain = [F.max(c).alias(c) for c in both.columns if c != "languages"]
    return both.agg(*plain, F.first("languages", ignorenulls=True).alias("languages"))
