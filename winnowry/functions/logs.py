"""Values read out of log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEVERITIES = ("ERROR", "WARNING", "INFO", "DEBUG")


def severity(line: Column) -> Column:
    """First of ERROR, WARNING, INFO, DEBUG found in the upper-cased line, else OTHER."""
    upper = F.upper(line)
    out = F.when(F.contains(upper, F.lit(SEVERITIES[0])), F.lit(SEVERITIES[0]))
    for name in SEVERITIES[1:]:
        out = out.when(F.contains(upper, F.lit(name)), F.lit(name))
    return out.otherwise(F.lit("OTHER"))


def grab(line: Column, pattern: str, group: int, kind: str) -> Column:
    """One capture group cast to ``kind``; null without a match or when it does not parse."""
    text = F.regexp_extract(line, pattern, group)
    return F.replace(text, F.lit(","), F.lit("")).try_cast(kind)


def training_metrics(line: Column) -> dict[str, Column]:
    """Wide metric columns of one training log line; null where the line has none.

    Plain substring tests come first, so most lines meet few regular expressions.
    """
    def has(word: str) -> Column:
        return F.contains(line, F.lit(word))

    bar = r"\|\s*(\d+)/(\d+)\s*\[.*?([0-9]+\.?[0-9]*)s/it"
    is_bar = has("%|") & has("s/it")
    is_ratio = has("|") & has("/") & has("%")
    ratio = r"\|\s*([0-9]+)/([0-9]+)\s*\|"
    is_params = F.contains(F.lower(line), F.lit("params"))

    def given(gate: Column, pattern: str, group: int, kind: str) -> Column:
        return F.when(gate, grab(line, pattern, group, kind))

    return {
        "bar_step": given(is_bar, bar, 1, "bigint"),
        "bar_total": given(is_bar, bar, 2, "bigint"),
        "sec_per_it": given(is_bar, bar, 3, "double"),
        "round": given(has("Round"), r"Round (\d+)/(\d+)", 1, "bigint"),
        "rounds": given(has("Round"), r"Round (\d+)/(\d+)", 2, "bigint"),
        "step": F.coalesce(given(is_ratio, ratio, 1, "bigint"), given(has("Step"), r"Step (\d+)/(\d+)", 1, "bigint")),
        "steps": F.coalesce(given(is_ratio, ratio, 2, "bigint"), given(has("Step"), r"Step (\d+)/(\d+)", 2, "bigint")),
        "loss": given(has("'loss':"), r"'loss':\s*'([0-9.]+)'", 1, "double"),
        "learning_rate": given(has("'learning_rate':"), r"'learning_rate':\s*'([0-9.e-]+)'", 1, "double"),
        "trainable_params": given(is_params, r"(?i)(trainable params|trainable_params)[:\s]+([\d,]+)", 2, "bigint"),
        "total_params": given(is_params, r"(?i)(total params|all params|total_params)[:\s]+([\d,]+)", 2, "bigint"),
    }


def is_training_line(line: Column) -> Column:
    upper = F.upper(line)
    hit = F.contains(line, F.lit("%|"))
    for word in ("'LOSS':", "'LEARNING_RATE':", "ROUND", "STEP"):
        hit = hit | F.contains(upper, F.lit(word))
    return hit


def generation_metrics(line: Column) -> dict[str, Column]:
    """Metrics of one generation log line.  A line counts for its first matching kind only."""
    low = F.lower(line)

    def has(c: Column, word: str) -> Column:
        return F.contains(c, F.lit(word))

    stage = has(line, "Stage: generate")
    made = ~stage & has(line, "Generated") & has(line, "samples")
    tokens = ~stage & ~made & has(low, "tokens") & (has(low, "prompt") | has(low, "completion"))
    prompt = tokens & has(low, "prompt tokens:")
    completion = tokens & ~prompt & has(low, "completion tokens:")
    total = tokens & ~prompt & ~completion & has(low, "total tokens:")
    request = ~stage & ~made & ~tokens & (has(line, "API request") | has(low, "requests:"))
    return {
        "stage": F.when(stage, F.lit("generating")),
        "generated": F.when(made, grab(line, r"Generated[:\s]+(\d+)", 1, "bigint")),
        "prompt_tokens": F.when(prompt, grab(line, r"prompt tokens[:\s]+([\d,]+)", 1, "bigint")),
        "completion_tokens": F.when(completion, grab(line, r"completion tokens[:\s]+([\d,]+)", 1, "bigint")),
        "total_tokens": F.when(total, grab(line, r"total tokens[:\s]+([\d,]+)", 1, "bigint")),
        "requests": F.when(request, grab(low, r"(\d+)\s+request", 1, "bigint")),
    }


def parallel_metrics(line: Column) -> dict[str, Column]:
    """Stage and counts of one line of a parallel generation log."""
    def has(word: str) -> Column:
        return F.contains(line, F.lit(word))

    processing = F.startswith(line, F.lit("Processing ")) & has(" files with ")
    finished = has("DONE. Output written to:") | (has("Generated ") & has(" samples from "))
    done_pattern = r"Generated\s+(\d+)\s+samples\s+from\s+(\d+)\s+files"
    bar_pattern = r"\|\s*(\d+)/(\d+)\s*\["
    bar = has("Generating") & has("%|") & line.rlike(bar_pattern)
    scrape = has("Cloning ") | has("Updating ") | has("Wrote filelist to")
    stage = (
        F.when(bar, F.lit("generate"))
        .when(has("Searching with query:"), F.lit("search"))
        .when(scrape, F.lit("scrape"))
        .when(processing, F.lit("generate"))
        .when(finished, F.lit("done"))
    )
    early = has("Searching with query:") | scrape
    started = ~early & processing
    ended = ~early & ~processing & finished & line.rlike(done_pattern)
    return {
        "stage": stage,
        "processed_files": F.when(bar, grab(line, bar_pattern, 1, "bigint")).when(
            ended, grab(line, done_pattern, 2, "bigint")),
        "total_files": F.when(bar, grab(line, bar_pattern, 2, "bigint"))
        .when(started, grab(line, r"^Processing\s+(\d+)\s+files\s+with\s+(\d+)\s+workers", 1, "bigint"))
        .when(ended, grab(line, done_pattern, 2, "bigint")),
        "finished_samples": F.when(ended, grab(line, done_pattern, 1, "bigint")),
        "running_samples": grab(line, r"\bsamples=([0-9]+)\b", 1, "bigint"),
    }
