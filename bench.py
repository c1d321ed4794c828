"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from winnowry.plans import registry
from winnowry.session import build_session

HEADLINES = (
    "a2_clean_stats", "a1_dedupe_exact", "p2_char_entropy", "p3_detect_language", "f4_filter_samples",
    "w1_balance_by_language", "j1_generate_samples", "p17_redact_secrets", "a6_usage_rollup", "a7_counter_fold",
    "w8_restart_replay", "p30_log_metrics", "a9_eval_rollup", "p36_code_metrics", "k2_top_repos",
)
WARM_UP = ("a2_clean_stats", "k2_top_repos")  # class loading and JIT, not timed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="bench", **{
        "spark__ui__enabled": "false", "spark__ui__showConsoleProgress": "false", "spark__driver__memory": "8g",
        "spark__sql__shuffle__partitions": str(2 * int(cpus) if cpus.isdigit() else 16),
        "spark__sql__files__maxPartitionBytes": "4m", "spark__checkpoint__dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.load()
    for name in WARM_UP:
        queries[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "documents_per_sec_clean": round(rows / seconds["a2_clean_stats"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
