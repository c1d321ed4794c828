"""From raw documents to packed training sequences, stage by stage.

Every stage works on what its predecessor kept.  Between stages the rows are Parquet in the shared
folder, so a lost executor costs the running stage's tasks only.  Filters keep only their decisions on
disk; ``run`` also removes what a stage wrote for itself, and its input, once its rows are written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from winnowry.llm import decontamination, languages, neardup, packing, substrings
from winnowry.llm import common
from winnowry.session import scratch
from winnowry.sources.tables import table

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or in no learned language go."""
    return languages.identified(docs, languages.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose 5-word shingles agree to 0.8, the one with the smallest id stays."""
    return neardup.without_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut; documents of nothing else go."""
    return substrings.without_passages(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [(f.__name__, f) for f in (
    language_id, near_dedup, substring_dedup, benchmark_decontamination, best_fit_packing)]

#: SQL cannot express tokenizers or learned filters; the stages are tested against plain Python instead.
ORACLE_SQL = None


def written(docs: DataFrame, name: str) -> DataFrame:
    return docs.sparkSession.read.parquet(write(docs, name))


def write(docs: DataFrame, name: str) -> str:
    path = scratch(docs.sparkSession, f"stage-{name}")
    docs.write.parquet(path)
    return path


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with common.noted() as own:
            path = write(stage(spark, docs, sf_dir), name)
        common.remove(spark, own + before)
        docs, before = spark.read.parquet(path), [path]
    return docs
