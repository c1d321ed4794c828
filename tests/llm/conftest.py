import random

import pytest

EXTRA = ("key", "row", "score", "bucket", "sketch", "digest", "shard", "item", "value", "text_hash", "length")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, very long and repeated texts, and columns named like those the operators make."""
    rng = random.Random(5)
    long = " ".join(rng.choice("abcdefghij") + rng.choice("klmnop") * rng.randint(1, 4) for _ in range(30_000))
    rows = [(1, "the one text of some words in here"), (1, "the one text of some words in here"), (2, None), (3, ""),
            (4, "   \n\t "), (None, "a text without an id"), (5, long), (6, "x"), (7, "12 34 !!"), (8, "Ünï wörds 漢字 éà <|im_end|>  x")]
    return with_extra(spark, rows)


def with_extra(spark, rows):
    names = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([(i, t, "en", "s", *["z"] * len(EXTRA)) for i, t in rows],
                                 f"doc_id bigint, text string, lang string, source string, {names}")


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda rows: with_extra(spark, rows)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
