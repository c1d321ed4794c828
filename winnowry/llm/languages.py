"""Language identification by language-bitmask n-gram filters.

For each language the n-grams that a fair share of its training documents contain go into one Bloom
filter; the filters are bit-sliced, so a slot holds one bit per language and the AND of an n-gram's
slots names every language that has it.  A text's votes are counted per language, less what chance
hits of the filter would give, and the language with most votes wins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.llm.common import held_out, small_batches

UNKNOWN = "und"
SIZES = (2, 3, 4)
SLOTS = 1 << 18
HASHES = 3
TRAIN_DOCS = 2000  # bound of the training sample, per language
MIN_SHARE = 0.05  # of a language's training documents that contain an n-gram of its filter
MAX_GRAM_CHARS = 200_000  # of one text hashed at once; longer texts go block by block
LARGE_ALPHABETS = 0x0E00  # from here on scripts without spaces or with syllable signs, whose longer n-grams are rare each
USUAL = 0.01  # quantile of the shares of a language's training documents
CERTAIN = 0.5  # part of it that a document needs to be kept
LETTERS = re.compile(r"[^\W\d_]+")
SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def letters_of(text: str | None) -> str:
    """Lower-case words of letters with one space around each; empty without letters."""
    found = [w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in LETTERS.findall((text or "").lower())]
    found = [w for w in found if w]  # number signs like a half or a Roman eight are no letters
    return f" {' '.join(found)} " if found else ""


def gram_codes(prose: str) -> np.ndarray:
    """A 64-bit code of every n-gram of the sizes, repeats included; of large alphabets also the single letters."""
    chars = np.frombuffer(prose.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    out = []
    for n in SIZES:
        if len(chars) >= n:
            code = np.full(len(chars) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                code = code * np.uint64(0x100000001B3) + chars[k:len(chars) - n + 1 + k]
            out.append(code ^ (code >> np.uint64(29)))
    single = chars[chars >= LARGE_ALPHABETS]
    out.append(single * np.uint64(0x100000001B3) ^ np.uint64(1))
    return np.concatenate(out)


def blocks(prose: str) -> Iterator[str]:
    """Whole texts in blocks that overlap by what an n-gram needs."""
    for at in range(0, max(1, len(prose)), MAX_GRAM_CHARS):
        yield prose[max(0, at - max(SIZES) + 1):at + MAX_GRAM_CHARS]


def slots_of(codes: np.ndarray) -> np.ndarray:
    """The filter slots of each code, one row per hash."""
    shift = np.uint64(64 - int(math.log2(SLOTS)))
    return ((codes[None, :] * SPREAD[:HASHES, None]) >> shift).astype(np.int64)


class Filters:
    """Bit-sliced Bloom filters, one bit for each language in the words of a slot."""

    def __init__(self, languages: list[str], default: str, grams: dict[str, np.ndarray]) -> None:
        self.languages, self.default = languages, default
        self.least = np.zeros(len(languages))  # share of votes below which a document is in no learned language
        self.masks = np.zeros((SLOTS, -(-len(languages) // 64)), dtype=np.uint64)
        for k, name in enumerate(languages):
            self.masks[np.unique(slots_of(grams[name])), k // 64] |= np.uint64(1 << k % 64)
        # A foreign n-gram passes a language's filter if all its slots carry the bit.
        self.chance = np.array([np.mean(self.bit(self.masks, k)) ** HASHES for k in range(len(languages))])

    @staticmethod
    def bit(masks: np.ndarray, k: int) -> np.ndarray:
        """Whether masks have the bit of the k-th language."""
        return masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)

    def holders(self, codes: np.ndarray) -> np.ndarray:
        """For each n-gram the bitmask of all languages whose filter contains it."""
        return np.bitwise_and.reduce(self.masks[slots_of(codes)], axis=0)

    def votes(self, prose: str) -> tuple[np.ndarray, int]:
        """Corrected votes per language, and the number of n-grams."""
        hits, total = np.zeros(len(self.languages)), 0
        for block in blocks(prose):
            held = self.holders(gram_codes(block))
            total += len(held)
            for k in range(len(self.languages)):
                hits[k] += np.count_nonzero(self.bit(held, k))
        return np.maximum(0.0, (hits - total * self.chance) / (1 - self.chance)), total

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of the n-grams that vote for it); texts without letters are unknown."""
        prose = letters_of(text)
        if not prose or not self.languages:
            return UNKNOWN, 0.0
        votes, total = self.votes(prose)
        best = int(np.argmax(votes))
        if votes[best] == 0:
            return self.default, 0.0
        return self.languages[best], float(min(1.0, votes[best] / total))


def train(docs: DataFrame, per_language: int = TRAIN_DOCS) -> Filters:
    """Filters from the training folds of ``docs`` (doc_id, text, lang).

    At most about ``per_language`` documents of each language are read for it, chosen by a hash of the
    id; n-grams are counted by Spark, and only those of the filters (at most the mean number of n-grams
    of a document over MIN_SHARE, per language) reach the driver.
    """
    learn = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang").filter(
        "lang is not null and text is not null").filter(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Filters([], UNKNOWN, {})
    languages = sorted(sizes)
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, F.lit(per_language / sizes[name])).otherwise(share)
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("language sample")), 11) / float(1 << 53)

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, text in zip(batch["lang"], batch["text"]):
                codes = np.unique(np.concatenate([gram_codes(b) for b in blocks(letters_of(text))]))
                yield pd.DataFrame({"lang": name, "code": codes.view(np.int64)})

    least = F.lit(math.inf)
    for name in languages:
        least = F.when(F.col("lang") == name, F.lit(max(1.0, MIN_SHARE * min(per_language, sizes[name])))).otherwise(least)
    counted = learn.filter(draw < share).select("lang", "text").mapInPandas(grams, "lang string, code bigint").groupBy(
        "lang", "code").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("lang", "code")
    with small_batches(docs.sparkSession):
        kept = counted.toPandas()
    sample = learn.filter(draw < share)
    codes = {name: kept.loc[kept["lang"] == name, "code"].to_numpy(np.int64).view(np.uint64) for name in languages}
    made = Filters(languages, max(languages, key=lambda x: (sizes[x], x)), codes)
    # A language's usual share comes from its own training documents: large alphabets repeat less.
    shares = identify(sample, made, "lang").filter("lang = lang_pred").groupBy("lang").agg(
        F.percentile_approx("score", USUAL, 1000).alias("share"))
    with small_batches(docs.sparkSession):
        usual = shares.collect()
    for r in usual:
        made.least[languages.index(r["lang"])] = CERTAIN * r["share"]
    return made


def identify(docs: DataFrame, filters: Filters, *kept: str) -> DataFrame:
    """doc_id, lang_pred and score of every text, and ``kept`` text columns; ``und`` for null texts and texts without letters."""
    model = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = [model.value.predict(t) for t in batch["text"]]
            yield batch[["doc_id", *kept]].assign(lang_pred=[x[0] for x in told], score=[x[1] for x in told])

    others = "".join(f"{c} string, " for c in kept)
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", *kept).mapInPandas(
        run, f"doc_id string, {others}lang_pred string, score double").withColumn("doc_id", F.col("doc_id").cast("bigint"))


def identified(docs: DataFrame, filters: Filters, least_score: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language: not unknown, and with enough of the votes.

    Enough is ``least_score`` or, unless given, what the language's own training documents usually have.
    Rows are filtered where they are read, with all their columns; nothing is joined.
    """
    model = docs.sparkSession.sparkContext.broadcast(filters)

    # Python gets a hundred texts at a time and gives back decisions; the rows themselves stay with Spark.
    @F.udf("boolean", useArrow=False)
    def good(text: str | None) -> bool:
        name, share = model.value.predict(text)
        if name == UNKNOWN:
            return False
        return bool(share >= (model.value.least[model.value.languages.index(name)] if least_score is None else least_score))

    return docs.filter(good("text"))


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: trained on the training folds, applied to every row."""
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
