"""Benchmark decontamination over a positional inverted index of the training texts.

The index stores postings (term, document, position) of the terms that decide: the rarest of every
window of the test items, by their counts in all training texts.  Offset-adjusted lists meet where
position less item position is equal; windows all of whose rare terms meet there are candidates.  The
posting of a window's rarest term carries the words around it, which settle the other positions, so no
text is fetched again and lists of frequent terms are never stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import let, lower_ascii, settled, sifted, stored, words

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]"
WINDOW = 10
RARE = 3
LIST_FACTOR = 4  # lists longer than so many times a window's rarest are not fetched: the words around a posting settle them
FILTER_BITS = 1 << 20


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words; null has none."""
    return words(lower_ascii(text), SEPARATORS)


def member_filter(terms: DataFrame) -> Callable[[Column], Column]:
    """A test that all of ``terms`` pass and few others do.

    It is a bitmap of fixed size however many terms there are: more terms only let more others pass,
    which later joins on the term drop.
    """
    bit = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))
    rows = terms.select(F.shiftright(bit, 6).alias("at"), one.alias("b")).groupBy("at").agg(
        F.bit_or("b").alias("b")).collect()  # at most FILTER_BITS / 64 rows
    table = [0] * (FILTER_BITS // 64)
    for r in rows:
        table[r["at"]] = r["b"]
    bitmap = F.from_json(F.lit(str(table)), "array<bigint>")

    def test(word: Column) -> Column:
        return let(F.pmod(F.xxhash64(word), F.lit(FILTER_BITS)), lambda h: F.bit_get(
            F.get(bitmap, F.shiftright(h, 6).cast("int")), (h % 64).cast("int"))) == 1
    return test


def item_words(items: DataFrame) -> DataFrame:
    """item (own key), item_id, words of every item that has words and an id; repeated rows count once."""
    return stored(items.select(F.col("item_id"), words_of(F.col("text")).alias("words")).filter(
        "item_id is not null and size(words) > 0").distinct().withColumn("item", F.monotonically_increasing_id()), "leak-items")


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """term, n: occurrences of each test term in all training texts."""
    test = member_filter(vocabulary)
    seen = docs.select(F.explode(F.filter(words_of(F.col("text")), test)).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return vocabulary.join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def windows(items: DataFrame, counts: DataFrame, size: int = WINDOW, rare: int = RARE, factor: int | None = LIST_FACTOR) -> DataFrame:
    """Adds ``windows``: start and rarest positions (rarest first) of each; a shorter item is one window.

    Positions whose list is more than ``factor`` times as long as the rarest are left out; None keeps them.
    """
    ranked = items.select("item", F.posexplode("words").alias("ipos", "term")).join(counts, "term").groupBy("item").agg(
        F.array_sort(F.collect_list(F.struct("ipos", "n"))).alias("ns"))
    n = F.size("words")
    length = F.least(n, F.lit(size))
    def rarest(s: Column) -> Column:
        least = F.slice(F.array_sort(F.transform(F.slice("ns", s + 1, length), lambda x: F.struct(
            x["n"].alias("n"), x["ipos"].alias("ipos")))), F.lit(1), F.lit(rare))
        if factor is not None:
            least = let(least, lambda xs: F.filter(xs, lambda x: x["n"] <= F.get(xs, F.lit(0))["n"] * factor))
        return F.transform(least, lambda x: x["ipos"])

    picked = F.transform(F.sequence(F.lit(0), n - length), lambda s: F.struct(s.alias("start"), rarest(s).alias("rare")))
    return items.join(ranked, "item").withColumn("windows", picked).drop("ns")


def anchors(made: DataFrame) -> DataFrame:
    """term, item, ipos, rarest: the positions whose postings are needed; rarest where a window's first."""
    each = made.select("item", "words", F.explode("windows").alias("w")).select(
        "item", "words", F.posexplode("w.rare").alias("rank", "ipos"))
    return each.groupBy("item", "ipos").agg(
        F.any_value(F.get("words", F.col("ipos"))).alias("term"), F.bool_or(F.col("rank") == 0).alias("rarest"))


def build_index(docs: DataFrame, wanted: DataFrame, size: int = WINDOW) -> DataFrame:
    """row (own key), doc_id, text_hash, n_words, postings (term, pos, around) of the wanted terms; stored.

    ``around`` has the 2 * size - 1 words about a posting of a rarest term, null beyond the text.
    """
    needed = member_filter(wanted.select("term").distinct())
    rarest = member_filter(wanted.filter("rarest").select("term").distinct())
    reach = size - 1

    def postings(ws: Column) -> Column:
        at = F.filter(F.transform(ws, lambda w, i: F.struct(w.alias("term"), i.alias("pos"))), lambda x: needed(x["term"]))
        return F.transform(at, lambda x: F.struct(x["term"], x["pos"], F.when(rarest(x["term"]), F.transform(
            F.sequence(x["pos"] - reach, x["pos"] + reach), lambda p: F.get(ws, p))).alias("around")))

    made = let(words_of(F.col("text")), lambda ws: F.struct(F.size(ws).cast("bigint").alias("n_words"), postings(ws).alias("postings")))
    return stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), made.alias("m")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash", "m.n_words", "m.postings"), "leak-index")


def aligned(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Postings joined to the item positions of their term, with the shift between both."""
    return index.select("row", F.explode("postings").alias("p")).select("row", "p.term", "p.pos", "p.around").join(
        wanted, "term").select("row", "item", (F.col("pos") - F.col("ipos")).alias("shift"), "pos", "ipos",
                               F.when(F.col("rarest"), F.col("around")).alias("around"))


def phrase_matches(index: DataFrame, made: DataFrame, wanted: DataFrame, size: int = WINDOW) -> DataFrame:
    """row, item, shift, starts: windows (item positions) that occur word for word at shift + start."""
    met = aligned(index, wanted).groupBy("row", "item", "shift").agg(
        F.collect_set("ipos").alias("seen"),
        F.collect_list(F.when(F.col("around").isNotNull(), F.struct("ipos", "around"))).alias("near"))
    length, first = F.least(F.size("words"), F.lit(size)), lambda w: F.get(w["rare"], F.lit(0))

    def exact(w: Column) -> Column:
        around = F.get(F.filter("near", lambda x: x["ipos"] == first(w)), F.lit(0))["around"]
        return F.slice(around, w["start"] - first(w) + size, length) == F.slice("words", w["start"] + 1, length)

    candidates = F.filter("windows", lambda w: F.size(F.array_except(w["rare"], F.col("seen"))) == 0)
    return met.join(made.select("item", "item_id", "words", "windows"), "item").withColumn("windows", candidates).filter(
        F.size("windows") > 0).select("row", "item", "item_id", "shift", F.transform(F.filter("windows", exact), lambda w: w["start"])
                                      .alias("starts"), length.alias("length")).filter(F.size("starts") > 0)


def proximity_matches(index: DataFrame, made: DataFrame, wanted: DataFrame, span: int = 2 * WINDOW) -> DataFrame:
    """row, item_id, start: windows whose rare terms all occur, in any order, within ``span`` words.

    For an index prepared with factor None.  Postings are grouped by two adjacent stretches of ``span`` words, so no group exceeds them.
    """
    stretch = F.floor(F.col("pos") / span)
    near = aligned(index, wanted).select("row", "item", "pos", "ipos", F.explode(F.array(stretch, stretch - 1)).alias("stretch"))
    met = near.groupBy("row", "item", "stretch").agg(F.collect_list(F.struct("pos", "ipos")).alias("seen"))

    def close(w: Column) -> Column:
        return F.exists("seen", lambda x: F.forall(w["rare"], lambda r: F.exists("seen", lambda y: (
            (y["ipos"] == r) & (y["pos"] >= x["pos"]) & (y["pos"] < x["pos"] + span)))))
    return met.join(made.select("item", "item_id", "windows"), "item").select(
        "row", "item_id", F.explode(F.transform(F.filter("windows", close), lambda w: w["start"])).alias("start")).distinct()


def prepare(docs: DataFrame, items: DataFrame, factor: int | None = LIST_FACTOR) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index, items with windows, anchors)."""
    known = item_words(items)
    vocabulary = known.select(F.explode("words").alias("term")).distinct()
    made = stored(windows(known, term_counts(docs, vocabulary), factor=factor), "leak-windows")
    wanted = stored(anchors(made), "leak-anchors")
    return build_index(docs, wanted), made, wanted


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated for every document row.

    A word is hit inside any occurrence of an item's window.  Null and empty texts have no words;
    without items nothing is hit; repeated rows each have their result.
    """
    index, made, wanted = prepare(docs, items)
    hits = phrase_matches(index, made, wanted)
    places = F.flatten(F.transform("starts", lambda s: F.sequence(F.col("shift") + s, F.col("shift") + s + F.col("length") - 1)))
    found = hits.select("row", "item_id", F.array_distinct(places).alias("places")).groupBy("row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("bigint").alias("n_hit"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return index.select("row", "doc_id", "text_hash", "n_words").join(found, "row", "left").select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of a test item, with all their columns."""
    leaks = settled(lambda: find_leaks(docs, items).filter("contaminated").select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")).distinct(), "leaks")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_text_hash"))
    apart, met = sifted(docs, leaks, "_doc_id")
    return apart.unionByName(met.join(leaks, same, "left_anti"))
