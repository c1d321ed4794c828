import numpy as np
from pyspark.sql import functions as F

from winnowry.llm import languages, toxicity
from winnowry.llm.common import held_out


def test_language_of_held_out_documents(documents):
    got = languages.identify_documents(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == documents.count()
    tested = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in tested) / len(tested) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_documents(odd_docs, documents):
    filters = languages.train(documents)
    got = {r["doc_id"]: r for r in languages.identify(odd_docs, filters).collect()}
    assert [got[i]["lang_pred"] for i in (2, 3, 4, 7)] == ["und"] * 4 and got[2]["score"] == 0
    assert got[6]["lang_pred"] in filters.languages and got[5]["lang_pred"] in filters.languages
    assert languages.identify(odd_docs.limit(0), filters).count() == 0
    kept = languages.identified(odd_docs, filters, 0.0)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, None, 5, 6, 8}


def test_no_training_rows(odd_docs):
    nothing = languages.train(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in languages.identify(odd_docs, nothing).collect()} == {"und"}


def test_long_texts_vote_block_by_block(documents, monkeypatch):
    filters = languages.train(documents)
    text = languages.letters_of("der die das und nicht " * 400)
    whole = filters.votes(text)
    monkeypatch.setattr(languages, "MAX_GRAM_CHARS", 100)
    split = filters.votes(text)
    assert abs(split[1] - whole[1]) / whole[1] < 0.05 and split[0].argmax() == whole[0].argmax()


def test_folds(spark):
    got = spark.range(2000).select(held_out(F.col("id")).alias("h")).groupBy("h").count().collect()
    assert {r["h"]: r["count"] > 300 for r in got} == {True: True, False: True}
    import zlib
    assert all((zlib.crc32(str(r["id"]).encode()) % 5 == 0) == r["h"] for r in
               spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect())


def test_pairs_count_beyond_their_terms(spark):
    """Neither an insult nor a mention alone is toxic; only the pair is.  No additive weights can tell."""
    rows, labels = [], []
    for i in range(1500):
        a, b = i % 2, i // 2 % 2
        rows.append((i, " ".join(["plain", "words", f"n{i % 7}"] + ["insult"] * a + ["mention"] * b)))
        labels.append((i, int(a and b)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    truth = dict(labels)
    assert all(r["predicted"] == truth[r["doc_id"]] for r in got if r["held_out"])


def test_toxicity_of_odd_documents(spark, odd_docs, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.train(documents, labels)
    got = toxicity.score(odd_docs, machine).collect()
    assert len(got) == 10 and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (2, 3, 4, 7)}
    assert len(empty) == 1
    assert toxicity.score_documents(odd_docs.limit(0), labels).count() == 0
    assert toxicity.score_documents(odd_docs, labels.limit(0)).count() == 10


def test_many_rare_names_tell_in_pairs_alone(spark):
    """Insults with one of 200 names, and praise with one of 200 things, are toxic; no word tells anything alone."""
    import random
    rng, rows, labels = random.Random(6), [], []
    for i in range(6000):
        insult, name = rng.random() < 0.5, rng.random() < 0.5
        second = ("name" if name else "thing") + "".join(chr(97 + int(d)) for d in str(rng.randrange(200)))
        rows.append((i, " ".join(["plain", "words", "insult" if insult else "praise", second])))
        labels.append((i, int(insult == name)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    truth, tested = dict(labels), [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in tested) / len(tested) > 0.97


def test_score_is_the_sum_over_all_pairs(documents, spark, sf_dir):
    """The score of a text by adding up every weight and every pair of factors."""
    import math
    machine = toxicity.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = [r["text"] for r in documents.select("text").limit(200).collect()]
    known = {int(s): k for k, s in enumerate(machine.slots)}
    for text in [*texts, "", None]:
        at = [known[s] for s in toxicity.slots_of(text) if s in known][:120]
        total = machine.bias + sum(float(machine.weights[i]) for i in at)
        total += sum(float(machine.factors[i] @ machine.factors[j]) for k, i in enumerate(at) for j in at[:k]) / max(1, len(at))
        class Cut(toxicity.Machine):
            def features(self, slots, at=at):
                return np.array(at, dtype=np.int64)
        cut = Cut(machine.slots, machine.bias, machine.weights, machine.factors)
        assert abs(cut.score(text) - 1 / (1 + math.exp(-total))) < 1e-5


def test_held_out_documents_rank_by_toxicity(spark):
    """Most planted toxic documents score above clean ones of other folds."""
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = toxicity.score_documents(docs, labels).join(labels, "doc_id").filter("held_out").select("score", "toxic", "predicted").collect()
    up, down = np.array([r["score"] for r in got if r["toxic"] == 1]), np.array([r["score"] for r in got if r["toxic"] == 0])
    assert ((up[:, None] > down).mean() + (up[:, None] == down).mean() / 2) > 0.97
    assert sum(r["predicted"] == r["toxic"] for r in got) / len(got) > 0.96


def invented(rng, letters, spaced, size):
    """A text of one invented language: its letters by falling frequency, in words or without spaces."""
    word = lambda: "".join(letters[min(int(rng.expovariate(6 / len(letters))), len(letters) - 1)] for _ in range(rng.randint(1, 7)))
    return (" " if spaced else "").join(word() for _ in range(size))


def test_many_languages_and_scripts(spark):
    """Seventy languages of their own letters, two of them without spaces and with large alphabets."""
    import random
    rng, rows = random.Random(5), []
    tongues = {f"l{k:02d}": ([chr(c) for c in rng.sample(range(ord("a"), ord("z") + 1), 9)], True) for k in range(68)}
    tongues |= {"han": ([chr(0x4E00 + 3 * i) for i in range(3000)], False), "thai": ([chr(c) for c in [*range(0x0E01, 0x0E2F), 0x0E30, 0x0E32, 0x0E40, 0x0E41]], False)}
    for name, (letters, spaced) in tongues.items():
        rows += [(len(rows) + i, invented(rng, letters, spaced, rng.randint(40, 80)), name) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    filters = languages.train(docs)
    assert len(filters.languages) == 70
    got = {r["doc_id"]: r for r in languages.identify(docs, filters).collect()}
    tested = [(i, name) for i, _, name in rows if got[i]["lang_pred"]]
    for group in (("han",), ("thai",), tuple(tongues)):
        own = [got[i]["lang_pred"] == name for i, name in tested if name in group]
        assert sum(own) / len(own) > 0.97
    assert languages.identified(docs, filters).count() >= 0.99 * len(rows)
    other = spark.createDataFrame([(1, "\u05d0\u05d1\u05d2 \u05d3\u05d4\u05d5 " * 20)], "doc_id bigint, text string")
    assert languages.identified(other, filters).count() == 0


def test_number_signs_are_no_letters(spark, documents):
    filters = languages.train(documents)
    assert [filters.predict(t)[0] for t in ("\u00bd \u00b2 \u2167", "12 \u0663", "_ \u00b3_")] == ["und"] * 3
    assert languages.letters_of("x\u00b2 A1b") == " x a b " and filters.predict("x\u00b2")[0] != "und"


def test_filters_vote_like_plain_sets(documents):
    """The same n-grams in one set for each language, instead of slots and corrections."""
    filters = languages.train(documents)
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang").collect()]
    learn = [r for r in rows if r[1] is not None and r[2] is not None and __import__("zlib").crc32(str(r[0]).encode()) % 5]
    sets = {}
    for name in filters.languages:
        own = [set(languages.gram_codes(languages.letters_of(t)).tolist()) for _, t, lang in learn if lang == name]
        counts = {}
        for s in own:
            for c in s:
                counts[c] = counts.get(c, 0) + 1
        sets[name] = {c for c, n in counts.items() if n >= max(1.0, languages.MIN_SHARE * len(own))}
    agreed = 0
    for _, text, _ in rows:
        codes = languages.gram_codes(languages.letters_of(text)).tolist()
        votes = {name: sum(c in s for c in codes) for name, s in sets.items()}
        best = max(sorted(votes), key=votes.get)
        name, share = filters.predict(text)
        agreed += (name == "und" and not languages.letters_of(text)) or (name == best and abs(share - votes[best] / len(codes)) < 0.02)
    assert agreed >= 0.99 * len(rows)
