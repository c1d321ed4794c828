"""The operators of this subpackage as named queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.llm import chat, decontamination, fingerprints, languages, neardup, packing, resampling, sharding, simhash, substrings, toxicity, urls, vector_codes
from winnowry.sources.tables import table

TOKENIZER = "word_bpe_49k.json"
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"

# Two regions of two racks of two shards; a ninth shard comes as a region of its own, so that rows only move into it.
SHARD_TREE = {"east": {"a": {0: 1.0, 1: 1.0}, "b": {2: 1.0, 3: 1.0}}, "west": {"c": {4: 1.0, 5: 1.0}, "d": {6: 1.0, 7: 1.0}}}
GROWN_TREE = SHARD_TREE | {"north": {"e": {8: 1.0}}}


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles agree to 85 hundredths."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), n=3, num=85, den=100)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels of the training folds."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark windows in every document."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def list_changes(pages: DataFrame) -> DataFrame:
    """A dated list derived from the pages: hosts come, go and return; some parent domains for a week."""
    hosts = pages.select("page_id", urls.host_of(F.col("url")).alias("host")).filter("host is not null").groupBy("host").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n"))
    day = F.col("first") % 365
    own = hosts.filter("first % 3 = 0").select(F.col("host").alias("entry"), F.explode(F.array(
        F.struct(day.alias("day"), F.lit(True).alias("listed")),
        F.struct((day + 30 + F.col("n") % 60).alias("day"), F.lit(False).alias("listed")),
        F.struct((day + 400).alias("day"), F.lit(True).alias("listed")))).alias("c"))
    parents = hosts.filter("first % 7 = 0 and host like '%.%'").select(
        F.expr("substring(host, locate('.', host) + 1)").alias("entry"), F.explode(F.array(
            F.struct((day + 100).alias("day"), F.lit(True).alias("listed")),
            F.struct((day + 107).alias("day"), F.lit(False).alias("listed")))).alias("c"))
    return own.unionByName(parents).select("entry", "c.day", "c.listed")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries that held on the day it was fetched."""
    pages = table(spark, sf_dir, "pages")
    captures = pages.select("page_id", urls.host_of(F.col("url")).alias("host"), (F.col("page_id") % 730).alias("day"))
    return urls.active_entries(captures, list_changes(pages)).select(
        "page_id", "host", F.col("day").alias("fetched_day"), "n_active", "active_entries",
        (F.col("n_active") > 0).alias("blocked"))


OP5_SQL = f"""
WITH captures AS (
    SELECT page_id, page_id % 730 AS day, nullif(regexp_extract(lower(url), '{urls.HOST}', 1), '') AS host FROM pages),
hosts AS (SELECT host, min(page_id) AS first, count(*) AS n FROM captures WHERE host IS NOT NULL GROUP BY host),
changes AS (
    SELECT host AS entry, first % 365 AS day, true AS listed FROM hosts WHERE first % 3 = 0
    UNION ALL SELECT host, first % 365 + 30 + n % 60, false FROM hosts WHERE first % 3 = 0
    UNION ALL SELECT host, first % 365 + 400, true FROM hosts WHERE first % 3 = 0
    UNION ALL SELECT substr(host, instr(host, '.') + 1), first % 365 + 100, true FROM hosts
        WHERE first % 7 = 0 AND host LIKE '%.%'
    UNION ALL SELECT substr(host, instr(host, '.') + 1), first % 365 + 107, false FROM hosts
        WHERE first % 7 = 0 AND host LIKE '%.%'),
daily AS (SELECT entry, day, bool_or(listed) AS listed FROM changes GROUP BY entry, day),
spans AS (SELECT entry, listed, day AS valid_from, lead(day) OVER (PARTITION BY entry ORDER BY day) AS valid_to FROM daily),
parts AS (SELECT host, string_split(host, '.') AS p FROM (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL)),
entries AS (SELECT host, array_to_string(p[i:], '.') AS entry FROM parts, unnest(range(1, len(p) + 1)) AS t(i)),
found AS (
    SELECT k.host, k.day, count(*) AS n, string_agg(e.entry, ',' ORDER BY e.entry) AS active
    FROM (SELECT DISTINCT host, day FROM captures) k JOIN entries e USING (host) JOIN spans s USING (entry)
    WHERE s.listed AND s.valid_from <= k.day AND (s.valid_to IS NULL OR k.day < s.valid_to) GROUP BY k.host, k.day)
SELECT c.page_id, c.host, c.day AS fetched_day, coalesce(f.n, 0) AS n_active, coalesce(f.active, '') AS active_entries,
    coalesce(f.n, 0) > 0 AS blocked
FROM captures c LEFT JOIN found f ON c.host = f.host AND c.day = f.day
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the training folds."""
    return languages.identify_documents(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of a hash tree, and in nine."""
    return sharding.shard_documents(
        table(spark, sf_dir, "documents"), sharding.tree(SHARD_TREE), sharding.tree(GROWN_TREE))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of every document that an earlier one has."""
    return substrings.repeated_passages(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    columns = ("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    made = chat.format_conversations(table(spark, sf_dir, "conversations").select(*columns).unionByName(planted.select(*columns)))
    read = made.select("conv_id", "layout", F.length("formatted").cast("bigint").alias("formatted_chars"),
                       chat.read_back(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars", "layout")


OP9_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
escaped AS (
    SELECT *, replace(replace(text, '~', '~0'), '<|', '<~1|') AS body,
        replace(replace(replace(role, '~', '~0'), '<|', '<~1|'), chr(10), '~2') AS head FROM turns),
told AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
        string_agg(role, ' ' ORDER BY turn, role, text) AS roles, bool_or(role IN ('human', 'gpt')) AS odd,
        sum(length(head) + length(body) + {len(chat.START) + len(chat.END) + 2})::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
    formatted_chars, CASE WHEN roles = 'user assistant' THEN 'prompt' WHEN roles = 'system user assistant' THEN 'instruction'
        WHEN n_turns % 2 = 1 AND NOT odd THEN 'shared' ELSE 'messages' END AS layout
FROM told
"""


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents, drawn towards the benchmark."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# CRC-32 of a word's UTF-8 bytes, bit by bit; words are few beside their occurrences.
CRC32_SQL = """
xor(list_reduce(list_concat([4294967295::BIGINT],
        list_transform(range(0, octet_length(encode(w))), lambda i: ('0x' || substr(hex(w), 2 * i + 1, 2))::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

OP11_SQL = f"""
WITH both_tables AS (
    SELECT true AS aimed, NULL::BIGINT AS doc_id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents),
split AS (
    SELECT aimed, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM both_tables),
runs AS (SELECT aimed, doc_id, unnest(ws) AS w FROM split),
hashed AS (SELECT w, ({CRC32_SQL}) % 10000 AS bucket FROM (SELECT DISTINCT w FROM runs)),
found AS (SELECT aimed, doc_id, bucket FROM runs JOIN hashed USING (w)),
shares AS (SELECT bucket, count(*) FILTER (NOT aimed) AS s, count(*) FILTER (aimed) AS t FROM found GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS ss, sum(t)::DOUBLE AS tt FROM shares),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS gain FROM shares, totals),
means AS (SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight FROM found JOIN gains USING (bucket) WHERE NOT aimed GROUP BY doc_id),
scored AS (
    SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM split LEFT JOIN means USING (doc_id) WHERE NOT aimed),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight-part codes of all vectors, and the errors they leave."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def lloyd_sql(rounds: int = vector_codes.ROUNDS, parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES) -> str:
    """The same codes by comparing every part with every entry, round by round."""
    def assign(k: int) -> str:
        return f"""
near{k} AS MATERIALIZED (
    SELECT vec_id, part, min(struct_pack(d := d, entry := entry)) AS best FROM (
        SELECT vec_id, part, entry, sum((x - v) * (x - v))::BIGINT AS d FROM comps JOIN book{k} USING (part, place) GROUP BY vec_id, part, entry)
    GROUP BY vec_id, part)"""

    def replace(k: int) -> str:
        return f"""
book{k + 1} AS MATERIALIZED (
    SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, v)::BIGINT AS v FROM book{k} LEFT JOIN (
        SELECT part, best.entry AS entry, place, sum(x)::BIGINT AS s, count(*) AS n FROM near{k} JOIN comps USING (vec_id, part)
        GROUP BY ALL) USING (part, entry, place))"""

    steps = ",".join(step for k in range(rounds) for step in (assign(k), replace(k)))
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda c: floor(c::DOUBLE * {vector_codes.SCALE})::BIGINT) AS xs FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
spots AS (SELECT unnest(range(0, (SELECT max(len(xs)) FROM kept))) AS i),
comps AS MATERIALIZED (
    SELECT vec_id, i * {parts} // len(xs) AS part, i % (len(xs) // {parts}) AS place, xs[i + 1] AS x FROM kept, spots),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}),
book0 AS MATERIALIZED (SELECT part, entry, place, x AS v FROM first JOIN comps USING (vec_id)),{steps},{assign(rounds)},
coded AS (
    SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
    (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose SimHash fingerprints differ in four bits at most."""
    return simhash.simhash_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_url_filters": op5_url_filters,
    "op6_language_id": op6_language_id,
    "op7_sharding": op7_sharding,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_vector_codes": op12_vector_codes,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}
SQL: dict[str, str] = {
    "op5_url_filters": OP5_SQL, "op9_chat_formatting": OP9_SQL, "op11_importance_resampling": OP11_SQL, "op12_vector_codes": lloyd_sql()}
