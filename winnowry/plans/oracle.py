"""SQL building blocks shared by the reference statements of the queries."""

from __future__ import annotations

from winnowry import fixed_values as fv
from winnowry.sources.tables import CALL_MODELS, FILE_SUFFIXES


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows: tuple) -> str:
    def one(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return quote(v)
        if isinstance(v, tuple):
            return "[" + ", ".join(one(x) for x in v) + "]"
        return repr(v)
    return ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)


SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{SPACES}+', ''), '{SPACES}+$', '')"


SAMPLES = """
samples AS (
  SELECT d.doc_id AS pos, split_part(d.text, chr(10), 1) AS instruction, d.source AS context, d.text AS response,
         coalesce(CAST(l.quality AS DOUBLE), 0.0) AS base
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""


def _shorten(field: str) -> str:
    """Runs of five or more equal characters keep three: gaps and islands over characters."""
    return f"""
{field}_chars AS (
  SELECT pos, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS i
  FROM (SELECT pos, trim(regexp_replace({field}, '{SPACES}+', ' ', 'g')) AS t FROM samples)
),
{field}_islands AS (
  SELECT pos, c, i, i - row_number() OVER (PARTITION BY pos, c ORDER BY i) AS island FROM {field}_chars
),
{field}_sized AS (
  SELECT pos, c, i, count(*) OVER (PARTITION BY pos, c, island) AS n,
         i - min(i) OVER (PARTITION BY pos, c, island) AS k
  FROM {field}_islands
),
{field}_norm AS (
  SELECT pos, left(string_agg(c, '' ORDER BY i), {fv.MAX_CHARS}) AS v
  FROM {field}_sized WHERE n < 5 OR k < 3 GROUP BY pos
)"""


NORMALIZED = SAMPLES + "," + _shorten("instruction") + "," + _shorten("response") + f""",
norm AS MATERIALIZED (
  SELECT s.pos, coalesce(i.v, '') AS instruction,
         left(trim(regexp_replace(s.context, '{SPACES}+', ' ', 'g')), {fv.MAX_CHARS}) AS context,
         coalesce(r.v, '') AS response, s.base
  FROM samples s LEFT JOIN instruction_norm i ON i.pos = s.pos LEFT JOIN response_norm r ON r.pos = s.pos
)"""

DEDUPED = NORMALIZED + """,
deduped AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, sha256(instruction || response) AS content_key,
           row_number() OVER (PARTITION BY sha256(instruction || response) ORDER BY pos) AS copy
    FROM norm
  ) WHERE copy = 1
)"""


def entropy_of(table: str) -> str:
    return f"""
ent_chars AS (SELECT pos, unnest(string_split(response, '')) AS c FROM {table}),
ent_counts AS (SELECT pos, c, count(*) AS k FROM ent_chars GROUP BY pos, c),
entropies AS MATERIALIZED (
  SELECT t.pos, CASE WHEN coalesce(e.n, 0) >= 10 AND e.d > 1
                THEN (log2(e.n) - e.s / e.n) / log2(least(e.d, 256)) ELSE 0.0 END AS entropy
  FROM {table} t LEFT JOIN (
    SELECT pos, sum(k) AS n, count(*) AS d, sum(k * log2(k)) AS s FROM ent_counts GROUP BY pos
  ) e ON e.pos = t.pos
)"""


def language_of(x: str) -> str:
    """First pattern with the highest count.  Letters outside ASCII count as word characters."""
    word = f"regexp_replace({x}, '[^\\x00-\\x7F]', 'z', 'g')"
    counts = [f"len(regexp_extract_all({word}, {quote('(?i)' + p)}))" for _, p in fv.LANGUAGE_PATTERNS]
    names = "[" + ", ".join(quote(n) for n, _ in fv.LANGUAGE_PATTERNS) + "]"
    inner = "[" + ", ".join(counts) + "]"
    return (f"(SELECT CASE WHEN list_max(cs) > 0 THEN {names}[list_position(cs, list_max(cs))] "
            f"ELSE 'unknown' END FROM (SELECT {inner} AS cs))")


def languages_of(table: str) -> str:
    return f"languages AS MATERIALIZED (SELECT pos, {language_of('response')} AS language FROM {table})"


def quality_of(table: str) -> str:
    return f"""
qualities AS MATERIALIZED (
  SELECT t.pos, least(1.0, t.base * 0.3 + least(length(t.response) / 500.0, 1.0) * 0.2 + e.entropy * 0.2
         + least(length(t.instruction) / 200.0, 1.0) * 0.1
         + CASE WHEN coalesce(t.context, '') <> '' THEN 0.1 ELSE 0.0 END
         + CASE WHEN l.language <> 'unknown' THEN 0.1 ELSE 0.0 END) AS quality
  FROM {table} t JOIN entropies e ON e.pos = t.pos JOIN languages l ON l.pos = t.pos
)"""


TOXIC = "(" + " OR ".join(f"contains(lower(response), {quote(w)})" for w in fv.TOXIC_WORDS) + ")"
VALID = (f"(length({strip('instruction')}) >= {fv.MIN_FIELD_CHARS} "
         f"AND length({strip('response')}) >= {fv.MIN_FIELD_CHARS})")

JUDGED = DEDUPED + "," + entropy_of("deduped") + "," + languages_of("deduped") + "," + quality_of("deduped") + f""",
judged AS MATERIALIZED (
  SELECT d.pos, d.instruction, d.context, d.response, d.content_key, e.entropy, l.language, q.quality,
    CASE WHEN NOT {VALID} THEN 'format'
         WHEN {TOXIC} THEN 'toxic'
         WHEN length(instruction) + length(response) < {fv.MIN_CHARS}
           OR length(instruction) + length(response) > {fv.MAX_CHARS} THEN 'length'
         WHEN q.quality < {fv.MIN_QUALITY_SCORE} THEN 'quality'
         WHEN e.entropy < {fv.MIN_ENTROPY} THEN 'entropy' END AS reject_reason
  FROM deduped d JOIN entropies e ON e.pos = d.pos JOIN languages l ON l.pos = d.pos
  JOIN qualities q ON q.pos = d.pos
)"""


def balanced(per_language: int) -> str:
    return f"""
balanced AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY language ORDER BY quality DESC, pos) AS place
    FROM judged WHERE reject_reason IS NULL
  ) WHERE place <= {per_language}
)"""


PAIRS = """
pairs AS (
  SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS response,
         coalesce((SELECT arg_min(s.text, s.turn) FROM conversations s
                   WHERE s.conv_id = u.conv_id AND s.role = 'system'), '') AS context
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
)"""

_SUFFIX = "[" + ", ".join(quote(s) for s in FILE_SUFFIXES) + "]"
FILES = f"""
files AS (
  SELECT doc_id, 'data/ai-lab/repos/' || source || CASE WHEN doc_id % 7 = 0 THEN '/tests' ELSE '' END
         || '/f' || doc_id || ({_SUFFIX})[doc_id % 5 + 1] AS path, text
  FROM documents
)"""

REPOS = """
repos AS (
  SELECT p_partkey AS repo_id, p_name || p_partkey AS name,
         'https://example.org/' || replace(p_name, ' ', '/') || '-' || p_partkey || '.git' AS url,
         p_brand AS language, CAST(p_size AS BIGINT) AS stars, CAST(trunc(p_retailprice) AS BIGINT) AS forks
  FROM part
)"""


def calls(models: tuple = CALL_MODELS) -> str:
    names = "[" + ", ".join(quote(m) for m in models) + "]"
    return f"""
calls AS (
  SELECT l_returnflag AS provider, ({names})[l_linenumber % 4 + 1] AS model,
         CAST(trunc(l_quantity) AS BIGINT) * 100 AS prompt_tokens,
         CAST(trunc(l_extendedprice) AS BIGINT) AS completion_tokens, l_discount < 0.08 AS success
  FROM lineitem
)"""


_MODELS = "[" + ", ".join(quote(m) for m in CALL_MODELS) + "]"
EVENTS = f"""
ev AS (
  SELECT event_id AS pos, user_id AS run_id, ts,
         CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'warn'
              ELSE 'info' END AS level,
         event_type AS stage, event_type, event_type || ' ' || props AS message, k, value,
         CASE WHEN k % 5 <> 4 THEN ({_MODELS})[k % 5 + 1] END AS model
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
)"""

UPDATES = """
updates AS (
  SELECT user_id AS run_id, event_id AS pos, ts,
         ((event_id // 150) * 3 + CAST(json_extract(props, '$.k') AS BIGINT) % 5) % 40 AS seq
  FROM events
)"""

REPLAYED = UPDATES + f""",
numbered AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY pos) AS rn FROM updates),
walk AS (
  SELECT run_id, rn, pos, ts, seq, CAST(NULL AS BIGINT) AS last_before, false AS restarted, true AS accepted,
         seq AS last, ts AS last_ts, CAST(NULL AS TIMESTAMP) AS last_ts_before
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.run_id, n.rn, n.pos, n.ts, n.seq, w.last, n.seq < w.last - {fv.RESTART_GAP},
         n.seq > w.last OR n.seq < w.last - {fv.RESTART_GAP},
         CASE WHEN n.seq > w.last OR n.seq < w.last - {fv.RESTART_GAP} THEN n.seq ELSE w.last END,
         CASE WHEN n.seq > w.last OR n.seq < w.last - {fv.RESTART_GAP} THEN n.ts ELSE w.last_ts END, w.last_ts
  FROM walk w JOIN numbered n ON n.run_id = w.run_id AND n.rn = w.rn + 1
)"""

REPORTED = UPDATES + f""",
numbered AS (SELECT *, pos % 11 <> 0 AS own, row_number() OVER (PARTITION BY run_id ORDER BY pos) AS rn FROM updates),
walk AS (
  SELECT run_id, rn, pos, ts, seq, own, false AS restarted, true AS accepted, seq AS last, ts AS last_ts, CAST(NULL AS TIMESTAMP) AS last_ts_before
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.run_id, n.rn, n.pos, n.ts, n.seq, n.own, n.own AND n.seq < w.last - {fv.RESTART_GAP},
         n.seq > w.last OR (n.own AND n.seq < w.last - {fv.RESTART_GAP}),
         CASE WHEN n.seq > w.last OR (n.own AND n.seq < w.last - {fv.RESTART_GAP}) THEN n.seq ELSE w.last END,
         CASE WHEN n.seq > w.last OR (n.own AND n.seq < w.last - {fv.RESTART_GAP}) THEN n.ts ELSE w.last_ts END, w.last_ts
  FROM walk w JOIN numbered n ON n.run_id = w.run_id AND n.rn = w.rn + 1
)"""

CHECKS = """
checks AS (
  SELECT CAST(day(ts) AS BIGINT) AS round,
         CASE event_type WHEN 'click' THEN 'python' WHEN 'view' THEN 'cpp' ELSE 'instruction' END AS category,
         value >= 50 AS passed
  FROM events
)"""

_WORDS = "list_filter(string_split_regex(text, '[ \\n]+'), lambda w: w <> '')"
TASKS = f"""
tasks AS (
  SELECT item_id AS task_id, words[1] AS expected, words[1:4] AS keywords
  FROM (SELECT item_id, {_WORDS} AS words FROM benchmark)
),
answers AS (
  SELECT d.doc_id AS pos, d.text AS response, t.expected, t.keywords
  FROM documents d JOIN tasks t ON t.task_id = d.doc_id % (SELECT count(*) FROM benchmark)
)"""
