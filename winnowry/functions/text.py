"""Text rules as Column -> Column functions.

Regex classes are written so that Java matches what Unicode-aware ``\\s`` and
``\\w`` mean elsewhere: ``(?U)`` switches on Unicode classes and the four
information separators are added by hand.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry import fixed_values as fv

SPACE = r"[\s\x1c-\x1f]"


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` computed a single time, also inside lambdas, where Spark shares no expression."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def is_blank(c: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return ~F.coalesce(c.rlike(rf"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def normalize_text(c: Column, max_chars: int = fv.MAX_CHARS) -> Column:
    """Trim, collapse whitespace, shorten runs of five or more equal characters to three, cut."""
    collapsed = F.trim(F.regexp_replace(c, rf"(?U){SPACE}+", " "))
    shortened = F.regexp_replace(collapsed, r"(.)\1{4,}", "$1$1$1")
    return F.substring(shortened, 1, max_chars)


def char_counts(c: Column) -> Column:
    """Array of (char, n), row-local: equal characters of the sorted text form one run each."""
    sorted_text = F.array_join(F.sort_array(F.split(c, "")), "")
    runs = F.regexp_extract_all(sorted_text, F.lit(r"(?s)(.)\1*+"), F.lit(0))
    return F.transform(
        F.coalesce(runs, F.array().cast("array<string>")),
        lambda r: F.struct(F.substring(r, 1, 1).alias("char"), F.length(r).cast("bigint").alias("n")))


@F.arrow_udf(T.DoubleType())
def _entropies(texts: pa.Array) -> pa.Array:
    """Each text alone is looked at as code points, so a batch needs little more than its own bytes."""
    def entropy(text: bytes | None) -> float:
        points = np.frombuffer((text or b"").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        if len(points) < 10:
            return 0.0
        counts = np.bincount(points) if points.max() < 1 << 16 else np.unique(points, return_counts=True)[1]
        k = counts[counts > 0].astype(np.float64)
        if len(k) == 1:
            return 0.0
        return float((np.log2(len(points)) - np.sum(k * np.log2(k)) / len(points)) / np.log2(min(len(k), 256)))

    return pa.array([entropy(t.as_py()) for t in texts.cast(pa.binary())], pa.float64())


def char_entropy(c: Column) -> Column:
    """Shannon entropy of the characters over log2(min(distinct, 256)); 0 below ten characters and for null.

    Row-local on purpose: nothing is exploded, sorted or shuffled.  It is computed for every row, also
    inside a condition: make the text null where it is not wanted.
    """
    return _entropies(c)


def contains_any(c: Column, words: tuple) -> Column:
    """Case-insensitive substring hit of any plain word."""
    def hit(low: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w.lower())) for w in words], F.lit(False))

    return F.coalesce(once(F.lower(c), hit), F.lit(False))


def is_toxic(c: Column, words: tuple = fv.TOXIC_WORDS) -> Column:
    return contains_any(c, words)


def long_enough(c: Column, min_chars: int = fv.MIN_FIELD_CHARS) -> Column:
    return F.coalesce(F.length(strip(c)) >= min_chars, F.lit(False))


def valid_format(instruction: Column, response: Column, min_chars: int = fv.MIN_FIELD_CHARS) -> Column:
    return long_enough(instruction, min_chars) & long_enough(response, min_chars)


def code_chunk(code: Column, limit: int = fv.CODE_CHUNK_CHARS, suffix: str = fv.CODE_CHUNK_SUFFIX) -> Column:
    return F.when(F.length(code) > limit, F.concat(F.substring(code, 1, limit), F.lit(suffix))).otherwise(code)


def context_prefix(text: Column, limit: int = fv.CONTEXT_CHARS) -> Column:
    return F.substring(text, 1, limit)


def content_key(instruction: Column, response: Column) -> Column:
    empty = F.lit("")
    return F.sha2(F.concat(F.coalesce(instruction, empty), F.coalesce(response, empty)), 256)


def sample_key(path: Column, tag: Column) -> Column:
    return F.sha1(F.concat(path, tag))


def token_estimate(*parts: Column) -> Column:
    """Sum of len // 4, floored part by part."""
    return reduce(lambda a, b: a + b, [F.floor(F.length(p) / 4) for p in parts])


def sft_text(instruction: Column, context: Column, response: Column, eos: str = fv.EOS_TOKEN) -> Column:
    """Training text; empty when instruction or response is empty."""
    ins, ctx, res = (strip(F.coalesce(c, F.lit(""))) for c in (instruction, context, response))
    body = F.concat(F.lit("### Instruction:\n"), ins, F.lit(f"\n\n{fv.RESPONSE_MARKER}\n"), res)
    text = F.when(ctx != "", F.concat(F.lit("### Context:\n"), ctx, F.lit("\n\n"), body)).otherwise(body)
    closed = F.when(F.endswith(text, F.lit(eos)), text).otherwise(F.concat(text, F.lit(eos)))
    return F.when((ins == "") | (res == ""), F.lit("")).otherwise(closed)


def extract_response(text: Column, marker: str = fv.RESPONSE_MARKER) -> Column:
    """The part between the first and second marker, trimmed; the text itself without a marker."""
    parts = F.split(text, rf"\Q{marker}\E")
    return F.when(F.contains(text, F.lit(marker)), strip(F.get(parts, F.lit(1)))).otherwise(text)


def strip_ansi(c: Column) -> Column:
    return F.regexp_replace(c, fv.ANSI_PATTERN, "")


# What a text must contain, in lower case, for a rule to match: one of these.
NEEDED = dict(zip((p for p, _ in fv.SECRET_PATTERNS), (
    ("ghp_",), ("glpat-",), ("sk-",), ("bearer",), ("key",), ("akia",), ("private",), ("openssh",),
    ("openai_api_key=", "github_token=", "gitlab_token=", "aws_secret="), ("token",)), strict=True))
NEEDED |= dict(zip((p for _, p in fv.LANGUAGE_PATTERNS), (
    ("def ", "class ", "import ", "from ", "if __name__", "print(", "#"),
    ("function", "const", "let", "var", "=>", "console.", "require("),
    ("interface", "type", "as", "namespace", "declare", "abstract"),
    ("#include", "int main", "std::", "cout", "cin", "->"),
    ("public class", "private", "protected", "static void", "system.out"),
    ("func ", "package ", "import (", "fmt."),
    ("fn ", "use ", "mut ", "impl ", "let ", "match")), strict=True))
UNUSUAL = "\u017f\u212a\u0130\u0131"  # letters that patterns without case also take for s, k and i


def may_match(folded: Column, pattern: str) -> Column:
    """Whether a rule's fixed part occurs; true for rules that are not known."""
    return reduce(lambda a, b: a | b, (F.contains(folded, F.lit(w)) for w in NEEDED[pattern])) if pattern in NEEDED else F.lit(True)


def searchable(c: Column) -> Column:
    """A text, its lower case, and whether it has letters by which lower case may hide a match."""
    unusual = reduce(lambda a, b: a | b, (F.contains(c, F.lit(letter)) for letter in UNUSUAL))
    return F.struct(c.alias("text"), F.lower(c).alias("folded"), unusual.alias("unusual"))


def redact_secrets(c: Column, patterns: tuple = fv.SECRET_PATTERNS) -> Column:
    """Every rule in order over what the rules before it left; one whose fixed part is absent there costs no search."""
    def applied(pattern: str, name: str) -> Callable[[Column], Column]:
        def rule(s: Column) -> Column:
            replaced = F.regexp_replace(s["text"], "(?iU)" + pattern, name)
            return F.when(s["unusual"] | may_match(s["folded"], pattern), once(replaced, searchable)).otherwise(s)
        return rule

    state = once(strip_ansi(c), searchable)
    for pattern, name in patterns:
        state = once(state, applied(pattern, name))
    return state["text"]


def secret_hits(c: Column, patterns: tuple = fv.SECRET_PATTERNS) -> Column:
    """Placeholders of the rules whose pattern occurs in the text, in rule order."""
    def hits(s: Column) -> Column:
        flags = [F.when((s["unusual"] | may_match(s["folded"], p)) & s["text"].rlike("(?iU)" + p), F.lit(name)) for p, name in patterns]
        return F.array_compact(F.array(*flags))

    return once(once(strip_ansi(c), searchable), hits)


def truncate(c: Column, limit: int) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit("..."))).otherwise(c)


def sanitize(c: Column, limit: int = fv.MAX_MESSAGE_LENGTH) -> Column:
    return once(redact_secrets(c), lambda v: truncate(v, limit))


def sanitize_map(c: Column, limit: int = fv.MAX_DELTA_LENGTH) -> Column:
    return F.transform_values(c, lambda _, v: sanitize(v, limit))


def sanitize_array(c: Column, limit: int = fv.MAX_MESSAGE_LENGTH) -> Column:
    return F.transform(c, lambda v: sanitize(v, limit))


def truncate_paths(c: Column, limit: int = fv.MAX_PATH_LENGTH) -> Column:
    return F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda v: truncate(v, limit))


def safe_int(c: Column, default: int) -> Column:
    return F.coalesce(strip(c).try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_bool(c: Column, default: bool) -> Column:
    word = F.lower(strip(c))
    return (
        F.when(word.isin(*fv.TRUE_WORDS), F.lit(True))
        .when(word.isin(*fv.FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default))
    )
