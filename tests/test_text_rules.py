"""Scalar rules on hand-built rows, against plain restatements of each rule."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.functions import evaluation, languages, repos, scoring, status, text


def evaluate(spark, values, column, schema="x string"):
    """``column`` over single values, in order."""
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"_i int, {schema}")
    return [r[0] for r in df.orderBy("_i").select(column).collect()]


def plain_normal(x):
    if x is None:
        return None
    words = re.sub(r"\s+", " ", x.strip())
    return re.sub(r"(.)\1{4,}", lambda m: m.group(1) * 3, words)[:8000]


NORMAL_ROWS = [
    "aaaa", "aaaaa", "aaaaaa b", "  a　b\x1cc\x1fd\x85e\xa0f ", "x" * 4 + "ab" * 4100, "ab " * 4000, None, "",
    "\U0001f600" * 6 + "z", "-----=====", "a\n\n\tb", "​keep", "12345" * 1700,
]


def test_normalize(spark):
    assert evaluate(spark, NORMAL_ROWS, text.normalize_text(F.col("x"))) == [plain_normal(v) for v in NORMAL_ROWS]


def plain_entropy(x):
    if not x or len(x) < 10:
        return 0.0
    n, counts = len(x), Counter(x)
    if len(counts) == 1:
        return 0.0
    bits = sum(-k / n * math.log2(k / n) for k in counts.values())
    return bits / math.log2(min(len(counts), 256))


def test_entropy(spark):
    rows = [None, "", "abcdefghi", "a" * 10, "ab" * 8, "".join(chr(0x100 + i) for i in range(400)),
            "\U0001f600\U0001f601" * 9, "The quick brown fox. " * 300, "a" * 8000, "\n\t " * 10, "aAbB" * 4]
    got = evaluate(spark, rows, text.char_entropy(F.col("x")))
    assert got == pytest.approx([plain_entropy(v) for v in rows], abs=1e-12)
    assert got[5] > 1.0


def test_char_counts(spark):
    got = evaluate(spark, ["abca", ""], text.char_counts(F.col("x")))
    assert [{r.char: r.n for r in g} for g in got] == [{"a": 2, "b": 1, "c": 1}, {}]


def plain_language(x):
    scores = [(len(re.findall(p, x, re.IGNORECASE)), -i, n) for i, (n, p) in enumerate(fv.LANGUAGE_PATTERNS)]
    best = max(scores)
    return best[2] if best[0] else "unknown"


def test_detect_language(spark):
    rows = ["def f import const let", "IMPORT DEF CLASS ", "édef g", "nothing here", "", "fn use let mut match impl",
            "func package fmt.x", "let x => console.log", "a->b std::cout", "private static void",
            "interface type as declare", "x #include", "#include <a>"]
    assert evaluate(spark, rows, languages.detect_language(F.col("x"))) == [plain_language(r) for r in rows]


def test_toxic_is_a_substring_rule(spark):
    rows = ["a soldier", "HATEFUL", "kind words", "", None]
    assert evaluate(spark, rows, text.is_toxic(F.col("x"))) == [True, True, False, False, False]


def test_valid_format(spark):
    rows = [("1234567890", "1234567890"), ("123456789 ", "1234567890"), (None, "1234567890"), ("1234567890", "　" * 20)]
    got = evaluate(spark, rows, text.valid_format(F.col("a"), F.col("b")), "a string, b string")
    assert got == [True, False, False, False]


def test_quality_score(spark):
    rows = [(1.0, "i" * 300, "c", "r" * 600, 1.0, "python"), (None, "i" * 20, "", "r" * 50, 0.5, "unknown"),
            (0.5, "i" * 100, None, "r" * 250, 0.25, "go")]
    want = [min(1.0, .3 + .2 + .2 + .1 + .1 + .1), .2 * .1 + .1 + .01, .15 + .1 + .05 + .05 + .1]
    col = scoring.quality_score(*[F.col(c) for c in ("b", "i", "c", "r", "e", "l")])
    got = evaluate(spark, rows, col, "b double, i string, c string, r string, e double, l string")
    assert got == pytest.approx(want)


def test_generation_score(spark):
    rows = [("c", "r" * 100), ("", "r" * 5000), ("c", "r" * 5000), ("c", "")]
    got = evaluate(spark, rows, scoring.generation_score(F.col("c"), F.col("r")), "c string, r string")
    assert got == pytest.approx([0.4, 0.7, 1.0, 0.3])


def test_content_keys_have_no_separator(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "x")]
    got = evaluate(spark, rows, text.content_key(F.col("a"), F.col("b")), "a string, b string")
    assert got[0] == got[1] == hashlib.sha256(b"abc").hexdigest()
    assert got[2] == hashlib.sha256(b"x").hexdigest()


def test_sft_text(spark):
    rows = [(" i ", "", "r"), ("i", " c\n", "r</s>"), ("", "c", "r"), ("i", "c", " \t"), (None, None, "r")]
    got = evaluate(spark, rows, text.sft_text(F.col("i"), F.col("c"), F.col("r")), "i string, c string, r string")
    assert got == ["### Instruction:\ni\n\n### Response:\nr</s>",
                   "### Context:\nc\n\n### Instruction:\ni\n\n### Response:\nr</s>", "", "", ""]


def test_extract_response(spark):
    rows = ["a ### Response: b ### Response: c", "x ### Response:", "none"]
    assert evaluate(spark, rows, text.extract_response(F.col("x"))) == ["b", "", "none"]


def test_chunk_and_tokens(spark):
    rows = ["a" * 4000, "a" * 4001]
    got = evaluate(spark, rows, text.code_chunk(F.col("x")))
    assert got == ["a" * 4000, "a" * 4000 + "\n... [truncated]"]
    assert evaluate(spark, [("abc", "abcdefg")], text.token_estimate(F.col("a"), F.col("b")), "a string, b string") == [1]


SECRETS = [
    ("ghp" + "_" + "a" * 36, "[GITHUB_TOKEN]"), ("glpat-" + "a-" * 10, "[GITLAB_TOKEN]"), ("sk-" + "A1" * 10, "[OPENAI_KEY]"),
    ("Bearer \t" + "é_" * 10, "[BEARER_TOKEN]"), ("api-key='" + "k" * 20, "[API_KEY]"), ("akia" + "A1" * 8, "[AWS_KEY]"),
    ("-----BEGIN  RSA PRIVATE KEY-----", "[PRIVATE_KEY]"), ("-----BEGIN OPENSSH PRIVATE KEY-----", "[SSH_KEY]"),
    ("$openai_api_key=abc", "[ENV_SECRET]"), ("token id", "token id"), ("token_id: " + "t" * 20, "[TOKEN]"),
    ("gh\x1b[31mp_" + "c" * 36, "[GITHUB_TOKEN]"), ("secret_key=sk-" + "q" * 30, "secret_key=[OPENAI_KEY]"),
    ("sk-" + "a" * 19, "sk-" + "a" * 19),
]


def test_redact(spark):
    got = evaluate(spark, [f"x {s} y" for s, _ in SECRETS], text.redact_secrets(F.col("x")))
    assert got == [f"x {want} y" for _, want in SECRETS]


def test_truncate(spark):
    rows = ["a" * 100, "a" * 101, None]
    assert evaluate(spark, rows, text.truncate(F.col("x"), 100)) == ["a" * 100, "a" * 97 + "...", None]


def test_safe_parse(spark):
    assert evaluate(spark, [" 7 ", "x", "", None, "1.5"], text.safe_int(F.col("x"), 3)) == [7, 3, 3, 3, 3]
    assert evaluate(spark, ["YES", "off", "maybe", None], text.safe_bool(F.col("x"), True)) == [True, False, True, True]


def test_repo_key(spark):
    rows = ["https://h.org/o/x.git", "https://h.org/o/x.github.io/", "http://h/a/b///", "not a url", "", "git@h:o/r.git",
            "https://h.org/o/x?y=/z#f", "https://h.org/a;p/b;q"]
    want = ["o_x", "o_xhub.io", "a_b", "not a url", "", "git@h:o_r", "o_x", "a;p_b"]
    assert evaluate(spark, rows, repos.repo_key(F.col("x"))) == want


def test_repo_of_path(spark):
    rows = ["data/ai-lab/repos/r1/a.py", "/x/repos/r1/a", "ai-lab/repos", "repos/r2/ai-lab/x", "ai-lab/repos/a/repos/b"]
    assert evaluate(spark, rows, repos.repo_of_path(F.col("x"))) == ["r1", "unknown", "unknown", "r2", "a"]


def test_extensions(spark):
    rows = ["a/b.PY", "a/.py", "a.b/c", "x.tar.GZ", "..c", "a/b."]
    assert evaluate(spark, rows, languages.file_extension(F.col("x"))) == [".py", "", "", ".gz", "", "."]


def test_ignored_directories_count_below_the_root_only(spark):
    rows = ["/build/repo/src/a.py", "/build/repo/tests/a.py", "/build/repo/x/.git/a.py", "/build/repo/test"]
    got = evaluate(spark, rows, languages.outside_ignored(F.col("x"), F.lit("/build/repo/")))
    assert got == [True, False, False, True]


def test_status_chain(spark):
    col = status.resolve_status(*[F.col(c) for c in ("stop", "status", "err", "health", "run", "made", "sent", "step")])
    rows = [(True, "running", None, None, "r", 0, 0, 0), (False, "completed", "e", None, "r", 0, 0, 0),
            (None, "paused", "e", None, "r", 1, 0, 0), (None, "", None, "degraded", "r", 1, 0, 0),
            (None, None, None, None, "r", 1, None, None), (None, None, None, None, "r", 0, 1, 0),
            (None, None, None, None, "r", 0, 0, 1), (None, None, None, None, "r", 0, 0, 0),
            (None, None, None, None, None, 1, 1, 1)]
    schema = "stop boolean, status string, err string, health string, run string, made int, sent int, step int"
    assert evaluate(spark, rows, col, schema) == [
        "stopped", "completed", "error", "error", "running", "running", "running", "idle", "idle"]


def test_display_values(spark):
    seconds = [0.0, 6.5, 59.0, 60.0, 69.0, 3599.0, 3600.0, 5400.0, 1234567.0]
    def eta(s):
        return f"{s / 3600:.1f}h" if s >= 3600 else f"{s / 60:.1f}m" if s >= 60 else f"{s:.0f}s"
    def age(s):
        return f"{s:.0f}s" if s < 60 else f"{s / 60:.0f}m" if s < 3600 else f"{s / 3600:.1f}h"
    assert evaluate(spark, seconds, status.humanize_eta(F.col("x")), "x double") == [eta(s) for s in seconds]
    assert evaluate(spark, seconds, status.humanize_age(F.col("x")), "x double") == [age(s) for s in seconds]
    clocks = ["2024-01-02T03:04:05", "2024-01-02T03:04:05.678+02:00", "2024-01-02", "garbage!!", "", None]
    assert evaluate(spark, clocks, status.clock_time(F.col("x"))) == ["03:04:05", "03:04:05", "00:00:00", "garbage!", "", ""]
    names = ["Copilot", " xai", "foo-bar baz", ""]
    assert evaluate(spark, names, status.provider_name(F.col("x"))) == ["GitHub Copilot", "xAI", "Foo-Bar Baz", "Unknown"]


def test_bands_and_alerts(spark):
    values = [69.9, 70.0, 90.0, 90.1]
    assert evaluate(spark, values, status.usage_band(F.col("x")), "x double") == ["normal", "warning", "warning", "critical"]
    rows = [("cpu", 90.0), ("cpu", 90.1), ("memory", 86.0), ("disk", 80.5), ("gpu", 99.0)]
    got = evaluate(spark, rows, status.resource_alert(F.col("m"), F.col("v")), "m string, v double")
    assert got == [False, True, True, True, False]


def test_python_parses(spark):
    rows = ["x = 1", "x =", "def f():\n  return 1", "\0", None, "(" * 500, "'''a'''"]
    assert evaluate(spark, rows, evaluation.python_parses(F.col("x"))) == [True, False, True, False, False, False, True]


def test_keywords_and_length(spark):
    rows = [("A Bug and a FIX", ["bug", "fix", "error", "syntax"]), ("one bug", ["bug", "fix", "error", "syntax"]),
            ("", ["only"]), ("x", [])]
    got = evaluate(spark, rows, evaluation.keyword_match(F.col("r"), F.col("k")), "r string, k array<string>")
    assert got == [True, False, True, True]


def plain_metrics(code):
    lines = code.split("\n")
    widths = [len(x) - len(x.lstrip()) for x in lines if x.strip()]
    widths = [w for w in widths if w]
    names = re.findall(r"def\s+([a-zA-Z_][a-zA-Z0-9_]*)", code)
    return (len(lines), len(code), sum(x.strip().startswith("#") or "//" in x for x in lines) / len(lines),
            max(Counter(widths).values()) / len(widths) if widths else 0.0,
            sum("_" in n or n.islower() for n in names) / len(names) if names else 0.0)


def test_code_metrics(spark):
    rows = ["", "def Foo():\n  a\n    b\n  c # d\n\t# e\n\n", "x//y\n   \ndef a_B(): pass\ndef ABC():\n    return", "def _(): 1\ndef f1(x)"]
    cols = evaluation.code_metrics(F.col("x"))
    got = evaluate(spark, rows, F.struct(*[c.alias(n) for n, c in cols.items()]))
    for row, code in zip(got, rows, strict=True):
        assert tuple(row) == pytest.approx(plain_metrics(code))
