"""Fixed values.

Everything here is a published constant of the workload (word lists, patterns,
templates, limits, prices, field lists).  Results depend on them character by
character, so they are stated literally and in their declaration order; order is
meaningful wherever ties are broken by it.
"""

from __future__ import annotations

# --- cleaning limits --------------------------------------------------------
MIN_CHARS = 50
MAX_CHARS = 8000
MIN_FIELD_CHARS = 10
MIN_QUALITY_SCORE = 0.2
MIN_ENTROPY = 0.05
MAX_PER_LANGUAGE = 1000

TOXIC_WORDS = (
    "toxic", "hate", "kill", "die", "stupid", "idiot", "dumb", "moron",
    "retard", "loser", "pathetic", "worthless", "garbage", "trash",
)

# Ties between languages go to the earlier entry.
LANGUAGE_PATTERNS = (
    ("python", r"\b(def |class |import |from |if __name__|print\(|#)"),
    ("javascript", r"\b(function|const|let|var|=>|console\.|require\()"),
    ("typescript", r"\b(interface|type|as|namespace|declare|abstract)"),
    ("cpp", r"\b(#include|int main|std::|cout|cin|->)"),
    ("java", r"\b(public class|private|protected|static void|System\.out)"),
    ("go", r"\b(func |package |import \(|fmt\.|go func)"),
    ("rust", r"\b(fn |use |mut |impl |let |match)"),
)
UNKNOWN_LANGUAGE = "unknown"

# --- source trees -----------------------------------------------------------
INCLUDE_EXTENSIONS = (".py", ".cpp", ".cc", ".h", ".hpp", ".c", ".rs", ".go")
IGNORED_DIRECTORIES = ("tests", "test", "build", "node_modules", ".git", "third_party")
CPP_SUFFIXES = (".cpp", ".cc", ".hpp", ".h", ".c")
REPO_PATH_MARKER = "ai-lab"
REPO_PATH_PARENT = "repos"

LANGUAGE_EXTENSIONS = (
    ("python", (".py",)),
    ("javascript", (".js", ".jsx", ".ts", ".tsx")),
    ("typescript", (".ts", ".tsx")),
    ("go", (".go",)),
    ("rust", (".rs",)),
    ("cpp", (".cpp", ".cc", ".c", ".h", ".hpp")),
    ("c", (".c", ".h")),
)

TOPIC_QUERIES = (
    ("devops", "devops infrastructure as code terraform kubernetes ci cd"),
    ("github_workflows", "github actions workflow ci cd"),
    ("penetration_security", "penetration testing security audit vulnerability"),
    ("hacking", "ctf exploit poc reverse engineering"),
    ("whitehat_blackhat", "ethical hacking red team blue team"),
)

# --- sample generation ------------------------------------------------------
CODE_CHUNK_CHARS = 4000
CODE_CHUNK_SUFFIX = "\n... [truncated]"
CONTEXT_CHARS = 8192

SYSTEM_INSTRUCTIONS = (
    "You are a meticulous senior engineer and technical writer. "
    "You must be correct, concrete, and testable. "
    "Prefer runnable code and clearly separated sections. "
    "Do not invent missing APIs; if assumptions are needed, state them explicitly."
)

OUTPUT_CONTRACT = (
    "Return your answer in the following format exactly:\n"
    "<ANSWER>\n"
    "...your content...\n"
    "</ANSWER>\n"
    "Do not include anything outside <ANSWER> tags."
)

PROMPT_TEMPLATES = (
    ("explain_deep",
     "Write a deep explanation of the code with a focus on invariants, data flow, and failure modes. "
     "Include: (1) high-level summary, (2) line-by-line walkthrough of key functions, "
     "(3) edge cases, (4) complexity/perf notes, (5) suggested improvements.\n" + OUTPUT_CONTRACT),
    ("tests_premium",
     "Write high-quality unit tests for the code. Requirements: "
     "(1) tests must be runnable, (2) cover normal + edge cases, "
     "(3) include at least one property-based or parameterized test if applicable, "
     "(4) mock network/filesystem/time where appropriate, (5) include clear assertions.\n"
     + OUTPUT_CONTRACT),
    ("code_review",
     "Perform a professional code review. Include: "
     "(1) correctness issues, (2) security issues, (3) performance issues, "
     "(4) readability/maintainability issues, (5) suggested refactor plan, "
     "(6) priority-ranked checklist of fixes.\n" + OUTPUT_CONTRACT),
    ("refactor_premium",
     "Refactor the code for clarity and maintainability. Requirements: "
     "(1) preserve behavior, (2) improve naming, structure, and cohesion, "
     "(3) remove duplication, (4) add small helper functions, "
     "(5) output the full refactored code.\n" + OUTPUT_CONTRACT),
    ("optimize_premium",
     "Optimize the code. Include: "
     "(1) a short list of bottlenecks, (2) improved implementation, "
     "(3) complexity comparison, (4) any trade-offs.\n" + OUTPUT_CONTRACT),
    ("bug_hunt",
     "Find subtle bugs and edge cases. Requirements: "
     "(1) list at least 5 potential issues, (2) show minimal reproducer inputs if possible, "
     "(3) provide concrete fixes.\n" + OUTPUT_CONTRACT),
    ("security_audit",
     "Do a security audit of the code. Include: "
     "(1) threat model assumptions, (2) vulnerabilities (injection, secrets, auth, unsafe deserialization, etc.), "
     "(3) mitigation steps, (4) safe-by-default code changes if relevant.\n" + OUTPUT_CONTRACT),
    ("debugging_trace",
     "Simulate a debugging session: "
     "(1) identify likely failure points, (2) propose targeted logging, "
     "(3) propose a minimal failing test, (4) provide a step-by-step fix plan.\n" + OUTPUT_CONTRACT),
    ("architecture_notes",
     "Write architecture notes: "
     "(1) components, (2) responsibilities, (3) interfaces, (4) key invariants, "
     "(5) suggested modularization.\n" + OUTPUT_CONTRACT),
)

# Offline responder: first keyword found in the lower-cased template decides.
# ``None`` stands for "return the code unchanged".
STUB_RESPONSES = (
    ("tests", "def test_example():\n    assert True\n"),
    ("explain", "This code implements ... (auto-generated explanation)"),
    ("refactor", None),
    ("optimize", None),
    ("bug", "No obvious bugs found in this snippet."),
)
STUB_DEFAULT = "Generated sample."

# --- training text ----------------------------------------------------------
EOS_TOKEN = "</s>"
RESPONSE_MARKER = "### Response:"
VALIDATION_FRACTION = 0.05

# --- telemetry --------------------------------------------------------------
EVENT_VERSION = "1.0"
EVENT_FIELDS = (
    "event_version", "ts", "run_id", "round", "stage", "level", "event_type", "message",
    "counters_delta", "usage_delta", "artifact_paths", "prev_hash",
)
STATUS_FIELDS = (
    "run_id", "status", "current_round", "current_stage", "stop_requested", "pause_requested",
    "counters", "usage", "gpu_summary", "resource_stats", "last_event_ts", "health",
    "updated_at", "sequence_number",
)
USAGE_NAMES = (
    "requests_sent", "input_tokens", "output_tokens", "rate_limits_hit", "retries",
    "estimated_cost_usd",
)
LAST_VALUE_COUNTERS = ("train_loss",)
TERMINAL_STATUSES = ("running", "completed", "stopped", "error")
REQUIRED_TELEMETRY_FIELDS = ("status", "usage", "current_stage", "stage_percent", "sequence_number")
MAX_MESSAGE_LENGTH = 500
MAX_ERROR_LENGTH = 200
MAX_PATH_LENGTH = 100
MAX_DELTA_LENGTH = 100
RECENT_EVENTS = 20
RECENT_EVENT_MESSAGE = 50
RESTART_GAP = 10
STALE_SECONDS = 30

# Applied in this order; all of them ignore case.
SECRET_PATTERNS = (
    (r"g[h]p_[a-zA-Z0-9]{36}", "[GITHUB_TOKEN]"),
    (r"glpat-[a-zA-Z0-9\-]{20,}", "[GITLAB_TOKEN]"),
    (r"s[k]-[a-zA-Z0-9]{20,}", "[OPENAI_KEY]"),
    (r"Bearer\s+[\w\-]{20,}", "[BEARER_TOKEN]"),
    (r"""(api[_-]?key|apikey|secret[_-]?key)\s*[:=]\s*["']?[\w\-]{20,}""", "[API_KEY]"),
    (r"A[K]IA[0-9A-Z]{16}", "[AWS_KEY]"),
    (r"-----BEGIN\s+(RSA\s+)?PRIVATE\s+KEY-----", "[PRIVATE_KEY]"),
    (r"-----BEGIN\s+OPENSSH\s+PRIVATE\s+KEY-----", "[SSH_KEY]"),
    (r"\$?(OPENAI_API_KEY|GITHUB_TOKEN|GITLAB_TOKEN|AWS_SECRET)[=]\S+", "[ENV_SECRET]"),
    (r"""token[_-]?(id|key)?\s*[:=]\s*["']?[\w\-]{20,}""", "[TOKEN]"),
)
ANSI_PATTERN = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])"

# --- prices (model, tokens per unit, input price, output price) -------------
PRICES_PER_MILLION = (
    ("github-copilot/gpt-5.3-codex", 1_000_000, 0.00, 0.00),
    ("xai/grok-4-1-fast", 1_000_000, 0.20, 0.50),
    ("gpt-4o", 1_000_000, 2.50, 10.00),
    ("gpt-4-turbo", 1_000_000, 10.00, 30.00),
    ("gpt-3.5-turbo", 1_000_000, 0.50, 1.50),
    ("claude-3-opus", 1_000_000, 15.00, 75.00),
    ("claude-3-sonnet", 1_000_000, 3.00, 15.00),
    ("claude-3-haiku", 1_000_000, 0.25, 1.25),
)
PRICES_PER_THOUSAND = (
    ("github-copilot/gpt-5.3-codex", 1_000, 0.00, 0.00),
    ("xai/grok-4-1-fast", 1_000, 0.20, 0.50),
    ("gpt-4o", 1_000, 2.50, 10.00),
)
DEFAULT_PRICE_MODEL = "github-copilot/gpt-5.3-codex"
# Substring price rules, first match wins; the last field says whether ``-`` and
# ``.`` are folded to ``_`` on both sides before comparing.
PRICE_RULES = (
    ("grok-4-1-fast", 1_000, 0.20, 0.50, False),
    ("gpt-5.3-codex", 1_000, 0.00, 0.00, False),
    ("github-copilot/gpt-5.3-codex", 1, 0.0, 0.0, True),
    ("xai/grok-4-1-fast", 1, 0.0002, 0.0005, True),
    ("gpt-4o", 1, 0.0025, 0.01, True),
)

PROVIDER_NAMES = (
    ("copilot", "GitHub Copilot"),
    ("github-copilot", "GitHub Copilot"),
    ("openai", "OpenAI"),
    ("anthropic", "Anthropic"),
    ("xai", "xAI"),
)

# --- run configuration rules (key, types, min, max, allowed) ----------------
CONFIG_RULES = (
    ("BASE_MODEL", ("str",), None, None, None),
    ("TEACHER_MODEL", ("str",), None, None, None),
    ("TEACHER_FAILBACK_MODEL", ("str",), None, None, None),
    ("SAMPLES_PER_ROUND", ("int",), 1.0, 10000.0, None),
    ("ROUNDS", ("int",), 1.0, 100.0, None),
    ("VAL_RATIO", ("int", "float"), 0.0, 1.0, None),
    ("SEQ_LEN", ("int",), 128.0, 8192.0, None),
    ("BATCH_SIZE", ("int",), 1.0, 64.0, None),
    ("GRAD_ACCUM", ("int",), 1.0, 128.0, None),
    ("TRAIN_STEPS", ("int",), 1.0, 100000.0, None),
    ("LORA_R", ("int",), 1.0, 512.0, None),
    ("LORA_ALPHA", ("int",), 1.0, 1024.0, None),
    ("LR", ("str",), None, None, None),
    ("RUN_UNIT_TESTS", ("str",), None, None, ("0", "1")),
    ("SEED", ("int", "str"), None, None, None),
    ("OUT_DIR", ("str",), None, None, None),
)

TRUE_WORDS = ("1", "true", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "no", "n", "off")

# --- resource alerts (metric, alert threshold in percent) -------------------
RESOURCE_ALERTS = (("cpu", 90.0), ("memory", 85.0), ("disk", 80.0))
BAND_LIMITS = (70.0, 90.0)
