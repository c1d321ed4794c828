"""Files crossed with prompt templates, and the responders that answer them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.config import GenerationRules
from winnowry.functions import languages, repos, scoring, text

MAX_TEMPLATES = 1000
Responder = Callable[[Column, Column], Column]


def stub_response(template: Column, code: Column, rules: GenerationRules = GenerationRules()) -> Column:
    """Keyword responder that needs no service."""
    low = F.lower(template)
    out = None
    for word, answer in rules.stub_responses:
        value = code if answer is None else F.lit(answer)
        hit = F.contains(low, F.lit(word))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    default = F.lit(rules.stub_default)
    return default if out is None else out.otherwise(default)


def first_answer(*responders: Responder) -> Responder:
    """Try responders in order; null means failure; the empty answer ends the list."""
    def respond(prompt: Column, code: Column) -> Column:
        return F.coalesce(*[r(prompt, code) for r in responders], F.lit(""))
    return respond


def source_files(files: DataFrame) -> DataFrame:
    """Non-blank files with their repository."""
    return files.filter(~text.is_blank(F.col("text"))).withColumn("repo", repos.repo_of_path(F.col("path")))


def cross_templates(files: DataFrame, rules: GenerationRules = GenerationRules()) -> DataFrame:
    """One row per file and template.

    The template list is a literal of checked size, so this is a row-local explode:
    no join, no shuffle, and the file text is not moved.
    """
    if len(rules.templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates: join a table instead")
    entries = F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(body).alias("template")) for t, body in rules.templates])
    return files.select("*", F.inline(entries))


def render_prompt(template: Column, path: Column, repo: Column, code: Column,
                  rules: GenerationRules = GenerationRules()) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.concat(
        F.lit(rules.system_text + "\n\nFILE: "), name, F.lit("\nREPO: "), repo,
        F.lit("\n\nINSTRUCTION:\n"), template, F.lit("\n\nCODE:\n"),
        text.code_chunk(code, rules.chunk_chars, rules.chunk_suffix),
    )


def generate_samples(files: DataFrame, rules: GenerationRules = GenerationRules(),
                     responder: Responder | None = None) -> DataFrame:
    """Raw samples of every non-blank file.  ``responder`` gets (prompt, code) columns."""
    rows = cross_templates(source_files(files), rules)
    code, template, path = F.col("text"), F.col("template"), F.col("path")
    prompt = render_prompt(template, path, F.col("repo"), code, rules)
    if responder is None:
        response = stub_response(template, code, rules)
    else:
        response = F.coalesce(responder(prompt, code), F.lit(""))
    answered = rows.withColumns({"prompt": prompt, "response": response})
    return answered.select(
        F.col("path"),
        text.sample_key(path, F.col("tag")).alias("sample_key"),
        F.col("tag").alias("instruction"),
        template.alias("instruction_detail"),
        "prompt",
        text.context_prefix(code, rules.context_chars).alias("context"),
        "response",
        languages.language_of_path(path).alias("language"),
        F.col("repo").alias("source_repo"),
        scoring.generation_score(code, F.col("response")).alias("quality_score"),
    )


def samples_per_file(samples: DataFrame) -> DataFrame:
    return samples.groupBy("path").agg(F.count("*").alias("samples"))
