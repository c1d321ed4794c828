"""Programming-language rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.functions.text import may_match, once, searchable, strip


def detect_language(c: Column, patterns: tuple = fv.LANGUAGE_PATTERNS) -> Column:
    """The language with most keyword matches; earlier declared wins ties; no match is unknown.

    The extra zero-score entry outranks every other zero, so one array_max decides
    and each pattern runs once per row, or not at all where none of its keywords occurs.
    """
    def entry(score: Column, rank: int, name: str) -> Column:
        return F.struct(score.alias("score"), F.lit(rank).alias("rank"), F.lit(name).alias("name"))

    def best(s: Column) -> Column:
        entries = [entry(F.lit(0), 1, fv.UNKNOWN_LANGUAGE)]
        for position, (name, pattern) in enumerate(patterns):
            matches = F.regexp_count(s["text"], F.lit("(?iU)" + pattern))
            score = F.when(s["unusual"] | may_match(s["folded"], pattern), matches)
            entries.append(entry(F.coalesce(score, F.lit(0)), -position, name))
        return F.array_max(F.array(*entries))["name"]

    return once(searchable(c), best)


def language_of_path(path: Column) -> Column:
    """Case-sensitive suffix rule used when samples are generated."""
    cpp = F.lit(False)
    for suffix in fv.CPP_SUFFIXES:
        cpp = cpp | F.endswith(path, F.lit(suffix))
    return F.when(F.endswith(path, F.lit(".py")), F.lit("python")).when(cpp, F.lit("cpp")).otherwise(F.lit("mixed"))


def file_extension(path: Column) -> Column:
    """Lower-cased suffix of the file name; a leading dot alone does not count."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*(\.[^./]*)$", 1))


def extension_in(path: Column, extensions: tuple = fv.INCLUDE_EXTENSIONS) -> Column:
    return file_extension(path).isin(*[e.lower() for e in extensions])


def outside_ignored(path: Column, root: Column, ignored: tuple = fv.IGNORED_DIRECTORIES) -> Column:
    """No directory below ``root`` on the way to the file carries an ignored name."""
    below = F.split(F.substr(path, F.length(root) + 1), "/")
    directories = F.slice(below, F.lit(1), F.greatest(F.size(below) - 1, F.lit(0)))
    return ~F.arrays_overlap(directories, F.array(*[F.lit(d) for d in ignored]))


def extensions_of_languages(languages: Column) -> Column:
    """Union of the suffix sets of a list of language names; unknown names add nothing."""
    table = F.create_map(*[
        x for name, suffixes in fv.LANGUAGE_EXTENSIONS
        for x in (F.lit(name), F.array(*[F.lit(s) for s in suffixes]))
    ])
    nothing = F.array().cast("array<string>")
    return F.array_distinct(
        F.flatten(F.transform(languages, lambda name: F.coalesce(F.try_element_at(table, F.lower(name)), nothing)))
    )


def split_list(c: Column) -> Column:
    """Comma list, stripped of all white space, blanks dropped."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")
