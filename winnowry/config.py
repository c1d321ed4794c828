"""Swappable parameters.  Defaults are the published constants."""

from __future__ import annotations

from dataclasses import dataclass

from winnowry import fixed_values as fv


@dataclass(frozen=True)
class CleanRules:
    """Limits and word lists of the cleaning flow."""

    min_chars: int = fv.MIN_CHARS
    max_chars: int = fv.MAX_CHARS
    min_field_chars: int = fv.MIN_FIELD_CHARS
    min_quality: float = fv.MIN_QUALITY_SCORE
    min_entropy: float = fv.MIN_ENTROPY
    max_per_language: int = fv.MAX_PER_LANGUAGE
    toxic_words: tuple = fv.TOXIC_WORDS
    language_patterns: tuple = fv.LANGUAGE_PATTERNS


@dataclass(frozen=True)
class GenerationRules:
    """Prompt templates and truncation limits of sample generation."""

    templates: tuple = fv.PROMPT_TEMPLATES
    system_text: str = fv.SYSTEM_INSTRUCTIONS
    chunk_chars: int = fv.CODE_CHUNK_CHARS
    chunk_suffix: str = fv.CODE_CHUNK_SUFFIX
    context_chars: int = fv.CONTEXT_CHARS
    stub_responses: tuple = fv.STUB_RESPONSES
    stub_default: str = fv.STUB_DEFAULT


@dataclass(frozen=True)
class ScanRules:
    """Which files of a source tree are read."""

    extensions: tuple = fv.INCLUDE_EXTENSIONS
    ignored_directories: tuple = fv.IGNORED_DIRECTORIES
