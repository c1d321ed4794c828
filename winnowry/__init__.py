"""Winnowry: instruction-data curation and run analytics as Spark jobs."""

from winnowry.config import CleanRules, GenerationRules, ScanRules

__all__ = ["CleanRules", "GenerationRules", "ScanRules"]
