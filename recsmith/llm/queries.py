"""The package's queries and their oracle SQL."""

from __future__ import annotations

from . import (  # noqa: F401
    centroids, chosen_path, decontam, exact_dedup, language, license_scan, lm, ngram_join, packing, quality,
    ranked_search, token_counts, toxicity)
from .common import ORACLE, QUERIES  # noqa: F401
