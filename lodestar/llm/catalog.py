"""Imports every operator of the subpackage so that its registry is complete."""

from __future__ import annotations

from . import (alignment, jaccard_join, main_text, packing, periodic_runs, prefix_hashes, quality_rules, sentence_pieces,  # noqa: F401
               source_mix, token_counts, token_files, toxicity, url_filters)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
