"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from . import (dataset_queries, edge_queries, image_queries, ml_queries, rank_queries,  # noqa: F401
               sort_queries)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
