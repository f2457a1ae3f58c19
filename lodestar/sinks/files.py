"""File sinks: CSV with header (SNK-1), text lines (SNK-2, SNK-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> str:
    """SNK-1: a directory of part files in the frame's order; fails if ``path`` exists."""
    df.write.mode(mode).option("header", header).csv(path)
    return path


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """SNK-2 / SNK-6: one line per row of a single string column."""
    if len(df.columns) != 1:
        raise ValueError("write_lines needs exactly one string column")
    df.write.mode(mode).text(path)
    return path
