"""SRC-3 / SRC-4: line-oriented text sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row ``value: string`` per line, over one path, a glob or any number of
    paths (the reference's fixed nine-file union becomes one multi-path scan)."""
    if isinstance(paths, str):
        paths = [paths]
    if not paths:
        raise ValueError("no input paths")
    return spark.read.text(list(paths))


def read_lines_numbered(spark: SparkSession, paths: str | Sequence[str],
                        name: str = "line_no") -> DataFrame:
    """Lines with their 0-based number in file order (files by path).

    A partition reads whole blocks in sequence, so ``(file path, block start,
    monotonically increasing id)`` orders lines as the files hold them; the
    number then comes from a global sort with per-partition offsets.
    """
    from ..operators.sorting import with_position

    raw = read_lines(spark, paths).select(
        "value", F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_m"))
    return with_position(raw.orderBy("_f", "_b", "_m"), name).drop("_f", "_b", "_m")
