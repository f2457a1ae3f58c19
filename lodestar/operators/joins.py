"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
HOT_KEYS = 1000          # keys that a heavy-hitter sketch may name
SKETCH_KEYS = 16_384     # keys that a task's sketch keeps (Spark's frequent-items sketch, merged over tasks)
HOT_ROWS = 100_000       # rows of a key, at least, for it to be joined apart


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows.

    The count is an exact bound (one cheap job on a lookup table); above it the
    frame is returned unchanged and the planner shuffles both sides.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def lookup(df: DataFrame, table: DataFrame, on: str | list[str], how: str = "inner",
           max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Equi-join against a lookup table, broadcasting it only when small."""
    return df.join(broadcast_if_small(table, max_rows), on, how)


def unmatched(df: DataFrame, table: DataFrame, on: str | list[str],
              max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose key is missing from ``table`` (the source raised a KeyError)."""
    return df.join(broadcast_if_small(table, max_rows), on, "left_anti")


def heavy_hitters(df: DataFrame, column: str, total: int, least: int = HOT_ROWS) -> list:
    """Keys that hold more rows than an average shuffle partition and than ``least``: at most ``HOT_KEYS`` of them, by a merged sketch.

    The list steers a plan and nothing else: a key that the sketch misses is joined like any other.
    """
    if total <= least:
        return []
    mean = total / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = df.agg(F.expr(f"approx_top_k(`{column}`, {HOT_KEYS}, {SKETCH_KEYS})").alias("top")).first()["top"] or []
    return [r["item"] for r in found if r["item"] is not None and r["count"] > max(mean, least)]


def join_spread(df: DataFrame, table: DataFrame, on: str, how: str, hot: list) -> DataFrame:
    """Equi-join of ``df`` with a table of unique keys; rows of hot keys stay where they are.

    The table's rows of the ``hot`` keys (at most ``HOT_KEYS``) are broadcast to the rows of these keys; all other rows are shuffled,
    so no key with a large share of the rows makes a long task.
    """
    if not hot:
        return df.join(table, on, how)
    kind = df.select(on).schema[0].dataType.simpleString()
    keys = F.broadcast(df.sparkSession.createDataFrame([(k,) for k in hot], f"`{on}` {kind}"))
    few = F.broadcast(table.join(keys, on, "left_semi"))
    return (df.join(keys, on, "left_semi").join(few, on, how)
            .unionByName(df.join(keys, on, "left_anti").join(table, on, how)))
