"""Edge-list parsing and filters (PRJ-3/4, FLT-1/2/3).

Both parsers return ``(src, dst)`` plus, via ``classify_*``, a ``status``
column so rejected lines are counted instead of failing the job (the source
raised on empty or one-token lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_space, py_lower_strip, split_once, ws_field

# The comment marker and the one namespace prefix that is kept.
COMMENT = "#"
KEEP_PREFIX = "Category:"


def classify_whitespace_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """FLT-1 + PRJ-3 with a status per line: edge | comment | empty | single."""
    v = F.col(col)
    status = (F.when(v.isNull() | (F.length(v) == 0), "empty")
              .when(F.substring(v, 1, 1) == COMMENT, "comment")
              .when(~has_space(v), "single")
              .otherwise("edge"))
    return lines.select("*", status.alias("status"),
                        ws_field(v, 0).alias("src"), ws_field(v, 1).alias("dst"))


def parse_whitespace_edges(lines: DataFrame, col: str = "value") -> DataFrame:
    """Edges from ``src<blank>dst`` lines; comment lines dropped; extra fields ignored."""
    return classify_whitespace_lines(lines, col).where(F.col("status") == "edge").select("src", "dst")


def namespace_rejected(side: Column) -> Column:
    """FLT-2: a side with ``:`` that does not start with the exact ``Category:``."""
    return side.contains(":") & ~side.startswith(KEEP_PREFIX)


def classify_tab_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """FLT-2/3 + PRJ-4 with a status: edge | namespace | arity.

    The namespace test reads the raw sides (before strip and lower), so
    ``" Category:x"`` and ``"category:x"`` are dropped, ``"Category:a:b"`` kept.
    """
    parts = split_once(F.col(col), "\t")
    a = parts.getItem(0)
    b = F.try_element_at(parts, F.lit(2))
    status = (F.when(namespace_rejected(a), "namespace")
              .when(F.size(parts) != 2, "arity")
              .when(namespace_rejected(b), "namespace")
              .otherwise("edge"))
    return lines.select("*", status.alias("status"),
                        py_lower_strip(a).alias("src"), py_lower_strip(b).alias("dst"))


def parse_tab_edges(lines: DataFrame, col: str = "value") -> DataFrame:
    """Edges from ``src<TAB>dst`` lines, split at the first tab, stripped, lower-cased."""
    return classify_tab_lines(lines, col).where(F.col("status") == "edge").select("src", "dst")


def line_report(classified: DataFrame) -> DataFrame:
    """Counts per status (one partial + final aggregate)."""
    return classified.groupBy("status").agg(F.count(F.lit(1)).alias("lines"))
