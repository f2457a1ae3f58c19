"""Label maps and class numbering (SRT-3, JN-3/4, SRC-10/11, SNK-6, SET-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.text import read_lines, read_lines_numbered
from .joins import broadcast_if_small
from .sorting import positions

# Fixed value: the extra class in front of the synset numbering.
BACKGROUND = (0, "background")


def index_sorted_names(names: DataFrame, col: str = "name", start: int = 0) -> DataFrame:
    """SRT-3: distinct names numbered ``start, start+1, …`` in sorted order.

    Numbers come from a global sort with per-partition offsets, so even a very
    large vocabulary is never numbered in one task.
    """
    distinct = names.select(F.col(col).alias("name")).where(F.col("name").isNotNull()).distinct()
    pos = positions(distinct, ["name"], "label")
    return pos.select((F.col("label") + start).cast("int").alias("label"), "name")


def number_in_file_order(spark: SparkSession, path: str, start: int = 1) -> DataFrame:
    """SRT-3 (file order): every line (stripped) is one id, numbered from
    ``start`` as listed – the file order, not a sorted order."""
    from ..functions.text import py_strip
    lines = read_lines_numbered(spark, path)
    return lines.select((F.col("line_no") + start).cast("int").alias("label"),
                        py_strip(F.col("value")).alias("synset"))


def with_background(ids: DataFrame, name_col: str = "name") -> DataFrame:
    """SET-3: the constant ``0 → background`` row in front of the numbering."""
    spark = ids.sparkSession
    bg = spark.createDataFrame([BACKGROUND], f"label int, {name_col} string")
    return bg.unionByName(ids.select("label", name_col))


def label_lines(label_map: DataFrame) -> DataFrame:
    """SNK-6 / SCL-4: ``%d:%s`` lines."""
    return label_map.select(F.format_string("%d:%s", "label", "name").alias("value"))


def write_label_file(label_map: DataFrame, path: str) -> str:
    """Lines in label order: range partitions make part-file order = label order."""
    label_lines(label_map.orderBy("label")).write.mode("errorifexists").text(path)
    return path


def read_label_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-10: skip empty lines, split at the first ``:``; the name may hold more
    ``:``; for a repeated key the last line in file order wins.  Returns
    ``(label_map, rejected_lines)``."""
    lines = read_lines_numbered(spark, path).where(F.length("value") > 0)
    parsed = lines.select(
        F.regexp_extract("value", r"^([^:]*):", 1).alias("key"),
        F.regexp_extract("value", r"^[^:]*:(.*)$", 1).alias("name"),
        F.col("value").contains(":").alias("ok"), "line_no", "value")
    bad = parsed.where(~F.col("ok") | F.col("key").try_cast("int").isNull()).select("line_no", "value")
    good = parsed.where(F.col("ok")).select(F.col("key").try_cast("int").alias("label"), "name", "line_no")
    good = good.where(F.col("label").isNotNull())
    last = good.groupBy("label").agg(F.max_by("name", "line_no").alias("name"))
    return last.select("label", "name"), bad


def has_labels(spark: SparkSession, path: str) -> bool:
    """``has_labels``: whether a label file exists at ``path``."""
    try:
        read_lines(spark, path).limit(1).collect()
        return True
    except Exception:  # noqa: BLE001 - a missing path is the answer, not an error
        return False


def lookup_labels(df: DataFrame, label_map: DataFrame, name_col: str,
                  max_rows: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """JN-3: class name → id through the label map (broadcast when small).

    Returns ``(matched, unmatched)``; the source raised on the first unmatched
    name, here they are reported as rows.
    """
    lm = broadcast_if_small(label_map.select(F.col("name").alias(name_col), "label"), max_rows)
    return df.join(lm, name_col, "inner"), df.join(lm, name_col, "left_anti")


def read_tsv_pairs(spark: SparkSession, path: str, names: tuple[str, str] = ("synset", "name")) -> DataFrame:
    """SRC-11: strip, split on tab, exactly two parts (others are rejected)."""
    from ..functions.text import py_strip
    parts = F.split(py_strip(F.col("value")), "\t")
    lines = read_lines(spark, path)
    return (lines.where(F.size(parts) == 2)
            .select(parts.getItem(0).alias(names[0]), parts.getItem(1).alias(names[1])))


def count_check(df: DataFrame, expected: int, what: str) -> DataFrame:
    """AGG-12 / SRC-11 asserts as data: one row ``(what, rows, expected, ok)``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(what).alias("what"), "rows", F.lit(expected).cast("long").alias("expected"),
        (F.col("rows") == F.lit(expected)).alias("ok"))
