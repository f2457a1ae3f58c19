"""The sort job.

orders is rendered by Spark as CSV text (all strings: keys compare as text,
so "10" < "9"), then read, sorted by (o_orderpriority, o_orderdate) with
o_orderkey as the last key for a fixed order, and written back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sorting import positions, sort_by_keys
from ..session import scratch_path
from ..sinks.files import write_csv
from ..sources.csv import read_csv_strings, read_csv_with_header
from ..sources.tables import table
from .registry import query

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
SORT_KEYS = ["o_orderpriority", "o_orderdate", "o_orderkey"]


def orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.format_string("%.2f", "o_totalprice").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        "o_orderpriority")


def write_orders_csv(spark: SparkSession, sf_dir: str, header: bool) -> str:
    """Orders as CSV; with ``header`` every part file starts with the header and
    one more header line sits among the data (as when files are concatenated)."""
    rows = orders_as_text(spark, sf_dir)
    if header:
        rows = rows.unionByName(spark.createDataFrame([tuple(ORDER_COLUMNS)], ORDER_COLUMNS))
    path = scratch_path(spark, "orders-csv")
    write_csv(rows, path, header=header)
    return path


TEXT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, printf('%.2f', o_totalprice) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders"""

SORTED_SQL = f"""SELECT *, row_number() OVER (ORDER BY o_orderpriority, o_orderdate, o_orderkey) - 1 AS position
FROM ({TEXT_SQL})"""


def sorted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_csv_with_header(spark, write_orders_csv(spark, sf_dir, header=True))
    return positions(rows, SORT_KEYS)


@query("src_csv_scan", oracle=f"""SELECT o_orderkey AS _c0, o_custkey AS _c1, o_orderstatus AS _c2,
  o_totalprice AS _c3, o_orderdate AS _c4, o_orderpriority AS _c5 FROM ({TEXT_SQL})""")
def src_csv_scan(spark, sf_dir):
    """SRC-1: headerless CSV scan, every column a string."""
    return read_csv_strings(spark, write_orders_csv(spark, sf_dir, header=False))


@query("src_csv_header", oracle=TEXT_SQL)
def src_csv_header(spark, sf_dir):
    """SRC-2 / FLT-4: names from the first row; all header copies dropped."""
    return read_csv_with_header(spark, write_orders_csv(spark, sf_dir, header=True))


@query("sort_two_keys", oracle=SORTED_SQL)
def sort_two_keys(spark, sf_dir):
    """SRT-1 / PRJ-1: global sort by two string keys (+ o_orderkey), with positions."""
    return sorted_orders(spark, sf_dir)


@query("snk_csv_sorted", oracle=SORTED_SQL)
def snk_csv_sorted(spark, sf_dir):
    """SNK-1: sorted rows written as CSV with a header, read back (round trip)."""
    path = scratch_path(spark, "sorted-csv")
    write_csv(sort_by_keys(sorted_orders(spark, sf_dir), ["position"]), path, header=True)
    back = read_csv_with_header(spark, path)
    return back.withColumn("position", F.col("position").cast("long"))
