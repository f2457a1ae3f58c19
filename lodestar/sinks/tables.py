"""Written tables in the shared checkpoint folder.

A bucketed table tells the planner how its rows are hash-partitioned, so a
later join on the bucket columns shuffles only the other side.  Unlike
``persist()``/``checkpoint()`` (whose partitioning AQE does not report), this
holds under adaptive execution, and the files survive executor loss.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ROWS_PER_WRITE = 2_000_000     # rows that a task writes to buckets, about
PIECES = 8                     # of these rows, dealt out by a hash


def write_bucketed(df: DataFrame, buckets: int, cols: list[str],
                   hint: str = "t", rows: int = 0, spread: str | None = None) -> tuple[DataFrame, str, str]:
    """Write ``df`` as a parquet table bucketed on ``cols``; return its scan,
    table name and path.

    The rows are first hash-partitioned with the same function and count as
    the buckets, so each writing task produces exactly one file per bucket.
    With the number of ``rows`` and a column ``spread``, a bucket of many rows is dealt out
    by that column to several tasks and files: a writing task sorts its rows by bucket, so
    its memory follows ``ROWS_PER_WRITE`` however large the buckets are.
    """
    spark = df.sparkSession
    pieces = -(-rows // (buckets * ROWS_PER_WRITE))
    if spread and pieces > 1:
        # Several pieces for each task, so that hashing deals them out evenly.
        cols_and_piece = [*cols, F.pmod(F.xxhash64(spread), F.lit(PIECES * pieces))]
        at = df.repartition(buckets * pieces, *cols_and_piece)
    else:
        at = df.repartition(buckets, *cols)
    name = f"lodestar_{hint}_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, hint)
    (at.write.format("parquet")
       .bucketBy(buckets, *cols).option("path", path).saveAsTable(name))
    return spark.table(name), name, path


def drop_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Forget a table made by :func:`write_bucketed` and, with ``path``, delete
    its files from the shared folder (only once nothing reads them any more)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if path:
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the Hadoop file system of ``path``'s scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_table(df: DataFrame, hint: str = "t") -> DataFrame:
    """Write ``df`` as plain parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, hint)
    df.write.parquet(path)
    return spark.read.parquet(path)
