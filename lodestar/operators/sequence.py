"""Successor in a global order without a global window.

``lead(x) OVER (ORDER BY k)`` with no partition runs in one task.  Here the
rows are range-partitioned on the (unique) order key, which balances them by
sampling; the lead is taken inside each range partition, and the last row of
each partition takes the first row of the next non-empty partition from a
table with one row per partition (bounded by the partition count, broadcast).
The range assignment is materialised with a reliable checkpoint so both uses
see the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def next_in_order(df: DataFrame, order: Sequence[str], carry: Sequence[str],
                  partitions: int | None = None) -> DataFrame:
    """Add ``next_<c>`` for every ``c`` in ``carry``: the value of the following
    row in the order ``order`` (which must be unique); null for the last row."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = list(dict.fromkeys([*order, *carry]))
    ranged = (df.select(*cols).repartitionByRange(n, *order)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    w = Window.partitionBy("_pid").orderBy(*order)
    local = ranged.select(
        *cols, "_pid",
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
        *[F.lead(c).over(w).alias(f"_n_{c}") for c in carry])
    firsts = ranged.groupBy("_pid").agg(
        F.min_by(F.struct(*carry), F.struct(*order)).alias("_first"))
    # One row per partition: a window over it is bounded by the partition count.
    boundary = firsts.select(
        "_pid", F.lead("_first").over(Window.orderBy("_pid")).alias("_nf"))
    out = local.join(F.broadcast(boundary), "_pid", "left")
    return out.select(
        *cols,
        *[F.when(F.col("_last"), F.col("_nf").getField(c)).otherwise(F.col(f"_n_{c}")).alias(f"next_{c}")
          for c in carry])
