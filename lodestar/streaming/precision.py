"""STR-1: running precision over a queue of scored batches, as a stream.

Scored rows land as parquet files; a file-source stream reads them in triggers
bounded by bytes, a global aggregate keeps the cumulative hit and example
counts in the state store (complete mode), and ``foreachBatch`` writes the
cumulative row of every trigger.  ``availableNow`` drains the queue and stops,
like the reference's loop that ends at ``OutOfRange``.

The sink is idempotent: a micro-batch writes a folder named by its id and
replaces what an earlier attempt at the same id left there, so a trigger that
is retried after a failure leaves one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


BYTES_PER_TRIGGER = 256 << 20   # of scored files that a trigger reads, about
SINK_SCHEMA = "hits long, examples long, trigger long"


def write_trigger(batch: DataFrame, trigger: int, out: str) -> None:
    """The cumulative row of a micro-batch, in place of what an earlier attempt at it wrote."""
    batch.select("hits", "examples").coalesce(1).write.mode("overwrite").parquet(f"{out}/trigger={trigger}")


def stream_running_precision(spark: SparkSession, source_dir: str, schema: T.StructType,
                             hit_col: str = "hit", bytes_per_trigger: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Drain ``source_dir`` and return the per-trigger cumulative table
    ``(trigger, hits, examples, precision)``; an empty queue gives an empty table."""
    out = scratch_path(spark, "stream-precision")
    ckpt = scratch_path(spark, "stream-ckpt")
    stream = (spark.readStream.schema(schema)
              .option("maxBytesPerTrigger", bytes_per_trigger).parquet(source_dir))
    totals = stream.groupBy().agg(F.sum(F.col(hit_col).cast("long")).alias("hits"),
                                  F.count(F.lit(1)).alias("examples"))

    spark.createDataFrame([], SINK_SCHEMA).write.partitionBy("trigger").parquet(out)
    q = (totals.writeStream.outputMode("complete").foreachBatch(lambda batch, trigger: write_trigger(batch, trigger, out))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    res = spark.read.schema(SINK_SCHEMA).parquet(out)
    return res.select("trigger", "hits", "examples",
                      (F.col("hits") / F.col("examples")).alias("precision"))


def final_row(cumulative: DataFrame) -> DataFrame:
    """The row of the last trigger (the max is a scalar, then a filter)."""
    last = cumulative.agg(F.max("trigger").alias("t")).first()["t"]
    return cumulative.where(F.col("trigger") == F.lit(last)).drop("trigger")
