"""Training metrics as aggregates (AGG-5..10, SNK-7/8).

Per-step and per-batch tables can be as long as the data is wide, so running
totals use the same range-partition + per-partition-offset scheme as
positions, never a window over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# The reference's weight decay and checkpoint period.
WEIGHT_DECAY = 0.0005
CHECKPOINT_EVERY = 100


def running_totals(df: DataFrame, order: str, cols: Sequence[str], prefix: str = "cum_") -> DataFrame:
    """Cumulative sums of ``cols`` in ``order`` (unique), e.g. AGG-9.

    Range-partition on ``order``; each partition's totals (one row per
    partition) give its offset; inside a partition a window partitioned by the
    partition index adds the local prefix.
    """
    checkpoint_dir(df.sparkSession)
    mat = (df.repartitionByRange(order).sortWithinPartitions(order)
           .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    totals = mat.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    # One row per partition: bounded by the partition count.
    w_all = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(w_all), F.lit(0)).alias(f"_o_{c}")
                                      for c in cols])
    w = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = mat.select("*", *[F.sum(c).over(w).alias(f"_l_{c}") for c in cols])
    out = local.join(F.broadcast(offsets), "_pid")
    return out.select(*df.columns, *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(prefix + c) for c in cols])


def running_precision(batches: DataFrame, order: str = "batch_id", hits: str = "hits",
                      examples: str = "examples") -> DataFrame:
    """AGG-9: cumulative hits / cumulative examples after each batch."""
    rt = running_totals(batches, order, [hits, examples])
    return rt.withColumn("precision", F.col(f"cum_{hits}") / F.col(f"cum_{examples}"))


def epoch_mean_loss(batch_losses: DataFrame, batches_per_epoch: int | None = None) -> DataFrame:
    """AGG-5: per epoch, the sum of batch losses over the number of batches
    (``batches_per_epoch`` when the schedule fixes it, else the batches seen)."""
    div = F.lit(float(batches_per_epoch)) if batches_per_epoch else F.count(F.lit(1))
    return batch_losses.groupBy("epoch").agg(
        (F.sum("loss") / div).alias("avg_cost"), F.count(F.lit(1)).alias("batches"))


def block_mean_loss(step_losses: DataFrame, total_steps: int, blocks: int = 20) -> DataFrame:
    """AGG-6: blocks of ``int(total_steps / blocks)`` steps; one mean per full
    block; a trailing partial block is never reported (steps count from 1)."""
    w = max(total_steps // blocks, 1)
    full = (total_steps // w) * w
    return (step_losses.where(F.col("step") <= full)
            .groupBy(F.floor((F.col("step") - 1) / w).cast("long").alias("block"))
            .agg((F.sum("loss") / F.lit(float(w))).alias("block_loss"), F.count(F.lit(1)).alias("steps")))


def throughput(batches: DataFrame) -> DataFrame:
    """AGG-10: examples/s and s/batch per batch, plus the plain mean of the rates.

    ``batches`` has ``batch_id, examples, seconds``; the mean is a scalar
    aggregate computed first and added as a literal.
    """
    per = batches.select("batch_id", "examples", "seconds",
                         F.try_divide(F.col("examples"), F.col("seconds")).alias("examples_per_sec"),
                         F.col("seconds").alias("sec_per_batch"))
    mean = per.agg(F.avg("examples_per_sec").alias("m")).first()["m"]
    return per.withColumn("mean_examples_per_sec", F.lit(mean).cast("double"))


def variable_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-8: mean, population stddev, max, min per column (one pass, unpivoted)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__stddev"),
                 F.max(c).alias(f"{c}__max"), F.min(c).alias(f"{c}__min")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__stddev`, `{c}__max`, `{c}__min`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (variable, mean, stddev, max, min)")


def variable_histogram(df: DataFrame, cols: Sequence[str], buckets: int = 10) -> DataFrame:
    """AGG-8 histogram: exact counts in ``buckets`` equal-width bins between each
    column's min and max (the max falls in the last bin).

    Two scans for all columns together: one aggregate for the bounds (scalars),
    one pass that tags every value with ``(variable, bucket)`` and counts.
    """
    r = df.agg(*[F.min(c).cast("double").alias(f"lo_{k}") for k, c in enumerate(cols)],
               *[F.max(c).cast("double").alias(f"hi_{k}") for k, c in enumerate(cols)]).first()
    tags = []
    for k, c in enumerate(cols):
        lo, hi = r[f"lo_{k}"], r[f"hi_{k}"]
        x = F.col(c).cast("double")
        if lo is None or hi == lo:
            b = F.lit(0)
        else:
            b = F.least(F.floor((x - F.lit(lo)) / F.lit((hi - lo) / buckets)), F.lit(buckets - 1))
        b = F.when(x.isNotNull(), b.cast("int"))
        tags.append(F.struct(F.lit(c).alias("variable"), b.alias("bucket")))
    t = df.select(F.inline(F.array(*tags)))
    return (t.where(F.col("bucket").isNotNull())
            .groupBy("variable", "bucket").agg(F.count(F.lit(1)).alias("count")))


def l2_penalty(values: DataFrame, col: str = "value", decay: float = WEIGHT_DECAY) -> DataFrame:
    """SCL-15: ``decay · Σ w² / 2``, each parameter counted once."""
    return values.agg((F.sum(F.col(col).cast("double") * F.col(col).cast("double")) / 2 * decay).alias("penalty"))


def checkpoint_steps(total_steps: int, every: int = CHECKPOINT_EVERY) -> list[int]:
    """SNK-7: steps saved – every ``every``-th and the last."""
    return [s for s in range(total_steps) if s % every == 0 or s + 1 == total_steps]


def latest(saved: DataFrame, step: str = "step") -> DataFrame:
    """SNK-7 restore: rows of the newest saved step.  The max comes first as a
    scalar, so the filter prunes the other ``step=`` folders."""
    top = saved.agg(F.max(step).alias("s")).first()["s"]
    if top is None:
        return saved.limit(0)
    return saved.where(F.col(step) == F.lit(top))
