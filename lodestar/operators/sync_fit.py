"""Synchronous and local-SGD fits of the softmax model over data of any size (ML-7, ML-8, SNK-8, SCL-13).

**Synchronous** (``fit_sync``).  Every epoch makes ``int(n / batch)`` updates; an update is the mean of the gradients that
``workers`` workers take on batches of exactly ``batch`` rows, each worker going through the data in an order of its own.
Rows get a dense place once (``positions`` of a key hash); the order of a worker in an epoch is a permutation of the places,
``(stride * place + shift) mod n`` with a stride prime to ``n``, so the update that a row belongs to is column arithmetic and no epoch
sorts or ranks anything.

Updates follow one another: an update needs the model of the one before, and its arithmetic (a few hundred rows) is shorter than any
exchange between machines (200 all-gathers of barrier tasks did not end in 100 s here).  So a task folds a *segment* of ``SEGMENT`` updates over the rows that
they use, a number that does not grow with the data; laying out the rows of an epoch by segment is spread over the cluster.  Each segment is a job whose
output is committed to a written table before the next begins: a lost executor repeats one segment.

The table holds a row per update (loss, examples, hits, clock) and, every ``HISTOGRAM_STEPS`` updates, counts of the values of each variable and of its
gradient in fixed buckets, so that histograms of several updates add up.  Only the model (``dim × classes``) comes to the driver.

**Local SGD** (``fit_local``).  The asynchronous trainer, re-aimed: rows fall into replicas of about ``rows_per_replica`` rows by a key hash, so their number
follows the data and not the cluster.  A task runs its replicas one after another from the epoch's model, adds up their models weighted by
rows, and the executors add up the tasks' sums; the next model is the mean.
"""

from __future__ import annotations

import hashlib
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .linear import BATCH_SIZE, BIASES, EPOCHS, LEARNING_RATE, SYNC_BATCH_SIZE, SYNC_WORKERS, WEIGHTS, Model, _probs, feature_dim
from .sorting import positions
from .splits import key_hash

SEGMENT = 512             # updates that a task makes
HISTOGRAM_STEPS = 10
ROWS_PER_REPLICA = 4096
# Bucket edges of the histograms, powers of ten by quarters from 1e-6 to 1e3, on both sides of zero.
EDGES = np.concatenate([-(10.0 ** np.arange(3, -6.25, -0.25)), 10.0 ** np.arange(-6, 3.25, 0.25)])

FOLD_SCHEMA = ("kind string, step long, epoch int, loss double, examples long, hits long, seconds double, "
               "name string, bucket int, count long, i int, j int, value double")
_KINDS = [pa.string(), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.int32(), pa.int64(),
          pa.int32(), pa.int32(), pa.float64()]
_NAMES = [c.split()[0] for c in FOLD_SCHEMA.split(", ")]


def _hash60(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def epoch_order(epoch: int, worker: int, n: int) -> tuple[int, int]:
    """``(stride, shift)`` of a worker's order: the place ``p`` comes at ``(stride * p + shift) mod n``."""
    stride = _hash60(f"{epoch}:{worker}:stride") % n + 1
    while math.gcd(stride, n) != 1:
        stride += 1
    return stride, _hash60(f"{epoch}:{worker}:shift") % n


@dataclass(frozen=True)
class SyncFit:
    """The fitted model and the table that the fit has written."""

    model: Model
    path: str
    updates: int

    def metrics(self, spark: SparkSession) -> DataFrame:
        """``(step, epoch, loss, examples, hits, seconds)`` of every update, read back."""
        return spark.read.schema(FOLD_SCHEMA).parquet(self.path).where("kind = 'step'").select("step", "epoch", "loss", "examples", "hits", "seconds")

    def histograms(self, spark: SparkSession) -> DataFrame:
        """``(step, name, bucket, count)``: values of each variable and of its gradient between ``EDGES[bucket - 1]`` and ``EDGES[bucket]``."""
        return spark.read.schema(FOLD_SCHEMA).parquet(self.path).where("kind = 'histogram'").select("step", "name", "bucket", "count")


def _features_of(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _gradient(X: np.ndarray, y: np.ndarray, W: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Mean gradients of the weights and biases, mean loss, hits."""
    P, nlp = _probs(X, W, b)
    at = np.arange(len(y))
    loss, hits = float(nlp[at, y].mean()), int((P.argmax(axis=1) == y).sum())
    P[at, y] -= 1.0
    return X.T @ P / len(y), P.sum(axis=0) / len(y), loss, hits


def _model_rows(model: Model) -> Iterator[tuple]:
    for param, i, j, value in model.to_rows():
        yield ("model", None, None, None, None, None, None, param, None, None, i, j, value)


def _fold(model: Model, epoch: int, before: int, per_update: int, lr: float):
    """Fold the updates of one task's rows, which come in the order of the updates; ``before`` updates were made in earlier epochs."""
    dim = model.W.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W, b = model.W.copy(), model.b.copy()
        cx, cy, ck = np.zeros((0, dim)), np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows: list[tuple] = []
        met = False

        def histogram(step: int, name: str, values: np.ndarray) -> None:
            bucket, n = np.unique(np.searchsorted(EDGES, values.ravel(), side="right"), return_counts=True)
            rows.extend(("histogram", step, epoch, None, None, None, None, name, int(k), int(m), None, None, None) for k, m in zip(bucket, n))

        for batch in batches:
            met = met or len(batch) > 0
            X = np.vstack([cx, _features_of(batch, "features", dim)])
            y = np.concatenate([cy, batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(np.int64)])
            k = np.concatenate([ck, batch.column(batch.schema.get_field_index("_update")).to_numpy(zero_copy_only=False)])
            full = len(y) // per_update * per_update
            for at in range(0, full, per_update):
                began = time.time()
                # Workers' batches have the same size, so the mean of their means is the mean of all rows.
                gW, gb, loss, hits = _gradient(X[at:at + per_update], y[at:at + per_update], W, b)
                W, b, step = W - lr * gW, b - lr * gb, before + int(k[at])
                if step % HISTOGRAM_STEPS == 0:
                    for name, value, slope in ((WEIGHTS, W, gW), (BIASES, b, gb)):
                        histogram(step, name, value)
                        histogram(step, f"{name}/gradients", slope)
                rows.append(("step", step, epoch, loss, per_update, hits, time.time() - began, None, None, None, None, None, None))
            cx, cy, ck = X[full:], y[full:], k[full:]
        if met:
            rows.extend(_model_rows(Model(W, b)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(_KINDS), _KINDS)], _NAMES)

    return run


def fit_sync(features: DataFrame, epochs: int = EPOCHS, batch_size: int = SYNC_BATCH_SIZE, workers: int = SYNC_WORKERS, lr: float = LEARNING_RATE,
             classes: int = 10, segment: int = SEGMENT) -> SyncFit:
    """ML-7: ``epochs * int(n / batch_size)`` updates, each the mean of ``workers`` batches of exactly ``batch_size`` rows.

    ``workers=1`` with ``batch_size=32`` is the single-machine schedule (ML-6).  ``features`` is ``(id, features, label)``; repeated and null ids are rows like
    others as long as the table gives them in the same way each time; fewer rows than a batch make no update (the zero model).
    """
    spark = features.sparkSession
    path, placed_at = scratch_path(spark, "fit-sync"), scratch_path(spark, "fit-places")
    model = Model.zeros(feature_dim(features), classes)
    hashed = features.select("id", "features", "label", key_hash("id", "sync").alias("_h"))
    positions(hashed, ["_h", "id"], "_place").select("features", "label", "_place").write.parquet(placed_at)
    placed = spark.read.parquet(placed_at)
    n = placed.count()
    updates, per_update = n // batch_size, batch_size * workers
    spark.createDataFrame([], FOLD_SCHEMA).write.parquet(path)
    for epoch in range(epochs if updates else 0):
        orders = F.array(*[F.struct(F.lit(w).alias("w"), _place(*epoch_order(epoch, w, n), n).alias("at")) for w in range(workers)])
        tagged = (placed.withColumn("_o", F.explode(orders)).withColumn("_update", F.floor(F.col("_o.at") / batch_size))
                  .where(F.col("_update") < updates)
                  .select("features", "label", "_update", F.col("_o.w").alias("_w"), F.col("_o.at").alias("_at")))
        parts = -(-updates // segment)
        if parts > 1:   # laid out once, so that a segment reads its own rows
            laid = scratch_path(spark, "fit-segments")
            (tagged.withColumn("_segment", F.floor(F.col("_update") / segment)).repartition("_segment").write.partitionBy("_segment").parquet(laid))
            source = spark.read.parquet(laid)
        for part in range(parts):
            own = source.where(F.col("_segment") == part).drop("_segment") if parts > 1 else tagged
            job = own.coalesce(1) if parts > 1 else own.repartition(1)   # at most segment * per_update rows
            (job.sortWithinPartitions("_update", "_w", "_at").select("features", "label", "_update")
             .mapInArrow(_fold(model, epoch, epoch * updates, per_update, lr), FOLD_SCHEMA).write.parquet(f"{path}/epoch-{epoch}-{part}"))
            done = spark.read.schema(FOLD_SCHEMA).parquet(f"{path}/epoch-{epoch}-{part}")
            model = Model.from_frame(done.where("kind = 'model'").select(F.col("name").alias("param"), "i", "j", "value"))
    return SyncFit(model, f"{path}/*" if updates and epochs else path, epochs * updates)


def _place(stride: int, shift: int, n: int):
    """The place's turn in an order; the product may pass 64 bits."""
    if n < 1 << 30:
        return F.pmod(F.col("_place") * F.lit(stride) + F.lit(shift), F.lit(n).cast("long"))
    wide = F.col("_place").cast("decimal(19,0)") * F.lit(stride).cast("decimal(18,0)") + F.lit(shift).cast("decimal(18,0)")
    return (wide % F.lit(n).cast("decimal(18,0)")).cast("long")


# ------------------------------------------------------------------ local SGD
@dataclass(frozen=True)
class LocalFit:
    """The fitted model and ``(epoch, mean loss, rows, replicas)`` of each epoch."""

    model: Model
    epochs: list[tuple[int, float, int, int]]


def replica_count(n: int, rows_per_replica: int = ROWS_PER_REPLICA) -> int:
    return max(1, -(-n // rows_per_replica))


def _local_epoch(model: Model, batch_size: int, lr: float):
    """Mini-batch SGD of each replica in the task, whose rows come replica by replica in the epoch's order; one sum of models comes out."""
    dim, classes = model.W.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sum_w, sum_b, loss, n, replicas = np.zeros((dim, classes)), np.zeros(classes), 0.0, 0, 0
        W, b, seen, now = model.W, model.b, 0, None
        cx, cy = np.zeros((0, dim)), np.zeros(0, np.int64)

        def step(X: np.ndarray, y: np.ndarray) -> None:
            nonlocal W, b, seen, loss
            gW, gb, mean, _ = _gradient(X, y, W, b)
            W, b, seen, loss = W - lr * gW, b - lr * gb, seen + len(y), loss + mean * len(y)

        def close() -> None:
            nonlocal W, b, seen, n, replicas, sum_w, sum_b, cx, cy
            if len(cy):
                step(cx, cy)   # the short batch at a replica's end
            if seen:
                sum_w, sum_b, n, replicas = sum_w + seen * W, sum_b + seen * b, n + seen, replicas + 1
            W, b, seen, cx, cy = model.W, model.b, 0, cx[:0], cy[:0]

        for batch in batches:
            X = _features_of(batch, "features", dim)
            y = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(np.int64)
            r = batch.column(batch.schema.get_field_index("_replica")).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist(), len(r)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if now is not None and r[lo] != now:
                    close()
                now = r[lo]
                cx, cy = np.vstack([cx, X[lo:hi]]), np.concatenate([cy, y[lo:hi]])
                full = len(cy) // batch_size * batch_size
                for at in range(0, full, batch_size):
                    step(cx[at:at + batch_size], cy[at:at + batch_size])
                cx, cy = cx[full:], cy[full:]
        close()
        rows = [(p, i, j, v) for p, i, j, v in Model(sum_w, sum_b).to_rows()] if n else []
        rows += [("loss", 0, 0, loss), ("n", 0, 0, float(n)), ("replicas", 0, 0, float(replicas))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.float64()))], ["param", "i", "j", "v"])

    return run


def fit_local(features: DataFrame, epochs: int = EPOCHS, batch_size: int = BATCH_SIZE, lr: float = LEARNING_RATE, classes: int = 10,
              rows_per_replica: int = ROWS_PER_REPLICA) -> LocalFit:
    """ML-8 re-aimed: local SGD with one mean of models an epoch, weighted by rows.

    The replicas and their orders come from hashes of the id, so the model does not depend on the cluster; a replica holds about ``rows_per_replica`` rows at
    any size of the table (rows that share an id share a replica).  An empty table raises.
    """
    n = features.count()
    replicas = replica_count(n, rows_per_replica)
    model, done = Model.zeros(feature_dim(features), classes), []
    dealt = (features.select("id", "features", "label").withColumn("_replica", F.pmod(key_hash("id", "replica"), F.lit(replicas)))
             .repartition("_replica").persist())
    try:
        for epoch in range(epochs):
            sums = (dealt.withColumn("_h", key_hash("id", "batch", epoch)).sortWithinPartitions("_replica", "_h", "id")
                    .select("features", "label", "_replica").mapInArrow(_local_epoch(model, batch_size, lr), "param string, i int, j int, v double")
                    .groupBy("param", "i", "j").agg(F.sum("v").alias("v")).collect())   # the size of the model
            found = {(r["param"], r["i"], r["j"]): r["v"] for r in sums}
            seen = found["n", 0, 0]
            model = Model.zeros(*model.W.shape)
            for (param, i, j), v in found.items():
                if param == WEIGHTS:
                    model.W[i, j] = v / seen
                elif param == BIASES:
                    model.b[j] = v / seen
            done.append((epoch, found["loss", 0, 0] / seen, int(seen), int(found["replicas", 0, 0])))
    finally:
        dealt.unpersist()
    return LocalFit(model, done)
