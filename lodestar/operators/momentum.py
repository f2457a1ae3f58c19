"""Momentum updates with per-group hyper-parameters (ML-9..11, JN-5).

Parameters are a long table ``(param, i, j, value, velocity)``; gradients
``(param, i, j, g)``.  A step is a join on the key and column arithmetic:

    v ← m · v + g ;  w ← w − lr · v        (Nesterov: w ← w − lr · (g + m · v))

Rows without a gradient (sparse update) keep value and velocity.  The rate and
momentum of a parameter come from the first matching group: an exact name
first, else the first pattern (in ``position`` order) found in the name, else
the default group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_if_small
from .linear import BIASES, WEIGHTS, Model, feature_dim, replica_average
from .splits import epoch_batches

# The default group used when no pattern matches.
DEFAULT_LEARNING_RATE = 0.02
DEFAULT_MOMENTUM = 0.9
MAX_HYPER_ROWS = 1_000_000   # rows of a rate table that is broadcast
CHUNK, FAN = 1024, 256       # mini-batches whose maps one group composes; results that the next level composes
MAP_SCHEMA = "place long, label int, a array<double>, u array<double>"


def param_groups(entries: list[tuple[str, float, float]]) -> list[tuple[str, float, float]]:
    """``(pattern, learning_rate, momentum)`` in the given order, which is the order of matching."""
    return [(p, float(lr), float(m)) for p, lr, m in entries]


def group_of(name: Column, entries: list[tuple]) -> Column:
    """JN-5: place of the group of ``name`` among ``entries`` (pattern first), or -1: an entry that is the name itself,
    else the first whose pattern is found in it (``rlike``, a search like Python's ``re.search``).

    The entries are the user's settings, a list on the driver; they become one ordered expression, evaluated row by row
    without a join or a shuffle."""
    patterns = [e[0] for e in entries]
    exact = F.coalesce(*[F.when(name == F.lit(p), F.lit(k)) for k, p in enumerate(patterns)], F.lit(None).cast("int")) if patterns else F.lit(None).cast("int")
    found = F.coalesce(*[F.when(name.rlike(p), F.lit(k)) for k, p in enumerate(patterns)], F.lit(-1))
    return F.coalesce(exact, found)


def match_params(names: DataFrame, groups: list[tuple[str, float, float]], name_col: str = "param",
                 default: tuple[float, float] = (DEFAULT_LEARNING_RATE, DEFAULT_MOMENTUM)) -> DataFrame:
    """JN-5: ``(param, group, learning_rate, momentum)`` per distinct name; the distinct is the only shuffle."""
    n = names.select(F.col(name_col).alias("param")).distinct()
    at = group_of(F.col("param"), groups)

    def of(field: int, other) -> Column:
        return F.coalesce(F.get(F.array(*[F.lit(g[field]) for g in groups], F.lit(other)), F.col("_g")), F.lit(other))

    found = n.withColumn("_g", at)
    return found.select("param", of(0, "default").alias("group"), of(1, float(default[0])).alias("learning_rate"), of(2, float(default[1])).alias("momentum"))


def apply_momentum(params: DataFrame, grads: DataFrame, hyper: DataFrame,
                   keys: tuple[str, ...] = ("param", "i", "j"), nesterov: bool = False) -> DataFrame:
    """ML-9 / ML-10: one momentum step; rows without a gradient are untouched."""
    h = broadcast_if_small(hyper.select("param", "learning_rate", "momentum"), MAX_HYPER_ROWS)
    j = params.join(h, "param").join(grads, list(keys), "left")
    g, v, w = F.col("g"), F.col("velocity"), F.col("value")
    v_new = F.col("momentum") * v + g
    step = (g + F.col("momentum") * v_new) if nesterov else v_new
    return j.select(*keys,
                    F.when(g.isNull(), w).otherwise(w - F.col("learning_rate") * step).alias("value"),
                    F.when(g.isNull(), v).otherwise(v_new).alias("velocity"))


def _relocalise(df: DataFrame) -> DataFrame:
    """Bring a bounded parameter table back as a fresh frame (cuts lineage)."""
    spark = df.sparkSession
    return spark.createDataFrame(df.collect(), df.schema)


def fit_momentum(features: DataFrame, steps: int, groups: list[tuple[str, float, float]], replicas: int = 1,
                 classes: int = 10, nesterov: bool = False) -> DataFrame:
    """ML-11: per step, the replicas' gradients are averaged (AGG-11) and one
    momentum update is applied with the matched group rates."""
    spark = features.sparkSession
    features = features.persist()
    model = Model.zeros(feature_dim(features), classes)
    params = model.to_frame(spark).withColumn("velocity", F.lit(0.0))
    hyper = match_params(params, groups)
    hyper = _relocalise(hyper)
    for _ in range(steps):
        m = Model.from_frame(params)
        grads = replica_average(features, m, replicas)
        params = _relocalise(apply_momentum(params, grads, hyper, nesterov=nesterov))
    features.unpersist()
    return params.select("param", "i", "j", "value", "velocity")


def _compose(maps: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One affine map ``x -> A x + u`` that does what the maps do one after another."""
    a, u = np.eye(2), np.zeros((2, maps[0][1].shape[1]))
    for b, v in maps:
        a, u = b @ a, b @ u + v
    return a, u


def _map_rows(place: int, label: int, a: np.ndarray, u: np.ndarray) -> pa.Table:
    return pa.table({"place": pa.array([place], pa.int64()), "label": pa.array([label], pa.int32()),
                     "a": pa.array([a.ravel().tolist()], pa.list_(pa.float64())), "u": pa.array([u.ravel().tolist()], pa.list_(pa.float64()))})


def fit_centroids_sparse(features: DataFrame, lr: float, momentum: float, batch_size: int = 32, classes: int = 10,
                         chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """ML-10 on class centroids ``C[label, i]`` with loss ``Σ ||x − C[label]||² / 2``,
    one whole epoch of mini-batches in the order of the seeded hash.

    The gradient exists only for classes present in the batch, so the others are not touched.  What a batch with ``r`` rows of a
    class does to its (value, velocity) is an affine map: ``v' = m v + (r c − Σx) / n``, ``c' = c − lr v'``.  Affine maps compose
    associatively, so a group composes the maps of ``chunk`` batches of a class, and groups of ``fan`` results compose those, level by level: one lazy job,
    no step of its own for a batch, and no group above ``chunk * batch_size`` rows however common a class is.
    """
    dim, total = feature_dim(features), features.count()
    batches = epoch_batches(features.select("id", "label", "features"), "id", batch_size)

    def first(table: pa.Table) -> pa.Table:
        ids = table["batch_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        X = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)[order]
        kinds, starts, rows = np.unique(ids[order], return_index=True, return_counts=True)
        sums = np.add.reduceat(X, starts, axis=0)
        maps = []
        for k, r, x in zip(kinds.tolist(), rows.tolist(), sums):
            n = min(batch_size, total - k * batch_size)
            maps.append((np.array([[1 - lr * r / n, -lr * momentum], [r / n, momentum]]), np.stack([lr * x / n, -x / n])))
        return _map_rows(kinds[0] // chunk, table["label"][0].as_py(), *_compose(maps))

    def more(table: pa.Table) -> pa.Table:
        order = np.argsort(table["place"].to_numpy(), kind="stable").tolist()
        a, u = table["a"].to_pylist(), table["u"].to_pylist()
        out = _compose([(np.array(a[i]).reshape(2, 2), np.array(u[i]).reshape(2, dim)) for i in order])
        return _map_rows(table["place"][0].as_py() // fan, table["label"][0].as_py(), *out)

    maps = batches.groupBy(F.floor(F.col("batch_id") / chunk).alias("_chunk"), "label").applyInArrow(first, MAP_SCHEMA)
    places = -(-(-(-total // batch_size)) // chunk)
    while places > 1:
        maps = maps.groupBy("label", F.floor(F.col("place") / fan).alias("_next")).applyInArrow(more, MAP_SCHEMA)
        places = -(-places // fan)
    # classes × dim rows; a class without rows keeps its zeros
    zeros = F.array_repeat(F.lit(0.0), 2 * dim)
    cent = (features.sparkSession.range(classes).select(F.col("id").cast("int").alias("label"))
            .join(maps.select("label", "u"), "label", "left").withColumn("u", F.coalesce("u", zeros)))
    i = F.explode(F.sequence(F.lit(0), F.lit(dim - 1))).alias("i")
    return (cent.select("label", "u", i)
            .select("label", "i", F.get("u", F.col("i")).alias("value"), F.get("u", F.col("i") + dim).alias("velocity")))


__all__ = ["param_groups", "match_params", "apply_momentum", "fit_momentum", "fit_centroids_sparse",
           "WEIGHTS", "BIASES"]
