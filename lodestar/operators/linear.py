"""Linear softmax model fitted as Spark jobs (ML-1..11, AGG-11).

Data stay distributed: a feature table ``(id, features: array<float>,
label: int)``.  The model is small and bounded by ``dim × classes`` (it does
not grow with the data): it lives on the driver as numpy arrays between steps
and reaches the tasks inside the closure (a broadcast of a few KB).

One gradient evaluation is one Spark job: every partition computes its partial
sums with numpy over Arrow batches (``mapInPandas``) and emits them in long
form ``(param, i, j, v)``; with few partitions the driver adds the partials
itself, otherwise a ``groupBy(...).sum`` (partial + final aggregate, AGG-11)
combines them on the executors; ``dim × classes + classes + 3`` numbers come
back to the driver.  That is Spark's natural barrier for synchronous
data-parallel training (ML-7).  The asynchronous trainer (ML-8) is re-aimed as
local SGD per partition with model averaging once per round, because Spark
has no shared mutable parameters.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .splits import key_hash

# The reference's training settings.
LEARNING_RATE = 0.01
EPOCHS = 20
BATCH_SIZE = 32
SYNC_BATCH_SIZE = 128
SYNC_WORKERS = 3
WEIGHTS = "softmax/weights"
BIASES = "softmax/biases"
DIRECT_COMBINE_MAX = 64         # partitions whose partial sums the driver may add itself

PARTIAL_SCHEMA = "grp int, param string, i int, j int, v double"


@dataclass
class Model:
    W: np.ndarray                      # dim × classes
    b: np.ndarray                      # classes
    step: int = 0

    @staticmethod
    def zeros(dim: int, classes: int) -> "Model":
        return Model(np.zeros((dim, classes)), np.zeros(classes))

    def copy(self) -> "Model":
        return Model(self.W.copy(), self.b.copy(), self.step)

    def to_rows(self) -> list[tuple[str, int, int, float]]:
        rows = [(WEIGHTS, int(i), int(j), float(self.W[i, j]))
                for i in range(self.W.shape[0]) for j in range(self.W.shape[1])]
        rows += [(BIASES, 0, int(j), float(self.b[j])) for j in range(self.b.shape[0])]
        return rows

    def to_frame(self, spark) -> DataFrame:
        """Long table ``(param, i, j, value)``."""
        return spark.createDataFrame(self.to_rows(), "param string, i int, j int, value double")

    @staticmethod
    def from_frame(df: DataFrame) -> "Model":
        rows = df.select("param", "i", "j", "value").collect()   # dim × classes + classes rows
        if not rows:
            raise ValueError("no checkpoint: the model table has no rows")
        dim = 1 + max(r["i"] for r in rows if r["param"] == WEIGHTS)
        classes = 1 + max(r["j"] for r in rows)
        m = Model.zeros(dim, classes)
        for r in rows:
            if r["param"] == WEIGHTS:
                m.W[r["i"], r["j"]] = r["value"]
            else:
                m.b[r["j"]] = r["value"]
        return m


@dataclass
class Gradient:
    gW: np.ndarray
    gb: np.ndarray
    loss: float          # summed cross-entropy
    n: int
    hits: int

    @property
    def mean_loss(self) -> float:
        return self.loss / self.n if self.n else float("nan")


@dataclass
class FitResult:
    model: Model
    metrics: list[dict] = field(default_factory=list)   # one dict per step

    def metrics_frame(self, spark) -> DataFrame:
        cols = "step long, epoch int, loss double, examples long, seconds double, hits long"
        rows = [(m["step"], m["epoch"], m["loss"], m["examples"], m["seconds"], m["hits"])
                for m in self.metrics]
        return spark.createDataFrame(rows, cols)


# ------------------------------------------------------------ numpy kernels
def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64) if len(col) else np.zeros((0, 0))


def _probs(X: np.ndarray, W: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    S = X @ W + b
    S = S - S.max(axis=1, keepdims=True)
    E = np.exp(S)
    Z = E.sum(axis=1, keepdims=True)
    return E / Z, np.log(Z) - S      # probabilities, -log p for every class


def _partials(W: np.ndarray, b: np.ndarray,
              grouped: bool = False) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per-partition sums; with ``grouped`` one set of sums per ``_grp`` value
    met in the partition (a partition never gathers rows from elsewhere)."""
    dim, classes = W.shape

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, list] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            groups = pdf.groupby("_grp", sort=False) if grouped else [(0, pdf)]
            for g, part in groups:
                X = _matrix(part["features"])
                y = part["label"].to_numpy().astype(np.int64)
                P, nlp = _probs(X, W, b)
                idx = np.arange(len(y))
                a = acc.setdefault(int(g), [np.zeros((dim, classes)), np.zeros(classes), 0.0, 0, 0])
                a[2] += float(nlp[idx, y].sum())
                a[4] += int((P.argmax(axis=1) == y).sum())
                P[idx, y] -= 1.0
                a[0] += X.T @ P
                a[1] += P.sum(axis=0)
                a[3] += len(y)
        ii, jj = np.meshgrid(np.arange(dim), np.arange(classes), indexing="ij")
        for g, (gW, gb, loss, n, hits) in acc.items():
            size = dim * classes + classes + 3
            yield pd.DataFrame({
                "grp": np.full(size, g, dtype=np.int32),
                "param": [WEIGHTS] * (dim * classes) + [BIASES] * classes + ["loss", "n", "hits"],
                "i": np.concatenate([ii.ravel(), np.zeros(classes, dtype=int), [0, 0, 0]]).astype(np.int32),
                "j": np.concatenate([jj.ravel(), np.arange(classes), [0, 0, 0]]).astype(np.int32),
                "v": np.concatenate([gW.ravel(), gb, [loss, float(n), float(hits)]]),
            })
    return fn


def partial_gradients(features: DataFrame, model: Model, group: Column | None = None) -> DataFrame:
    """ML-4 + AGG-11: summed gradient of the summed cross-entropy, long form.

    Rows ``(grp, param, i, j, v)``; ``param`` also carries ``loss``, ``n``,
    ``hits``.  With ``group`` the sums are kept apart per group value.
    """
    cols = [F.col("features"), F.col("label")]
    if group is not None:
        cols.append(group.cast("int").alias("_grp"))
    parts = features.select(*cols).mapInPandas(_partials(model.W, model.b, group is not None),
                                               PARTIAL_SCHEMA)
    return parts.groupBy("grp", "param", "i", "j").agg(F.sum("v").alias("v"))


def direct_combine(features: DataFrame) -> bool:
    """Sum partition partials on the driver when there are few partitions
    (at most ``DIRECT_COMBINE_MAX`` × model-size numbers); otherwise let Spark's
    partial + final aggregate combine them on the executors."""
    return features.rdd.getNumPartitions() <= DIRECT_COMBINE_MAX


def gradient(features: DataFrame, model: Model, direct: bool | None = None) -> Gradient:
    """One job: the mean-able gradient sums (bounded: dim × classes values)."""
    dim, classes = model.W.shape
    gW = np.zeros((dim, classes))
    gb = np.zeros(classes)
    stats = {"loss": 0.0, "n": 0.0, "hits": 0.0}
    if direct is None:
        direct = direct_combine(features)
    if direct:
        rows = (features.select("features", "label")
                .mapInPandas(_partials(model.W, model.b), PARTIAL_SCHEMA).collect())
    else:
        rows = partial_gradients(features, model).collect()
    for r in rows:
        if r["param"] == WEIGHTS:
            gW[r["i"], r["j"]] += r["v"]
        elif r["param"] == BIASES:
            gb[r["j"]] += r["v"]
        else:
            stats[r["param"]] += r["v"]
    return Gradient(gW, gb, stats["loss"], int(stats["n"]), int(stats["hits"]))


def gradient_frame(features: DataFrame, model: Model, mean: bool = True) -> DataFrame:
    """ML-4 as a table ``(param, i, j, g)`` – the mean gradient over all rows."""
    g = partial_gradients(features, model)
    n = F.sum(F.when(F.col("param") == "n", F.col("v"))).over(_all())
    out = g.select("param", "i", "j", (F.col("v") / n).alias("g") if mean else F.col("v").alias("g"))
    return out.where(F.col("param").isin(WEIGHTS, BIASES))


def _all():
    from pyspark.sql import Window
    # The partial-gradient table has dim × classes + classes + 3 rows.
    return Window.partitionBy()


def replica_average(features: DataFrame, model: Model, replicas: int) -> DataFrame:
    """AGG-11 across replicas: rows split by a key hash into ``replicas``
    parts; each part's mean gradient is taken over its own rows, then the
    plain mean over the parts that have rows."""
    rep = F.pmod(key_hash("id", "replica"), F.lit(replicas))
    parts = partial_gradients(features, model, rep)
    # replicas × model-size rows
    sizes = parts.where(F.col("param") == "n").select("grp", F.col("v").alias("rows"))
    return (parts.where(F.col("param").isin(WEIGHTS, BIASES)).join(F.broadcast(sizes), "grp")
            .groupBy("param", "i", "j").agg(F.avg(F.col("v") / F.col("rows")).alias("g")))


def apply_sgd(model: Model, g: Gradient, lr: float) -> Model:
    """ML-5: ``w -= lr · mean gradient``."""
    m = model.copy()
    m.W -= lr * g.gW / g.n
    m.b -= lr * g.gb / g.n
    m.step += 1
    return m


def feature_dim(features: DataFrame) -> int:
    first = features.select(F.size("features").alias("d")).first()
    if first is None:
        raise ValueError("empty feature table")
    return int(first["d"])


# --------------------------------------------------------------------- fits
class _Cached:
    """Persist a feature table for the duration of a fit (every step re-reads it)."""

    def __init__(self, df: DataFrame):
        from pyspark import StorageLevel
        self.df = df.persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self) -> DataFrame:
        return self.df

    def __exit__(self, *exc) -> None:
        self.df.unpersist()


def fit_full(features: DataFrame, steps: int, lr: float = LEARNING_RATE, classes: int = 10,
             model: Model | None = None, on_step: Callable[[Model], None] | None = None) -> FitResult:
    """ML-5: full-batch gradient descent from zeros, one job per step."""
    with _Cached(features) as features:
        return _fit_full(features, steps, lr, classes, model, on_step)


def _fit_full(features, steps, lr, classes, model, on_step) -> FitResult:
    m = model or Model.zeros(feature_dim(features), classes)
    res = FitResult(m)
    direct = direct_combine(features)
    for s in range(steps):
        t0 = time.time()
        g = gradient(features, m, direct)
        m = apply_sgd(m, g, lr)
        res.metrics.append(dict(step=s, epoch=0, loss=g.mean_loss, examples=g.n,
                                seconds=time.time() - t0, hits=g.hits))
        if on_step:
            on_step(m)
    res.model = m
    return res


# ------------------------------------------------------------------ scoring
def _scorer(W: np.ndarray, b: np.ndarray):
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            S = _matrix(pdf["features"]) @ W + b
            out = pdf.drop(columns=["features"])
            out["scores"] = list(S)
            yield out
    return fn


def linear_scores(features: DataFrame, model: Model) -> DataFrame:
    """ML-1: ``xW + b`` per row as ``scores: array<double>`` (Arrow batches)."""
    keep = [f for f in features.schema.fields if f.name != "features"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep) + ", scores array<double>"
    return features.mapInPandas(_scorer(model.W, model.b), schema)


def linear_scores_sql(features: DataFrame, model_frame: DataFrame) -> DataFrame:
    """ML-1, relational form: ``posexplode`` ⋈ weights, ``sum(x · w)`` + bias.

    The model table has ``dim × classes`` rows, so its broadcast is bounded.
    """
    x = features.select("id", F.posexplode("features").alias("i", "x"))
    w = F.broadcast(model_frame.where(F.col("param") == WEIGHTS).select("i", "j", F.col("value").alias("w")))
    b = F.broadcast(model_frame.where(F.col("param") == BIASES).select("j", F.col("value").alias("b")))
    s = x.join(w, "i").groupBy("id", "j").agg(F.sum(F.col("x").cast("double") * F.col("w")).alias("s"))
    return s.join(b, "j").select("id", "j", (F.col("s") + F.col("b")).alias("score"))
