"""Model-fitting and scoring queries over ``embeddings``.

Features: ``embeddings`` as ``(id, features, label, split)``; a fifth of the ids
(by the key hash) are test rows.  "Scores without a model" are all feature
values of a row.  Fitted models come from Spark jobs (numpy inside tasks); the
oracles replay the same fixed number of steps in SQL.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators import linear as LIN
from ..operators import metrics as MET
from ..operators import momentum as MOM
from ..operators import splits as S
from ..operators import sync_fit as SF
from ..session import scratch_path
from ..sources.tables import table
from . import ml_sql as Q
from .registry import query

log = logging.getLogger(__name__)
TEST_CUT = Q.TEST_CUT
EVAL_SCHEMA = "batch_id long, hits long, examples long, cum_hits long, cum_examples long, precision double"
FIT_STEPS = 3
EVAL_BATCH = 32
LOCAL_ROWS = 256       # rows of a replica of local SGD
REPLICAS = 3           # replicas whose gradients are averaged
EVENT_BATCH = 1000
# Per-group rates and momentum of the reference's optimizer.
GROUP_RATES = {LIN.WEIGHTS: 0.001, LIN.BIASES: 0.002}
MOMENTUM = 0.9


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: ``(id, features, label, split)`` – test rows by seeded key hash."""
    e = table(spark, sf_dir, "embeddings")
    split = F.when(S.key_hash("vec_id", "split") < F.lit(TEST_CUT), "test").otherwise("train")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label",
                    split.alias("split"))


def train_rows(spark, sf_dir) -> DataFrame:
    return features(spark, sf_dir).where(F.col("split") == "train")


def _round_model(df: DataFrame, cols=("value",)) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def fit3(spark, sf_dir, on_step=None) -> LIN.FitResult:
    return LIN.fit_full(train_rows(spark, sf_dir), FIT_STEPS, LIN.LEARNING_RATE, on_step=on_step)


# ---------------------------------------------------------- SQL fragments
FEAT_ONLY = "WITH " + Q.FEAT_CTE
SCORES_LONG = f"""SC AS (SELECT id, label, split, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS j,
  CAST(unnest(f) AS DOUBLE) AS s FROM (SELECT id, label, split, features AS f FROM FEAT))"""


# ------------------------------------------------------------ scoring queries
@query("src_features", oracle=FEAT_ONLY + "\nSELECT id, features, label, split FROM FEAT")
def src_features(spark, sf_dir):
    """SRC-5: labelled features with a seeded train/test split."""
    return features(spark, sf_dir)


@query("softmax_scores", oracle=FEAT_ONLY + ",\n" + SCORES_LONG + """,
ZZ AS (SELECT id, j, s - max(s) OVER (PARTITION BY id) AS z FROM SC)
SELECT id, j, round(exp(z) / sum(exp(z)) OVER (PARTITION BY id), 6) AS p FROM ZZ""")
def softmax_scores(spark, sf_dir):
    """SCL-9: softmax of all feature values, long form ``(id, j, p)``."""
    f = features(spark, sf_dir)
    return f.select("id", F.posexplode(A.softmax("features")).alias("j", "p")) \
        .select("id", "j", F.round("p", 6).alias("p"))


@query("ml_accuracy", oracle=Q.full_batch_fit(FIT_STEPS) + ",\n" + Q.scores_cte(FIT_STEPS) + """,
BEST AS (SELECT id, min(j) AS j FROM (SELECT id, j, s, max(s) OVER (PARTITION BY id) AS m FROM SC) WHERE s = m GROUP BY id)
SELECT split, count(*) AS examples, CAST(sum(CASE WHEN j = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
  round(avg(CASE WHEN j = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM FEAT JOIN BEST ON FEAT.id = BEST.id GROUP BY split""")
def ml_accuracy(spark, sf_dir):
    """AGG-7 / SCL-7: accuracy of the three-step model, argmax (first of ties) against the label, per split."""
    scored = LIN.linear_scores(features(spark, sf_dir), fit3(spark, sf_dir).model)
    f = scored.withColumn("ok", (A.argmax("scores") == F.col("label")).cast("int"))
    return f.groupBy("split").agg(F.count(F.lit(1)).alias("examples"), F.sum("ok").alias("correct"),
                                  F.round(F.avg(F.col("ok").cast("double")), 6).alias("accuracy"))


@query("ml_top1", oracle=FEAT_ONLY + f"\nSELECT id, features[label + 1] >= list_max(features) AS hit FROM FEAT")
def ml_top1(spark, sf_dir):
    """SCL-8: ``in_top_k(k=1)`` – ties count as hits."""
    return features(spark, sf_dir).select("id", A.top1_hit("features", "label").alias("hit"))


@query("cross_entropy", oracle=FEAT_ONLY + ",\n" + SCORES_LONG + """,
LSE AS (SELECT id, split, label, max(s) + ln(sum(exp(s - m))) AS lse, max(CASE WHEN j = label THEN s END) AS sl
  FROM (SELECT *, max(s) OVER (PARTITION BY id) AS m FROM SC) GROUP BY id, split, label)
SELECT split, count(*) AS examples, round(avg(lse - sl), 6) AS loss FROM LSE GROUP BY split""")
def cross_entropy(spark, sf_dir):
    """ML-2: mean cross-entropy (log-sum-exp form) of all feature values as scores, per split."""
    f = features(spark, sf_dir).withColumn("ce", A.cross_entropy("features", "label"))
    return f.groupBy("split").agg(F.count(F.lit(1)).alias("examples"), F.round(F.avg("ce"), 6).alias("loss"))


@query("standardize", oracle=FEAT_ONLY + """,
V AS (SELECT id, i, x, avg(x) OVER (PARTITION BY id) AS mu, count(*) OVER (PARTITION BY id) AS n FROM X),
SD AS (SELECT id, i, x, mu, n, sqrt(avg((x - mu) * (x - mu)) OVER (PARTITION BY id)) AS sd FROM V)
SELECT id, i, round((x - mu) / greatest(sd, 1.0 / sqrt(n)), 6) AS z FROM SD""")
def standardize(spark, sf_dir):
    """SCL-12: per-row standardisation, divisor bounded below by 1/sqrt(n)."""
    f = features(spark, sf_dir)
    return f.select("id", F.posexplode(A.standardize("features")).alias("i", "z")) \
        .select("id", "i", F.round("z", 6).alias("z"))


@query("variable_summary", oracle="""SELECT * FROM (
  SELECT 'l_quantity' AS variable, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS stddev,
    max(l_quantity) AS max, min(l_quantity) AS min FROM lineitem
  UNION ALL SELECT 'l_extendedprice', round(avg(l_extendedprice), 6), round(stddev_pop(l_extendedprice), 6),
    max(l_extendedprice), min(l_extendedprice) FROM lineitem
  UNION ALL SELECT 'l_discount', round(avg(l_discount), 6), round(stddev_pop(l_discount), 6),
    max(l_discount), min(l_discount) FROM lineitem)""")
def variable_summary(spark, sf_dir):
    """AGG-8: mean, population stddev, max, min of three lineitem columns."""
    li = table(spark, sf_dir, "lineitem")
    s = MET.variable_summary(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return s.select("variable", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
                    "max", "min")


def _hist_sql(c: str) -> str:
    return f"""SELECT '{c}' AS variable, CAST(CASE WHEN hi = lo THEN 0
    ELSE least(floor((CAST({c} AS DOUBLE) - lo) / ((hi - lo) / 10)), 9) END AS INTEGER) AS bucket, count(*) AS count
  FROM (SELECT {c}, (SELECT CAST(min({c}) AS DOUBLE) FROM lineitem) AS lo,
               (SELECT CAST(max({c}) AS DOUBLE) FROM lineitem) AS hi FROM lineitem)
  WHERE {c} IS NOT NULL GROUP BY 1, 2"""


@query("variable_histogram", oracle=" UNION ALL ".join(
    _hist_sql(c) for c in ["l_quantity", "l_extendedprice", "l_discount"]))
def variable_histogram(spark, sf_dir):
    """AGG-8 histogram: exact counts in 10 equal-width bins per column."""
    return MET.variable_histogram(table(spark, sf_dir, "lineitem"),
                                  ["l_quantity", "l_extendedprice", "l_discount"])


@query("l2_penalty", oracle=FEAT_ONLY + f"\nSELECT round(sum(x * x) / 2 * {MET.WEIGHT_DECAY}, 6) AS penalty FROM X")
def l2_penalty(spark, sf_dir):
    """SCL-15: ``decay · Σ w² / 2`` over every feature value taken as a weight."""
    f = features(spark, sf_dir).select(F.explode("features").alias("value"))
    return MET.l2_penalty(f).select(F.round("penalty", 6).alias("penalty"))


# ------------------------------------------------------------- gradients
GRAD_ROWS = """
SELECT 'softmax/weights' AS param, i, j, round(G.g, 6) AS g
FROM (SELECT X.i, D.j, sum(X.x * D.d) AS g FROM X JOIN D0 D ON X.id = D.id GROUP BY X.i, D.j) G
UNION ALL
SELECT 'softmax/biases', 0, j, round(sum(d), 6) FROM D0 GROUP BY j"""


@query("softmax_gradient", oracle=Q.full_batch_fit(1) + GRAD_ROWS)
def softmax_gradient(spark, sf_dir):
    """ML-4: mean gradient of the cross-entropy at the zero model, train rows."""
    tr = train_rows(spark, sf_dir)
    g = LIN.gradient_frame(tr, LIN.Model.zeros(LIN.feature_dim(tr), 10))
    return g.select("param", "i", "j", F.round("g", 6).alias("g"))


@query("gradient_average", oracle=Q.momentum_fit(1, 0.0, 0.0, 0.0, REPLICAS) + GRAD_ROWS)
def gradient_average(spark, sf_dir):
    """AGG-11: mean of three replicas' mean gradients, each over its own rows."""
    tr = train_rows(spark, sf_dir)
    g = LIN.replica_average(tr, LIN.Model.zeros(LIN.feature_dim(tr), 10), REPLICAS)
    return g.select("param", "i", "j", F.round("g", 6).alias("g"))


@query("softmax_fit_3", oracle=Q.full_batch_fit(FIT_STEPS) + "\n" + Q.model_rows(FIT_STEPS))
def softmax_fit_3(spark, sf_dir):
    """ML-5: three full-batch steps ``w -= 0.01 · g`` from zeros."""
    return _round_model(fit3(spark, sf_dir).model.to_frame(spark))


@query("linear_scores", oracle=Q.full_batch_fit(FIT_STEPS) + ",\n" + Q.scores_cte(FIT_STEPS) +
       "\nSELECT id, j, round(s, 6) AS score FROM SC")
def linear_scores(spark, sf_dir):
    """ML-1: ``xW + b`` for every row under the three-step model (Arrow batches)."""
    m = fit3(spark, sf_dir).model
    sc = LIN.linear_scores(features(spark, sf_dir), m)
    return sc.select("id", F.posexplode("scores").alias("j", "score")) \
        .select("id", "j", F.round("score", 6).alias("score"))


@query("linear_scores_sql", oracle=Q.full_batch_fit(FIT_STEPS) + ",\n" + Q.scores_cte(FIT_STEPS) +
       "\nSELECT id, j, round(s, 6) AS score FROM SC")
def linear_scores_sql(spark, sf_dir):
    """ML-1 relational form: exploded features ⋈ the (bounded) weight table."""
    m = fit3(spark, sf_dir).model
    sc = LIN.linear_scores_sql(features(spark, sf_dir), m.to_frame(spark))
    return sc.select("id", "j", F.round("score", 6).alias("score"))


@query("total_loss", oracle=Q.full_batch_fit(FIT_STEPS) + ",\n" + Q.scores_cte(FIT_STEPS, "TR") + f""",
CE AS (SELECT SC.id, max(s) + ln(sum(exp(s - m))) - max(CASE WHEN SC.j = TR.label THEN s END) AS ce
  FROM (SELECT *, max(s) OVER (PARTITION BY id) AS m FROM SC) SC JOIN TR ON SC.id = TR.id GROUP BY SC.id),
P AS (SELECT sum(w * w) / 2 * {MET.WEIGHT_DECAY} AS penalty FROM W{FIT_STEPS})
SELECT round(avg(ce), 6) AS cross_entropy, round((SELECT penalty FROM P), 6) AS penalty,
  round(avg(ce) + (SELECT penalty FROM P), 6) AS total_loss FROM CE""")
def total_loss(spark, sf_dir):
    """ML-3: mean cross-entropy + weight penalty (weights only, counted once)."""
    m = fit3(spark, sf_dir).model
    sc = LIN.linear_scores(train_rows(spark, sf_dir), m)
    ce = sc.agg(F.avg(A.cross_entropy("scores", "label")).alias("ce")).first()["ce"]
    w = m.to_frame(spark).where(F.col("param") == LIN.WEIGHTS)
    pen = MET.l2_penalty(w).first()["penalty"]
    return spark.range(1).select(F.round(F.lit(ce), 6).alias("cross_entropy"),
                                 F.round(F.lit(pen), 6).alias("penalty"),
                                 F.round(F.lit(ce + pen), 6).alias("total_loss"))


# ---------------------------------------------------------------- momentum
@query("momentum_step", oracle=Q.momentum_fit(2, GROUP_RATES[LIN.WEIGHTS], GROUP_RATES[LIN.BIASES], MOMENTUM)
       + "\n" + Q.model_rows(2, with_velocity=True))
def momentum_step(spark, sf_dir):
    """ML-9 + JN-5: two full-batch momentum steps, per-group rate and momentum."""
    tr = train_rows(spark, sf_dir)
    groups = MOM.param_groups([(LIN.WEIGHTS, GROUP_RATES[LIN.WEIGHTS], MOMENTUM),
                                      (LIN.BIASES, GROUP_RATES[LIN.BIASES], MOMENTUM)])
    params = MOM.fit_momentum(tr, steps=2, groups=groups)
    return _round_model(params, ("value", "velocity"))


CENTROID_SQL = f"""WITH RECURSIVE {Q.FEAT_CTE},
BT AS MATERIALIZED (SELECT id, (row_number() OVER (ORDER BY {Q.HASH.format(c='id', epoch=0, seed='batch')}, id) - 1) // {LIN.BATCH_SIZE} AS k
  FROM TR),
N AS MATERIALIZED (SELECT k, count(*) AS n FROM BT GROUP BY k),
G AS MATERIALIZED (SELECT k, label, i, count(*) AS rows, sum(x) AS sx FROM X JOIN BT ON X.id = BT.id GROUP BY k, label, i),
C AS (SELECT CAST(0 AS BIGINT) AS k, CAST(l AS INTEGER) AS label, CAST(d AS INTEGER) AS i, CAST(0.0 AS DOUBLE) AS value,
    CAST(0.0 AS DOUBLE) AS velocity FROM range(10) a(l), range((SELECT max(i) + 1 FROM X)) b(d)
  UNION ALL
  SELECT C.k + 1, C.label, C.i,
    CASE WHEN rows IS NULL THEN value ELSE value - 0.01 * ({MOMENTUM} * velocity + (rows * value - sx) / n) END,
    CASE WHEN rows IS NULL THEN velocity ELSE {MOMENTUM} * velocity + (rows * value - sx) / n END
  FROM C JOIN N ON N.k = C.k LEFT JOIN G ON G.k = C.k AND G.label = C.label AND G.i = C.i)
SELECT label, i, round(value, 6) AS value, round(velocity, 6) AS velocity FROM C WHERE k = (SELECT count(*) FROM N)"""


@query("momentum_sparse", oracle=CENTROID_SQL)
def momentum_sparse(spark, sf_dir):
    """ML-10: sparse momentum on class centroids – only classes present in the
    mini-batch are touched; the others keep value and velocity."""
    tr = train_rows(spark, sf_dir)
    return _round_model(MOM.fit_centroids_sparse(tr, lr=0.01, momentum=MOMENTUM),
                        ("value", "velocity"))


# ------------------------------------------------- synchronous and local fits
def sync_fit(spark: SparkSession, sf_dir: str) -> SF.SyncFit:
    """ML-7: the whole schedule, 20 epochs of int(n / 128) updates of 3 x 128 rows."""
    return SF.fit_sync(train_rows(spark, sf_dir))


SYNC_SQL = Q.sync_fit(LIN.EPOCHS, LIN.SYNC_BATCH_SIZE, LIN.SYNC_WORKERS, LIN.LEARNING_RATE)


@query("softmax_fit_sync", oracle=SYNC_SQL + "\n" + Q.last_model("SYNC"))
def softmax_fit_sync(spark, sf_dir):
    """ML-7: the model after the whole synchronous fit."""
    return _round_model(sync_fit(spark, sf_dir).model.to_frame(spark))


@query("softmax_fit_local", oracle=Q.local_fit(LIN.EPOCHS, LIN.BATCH_SIZE, LOCAL_ROWS, LIN.LEARNING_RATE) + "\n" + Q.last_model("LOCAL"))
def softmax_fit_local(spark, sf_dir):
    """ML-8 re-aimed: local SGD (batch 32) on replicas of about 256 rows, their models averaged each epoch."""
    return _round_model(SF.fit_local(train_rows(spark, sf_dir), rows_per_replica=LOCAL_ROWS).model.to_frame(spark))


@query("softmax_fit_momentum", oracle=Q.momentum_fit(10, GROUP_RATES[LIN.WEIGHTS], GROUP_RATES[LIN.BIASES], MOMENTUM, REPLICAS)
       + "\n" + Q.model_rows(10, with_velocity=True))
def softmax_fit_momentum(spark, sf_dir):
    """ML-11: replicas' gradients averaged, momentum update per group, 10 steps."""
    tr = train_rows(spark, sf_dir)
    groups = MOM.param_groups([(LIN.WEIGHTS, GROUP_RATES[LIN.WEIGHTS], MOMENTUM),
                                      (LIN.BIASES, GROUP_RATES[LIN.BIASES], MOMENTUM)])
    return _round_model(MOM.fit_momentum(tr, steps=10, groups=groups, replicas=REPLICAS), ("value", "velocity"))


@query("ml_metrics", oracle=SYNC_SQL + "\n" + Q.sync_metrics(LIN.SYNC_BATCH_SIZE, LIN.SYNC_WORKERS))
def ml_metrics(spark, sf_dir):
    """SNK-8 / SCL-13: loss, examples and hits of every update of the synchronous fit, read back from its written table (which holds the clock too)."""
    m = sync_fit(spark, sf_dir).metrics(spark)
    return m.select("step", "epoch", F.round("loss", 6).alias("loss"), "examples", "hits")


@query("ml_histograms", oracle=SYNC_SQL + "\n" + Q.sync_histograms(SF.EDGES.tolist(), SF.HISTOGRAM_STEPS))
def ml_histograms(spark, sf_dir):
    """SNK-8: value counts of each variable every 10 updates, in fixed buckets that add up; here all updates together."""
    h = sync_fit(spark, sf_dir).histograms(spark).where(F.col("name").isin(LIN.WEIGHTS, LIN.BIASES))
    return h.groupBy("name", "bucket").agg(F.sum("count").alias("count"), F.countDistinct("step").alias("steps"))


@query("ml_sync_accuracy", oracle=SYNC_SQL + "\n" + Q.sync_accuracy())
def ml_sync_accuracy(spark, sf_dir):
    """AGG-7: accuracy per split after the whole synchronous fit, as the trainers end with it."""
    scored = LIN.linear_scores(features(spark, sf_dir), sync_fit(spark, sf_dir).model)
    f = scored.withColumn("ok", (A.argmax("scores") == F.col("label")).cast("int"))
    return f.groupBy("split").agg(F.count(F.lit(1)).alias("examples"), F.sum("ok").alias("correct"),
                                  F.round(F.avg(F.col("ok").cast("double")), 6).alias("accuracy"))


# --------------------------------------------------- checkpoints, evaluation
def saved_checkpoints(spark: SparkSession, sf_dir: str) -> str:
    """SNK-7: the three-step fit saved at steps ``s % 100 == 0`` or last."""
    path = scratch_path(spark, "model-ckpt")
    keep = set(MET.checkpoint_steps(FIT_STEPS))
    step = {"s": 0}

    def save(m: LIN.Model) -> None:
        s = step["s"]
        if s in keep:
            m.to_frame(spark).withColumn("step", F.lit(s).cast("int")) \
                .write.mode("append").partitionBy("step").parquet(path)
        step["s"] += 1

    fit3(spark, sf_dir, on_step=save)
    return path


@query("ml_checkpoint", oracle=Q.full_batch_fit(FIT_STEPS) + f"""
SELECT 0 AS step, * FROM ({Q.model_rows(1)})
UNION ALL SELECT {FIT_STEPS - 1} AS step, * FROM ({Q.model_rows(FIT_STEPS)})""")
def ml_checkpoint(spark, sf_dir):
    """SNK-7: saved steps 0 and the last, read back (partitioned by step)."""
    return _round_model(spark.read.parquet(saved_checkpoints(spark, sf_dir))
                        .select("step", "param", "i", "j", "value"))


EVAL_SQL = Q.full_batch_fit(FIT_STEPS) + ",\n" + Q.scores_cte(FIT_STEPS, "(SELECT id FROM FEAT WHERE split = 'test')") + f""",
HIT AS (SELECT SC.id, max(CASE WHEN SC.j = F.label THEN s END) >= max(s) AS hit
  FROM SC JOIN FEAT F ON SC.id = F.id GROUP BY SC.id),
NUM AS (SELECT id, hit, row_number() OVER (ORDER BY id) - 1 AS pos, count(*) OVER () AS n FROM HIT),
BATCH AS (SELECT CAST(pos // {EVAL_BATCH} AS BIGINT) AS batch_id, CAST(sum(CAST(hit AS BIGINT)) AS BIGINT) AS hits, count(*) AS examples
  FROM NUM WHERE pos < (n // {EVAL_BATCH}) * {EVAL_BATCH} GROUP BY 1)
SELECT batch_id, hits, examples, CAST(sum(hits) OVER (ORDER BY batch_id) AS BIGINT) AS cum_hits,
  CAST(sum(examples) OVER (ORDER BY batch_id) AS BIGINT) AS cum_examples,
  round(sum(hits) OVER (ORDER BY batch_id) / sum(examples) OVER (ORDER BY batch_id), 6) AS precision FROM BATCH"""


def _batch_precision(scored: DataFrame, batch: int) -> DataFrame:
    hits = scored.select("id", A.top1_hit("scores", "label").cast("long").alias("hit"))
    b = S.fixed_batches(hits, "id", batch)
    per = b.groupBy("batch_id").agg(F.sum("hit").alias("hits"), F.count(F.lit(1)).alias("examples"))
    rp = MET.running_precision(per)
    return rp.select("batch_id", "hits", "examples", "cum_hits", "cum_examples",
                     F.round("precision", 6).alias("precision"))


def evaluate(rows: DataFrame, saved: DataFrame) -> DataFrame:
    """Running precision of the newest saved model; without any, that is logged and the table is empty."""
    newest = MET.latest(saved)
    if newest.isEmpty():
        log.warning("no checkpoint to evaluate")
        return rows.sparkSession.createDataFrame([], EVAL_SCHEMA)
    return _batch_precision(LIN.linear_scores(rows, LIN.Model.from_frame(newest)), EVAL_BATCH)


@query("evaluate_running", oracle=EVAL_SQL)
def evaluate_running(spark, sf_dir):
    """ML-12: restore the newest checkpoint, score test rows batch by batch
    (batches of 32 by id, rest dropped), running precision."""
    saved = spark.read.parquet(saved_checkpoints(spark, sf_dir))
    test = features(spark, sf_dir).where(F.col("split") == "test")
    return evaluate(test, saved)


RUNNING_SQL = FEAT_ONLY + f""",
NUM AS (SELECT id, features[label + 1] >= list_max(features) AS hit, row_number() OVER (ORDER BY id) - 1 AS pos,
  count(*) OVER () AS n FROM FEAT),
BATCH AS (SELECT CAST(pos // {EVAL_BATCH} AS BIGINT) AS batch_id, CAST(sum(CAST(hit AS BIGINT)) AS BIGINT) AS hits, count(*) AS examples
  FROM NUM WHERE pos < (n // {EVAL_BATCH}) * {EVAL_BATCH} GROUP BY 1)
SELECT batch_id, hits, examples, CAST(sum(hits) OVER (ORDER BY batch_id) AS BIGINT) AS cum_hits,
  CAST(sum(examples) OVER (ORDER BY batch_id) AS BIGINT) AS cum_examples,
  round(sum(hits) OVER (ORDER BY batch_id) / sum(examples) OVER (ORDER BY batch_id), 6) AS precision FROM BATCH"""


@query("running_precision", oracle=RUNNING_SQL)
def running_precision(spark, sf_dir):
    """AGG-9: cumulative hits / examples after each batch of 32 (feature values as scores)."""
    f = features(spark, sf_dir).select("id", "label", F.col("features").alias("scores"))
    return _batch_precision(f, EVAL_BATCH)


# ------------------------------------------------------- batches of events
EVENT_NUM = f"""EN AS (SELECT event_id, ts, value, row_number() OVER (ORDER BY event_id) - 1 AS pos,
  count(*) OVER () AS n FROM events),
EB AS (SELECT CAST(pos // {EVENT_BATCH} AS BIGINT) AS batch_id, * FROM EN WHERE pos < (n // {EVENT_BATCH}) * {EVENT_BATCH})"""


def event_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return S.fixed_batches(ev, "event_id", EVENT_BATCH)


@query("fixed_batches", oracle="WITH " + EVENT_NUM + """
SELECT batch_id, count(*) AS rows, min(event_id) AS first_event, max(event_id) AS last_event FROM EB GROUP BY 1""")
def fixed_batches(spark, sf_dir):
    """ML-13: batches of 1000 events by id; the trailing partial batch is dropped."""
    return event_batches(spark, sf_dir).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"))


@query("throughput", oracle="WITH " + EVENT_NUM + """,
PB AS (SELECT batch_id, count(*) AS examples, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM EB GROUP BY 1)
SELECT batch_id, examples, round(seconds, 6) AS seconds, round(examples / seconds, 6) AS examples_per_sec,
  round(seconds, 6) AS sec_per_batch, round(avg(examples / seconds) OVER (), 6) AS mean_examples_per_sec FROM PB""")
def throughput(spark, sf_dir):
    """AGG-10: examples/s and s/batch per batch of events (span of ``ts``), and the mean rate."""
    # zone-free span of the wall-clock timestamps (a cast to TIMESTAMP would
    # depend on the session time zone across daylight-saving changes)
    per = event_batches(spark, sf_dir).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("examples"),
        (F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")) / F.lit(1e6)).alias("seconds"))
    t = MET.throughput(per)
    return t.select("batch_id", "examples", *[F.round(c, 6).alias(c) for c in
                                             ["seconds", "examples_per_sec", "sec_per_batch", "mean_examples_per_sec"]])


@query("ml_block_loss", oracle="WITH " + EVENT_NUM + """,
ST AS (SELECT batch_id + 1 AS step, avg(value) AS loss FROM EB GROUP BY 1),
W AS (SELECT greatest(count(*) // 20, 1) AS w, count(*) AS steps FROM ST)
SELECT CAST((step - 1) // (SELECT w FROM W) AS BIGINT) AS block,
  round(sum(loss) / (SELECT w FROM W), 6) AS block_loss, count(*) AS steps
FROM ST WHERE step <= ((SELECT steps FROM W) // (SELECT w FROM W)) * (SELECT w FROM W) GROUP BY 1""")
def ml_block_loss(spark, sf_dir):
    """AGG-6: step loss = mean event value per batch; block means over
    ``int(steps/20)`` steps, trailing partial block dropped."""
    steps = event_batches(spark, sf_dir).groupBy("batch_id").agg(F.avg("value").alias("loss")) \
        .select((F.col("batch_id") + 1).alias("step"), "loss")
    total = steps.count()
    b = MET.block_mean_loss(steps, total)
    return b.select("block", F.round("block_loss", 6).alias("block_loss"), "steps")


@query("ml_epoch_loss", oracle=f"""WITH {Q.FEAT_CTE},
CE AS (SELECT id, list_max(l) + ln(list_sum(list_transform(l, lambda v: exp(v - list_max(l))))) - l[label + 1] AS ce
  FROM (SELECT id, label, CAST(features AS DOUBLE[]) AS l FROM FEAT WHERE split = 'train')),
E AS (SELECT CAST(e AS INTEGER) AS epoch, ce,
  (row_number() OVER (PARTITION BY e ORDER BY {Q.HASH.format(c='id', epoch='e', seed='batch')}, id) - 1) // {LIN.BATCH_SIZE} AS k
  FROM CE, range({LIN.EPOCHS}) t(e)),
BL AS (SELECT epoch, k, avg(ce) AS loss FROM E GROUP BY epoch, k)
SELECT epoch, round(avg(loss), 6) AS avg_cost, count(*) AS batches FROM BL GROUP BY epoch""")
def ml_epoch_loss(spark, sf_dir):
    """AGG-5: per epoch, Σ batch-mean loss / number of batches (all feature values as
    scores, 20 epochs, batches of 32 in the order of the seeded hash)."""
    tr = train_rows(spark, sf_dir).select("id", A.cross_entropy("features", "label").alias("ce"))
    batches = S.epoch_batches(tr, "id", LIN.BATCH_SIZE, LIN.EPOCHS)
    agg = MET.epoch_mean_loss(batches.groupBy("epoch", "batch_id").agg(F.avg("ce").alias("loss")))
    return agg.select("epoch", F.round("avg_cost", 6).alias("avg_cost"), "batches")


# ------------------------------------------------- parameter groups (part)
# The parameter groups of the schedule queries – (pattern,
# start rate, target factor, stairs, momentum), in matching order.  An exact
# name comes first whatever its position.
SCHEDULE_GROUPS = [
    ("ring$", 0.001, 250.0, 4, 0.9),
    ("^ECONOMY", 0.002, 10.0, 2, 0.9),
    ("bolt|widget", 0.005, 10.0, 3, 0.5),
    ("SMALL/blue_bolt", 0.1, 2.0, 2, 0.0),
]


def part_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter names from part: ``<p_type>/<p_name with _ for blanks>`` and a step (the key)."""
    p = table(spark, sf_dir, "part")
    return p.select(F.concat_ws("/", "p_type", F.regexp_replace("p_name", " ", "_")).alias("param"),
                    F.col("p_partkey").alias("step"))


PARAM_SQL = "SELECT p_type || '/' || replace(p_name, ' ', '_') AS param, p_partkey AS step FROM part"


def _match_sql() -> str:
    exact = " ".join(f"WHEN param = '{p}' THEN {k}" for k, (p, *_r) in enumerate(SCHEDULE_GROUPS))
    found = " ".join(f"WHEN regexp_matches(param, '{p}') THEN {k}" for k, (p, *_r) in enumerate(SCHEDULE_GROUPS))
    return f"(CASE {exact} ELSE (CASE {found} ELSE -1 END) END)"


GROUPS_SQL = " UNION ALL ".join(
    f"SELECT {k} AS g, '{p}' AS pattern, CAST({lr} AS DOUBLE) AS lr, CAST({f} AS DOUBLE) AS f, {n} AS n, "
    f"CAST({m} AS DOUBLE) AS m"
    for k, (p, lr, f, n, m) in enumerate(SCHEDULE_GROUPS))


@query("param_match", oracle=f"""WITH P AS (SELECT DISTINCT param FROM ({PARAM_SQL})),
G AS ({GROUPS_SQL})
SELECT P.param, coalesce(G.pattern, 'default') AS "group", coalesce(G.lr, CAST(0.02 AS DOUBLE)) AS learning_rate,
  coalesce(G.m, CAST(0.9 AS DOUBLE)) AS momentum FROM P LEFT JOIN G ON G.g = {_match_sql()}""")
def param_match(spark, sf_dir):
    """JN-5: exact name, else first pattern found, else ``default`` (0.02, 0.9)."""
    groups = MOM.param_groups([(p, lr, m) for p, lr, _f, _n, m in SCHEDULE_GROUPS])
    return MOM.match_params(part_params(spark, sf_dir), groups)


@query("lr_schedule", oracle=f"""WITH P AS ({PARAM_SQL}), G AS ({GROUPS_SQL}),
T AS (SELECT count(*) AS total FROM part)
SELECT P.param, P.step, round(CASE WHEN G.g IS NULL THEN 0.02 ELSE
  G.lr * pow(pow(1.0 / G.f, 1.0 / (G.n - 1)), floor(P.step / ((SELECT total FROM T) / (G.n - 1)))) END, 9) AS learning_rate
FROM P LEFT JOIN G ON G.g = {_match_sql()}""")
def lr_schedule(spark, sf_dir):
    """SCL-6: staircase decay per matched group at step = part key, total = part rows."""
    pp = part_params(spark, sf_dir)
    total = float(pp.count())
    at = MOM.group_of(F.col("param"), SCHEDULE_GROUPS)
    lr = F.lit(0.02)
    for k, (_p, start, f, n, _m) in enumerate(SCHEDULE_GROUPS):
        lr = F.when(at == k, A.staircase_decay(start, f, n, total, "step")).otherwise(lr)
    return pp.select("param", "step", F.round(lr, 9).alias("learning_rate"))


# ------------------------------------------------------------- streaming
@query("stream_precision", oracle=FEAT_ONLY + f""",
NUM AS (SELECT id, features[label + 1] >= list_max(features) AS hit, row_number() OVER (ORDER BY id) - 1 AS pos,
  count(*) OVER () AS n FROM FEAT)
SELECT CAST(sum(CAST(hit AS BIGINT)) AS BIGINT) AS hits, count(*) AS examples,
  round(sum(CAST(hit AS BIGINT)) / count(*), 6) AS precision
FROM NUM WHERE pos < (n // {EVAL_BATCH}) * {EVAL_BATCH}""")
def stream_precision(spark, sf_dir):
    """STR-1: scored batches (32 rows by id, rest dropped) written as files, drained
    in triggers bounded by bytes with a stateful global aggregate; the final cumulative row."""
    from ..streaming.precision import final_row, stream_running_precision
    f = features(spark, sf_dir).select("id", A.top1_hit("features", "label").alias("hit"))
    b = S.fixed_batches(f, "id", EVAL_BATCH)
    src = scratch_path(spark, "scored-batches")
    b.write.parquet(src)
    schema = spark.read.parquet(src).schema
    cum = stream_running_precision(spark, src, schema)
    fr = final_row(cum)
    return fr.select("hits", "examples", F.round("precision", 6).alias("precision"))
