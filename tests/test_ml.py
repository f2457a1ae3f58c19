from __future__ import annotations

import hashlib

import numpy as np
import pytest

from lodestar.functions import arrays as A
from lodestar.operators import linear as LIN
from lodestar.operators import metrics as MET
from lodestar.operators import momentum as MOM
from lodestar.operators import sync_fit as SF

RNG = np.random.default_rng(7)
N, D, K = 120, 6, 4
XS = RNG.standard_normal((N, D)).astype(np.float32)
YS = RNG.integers(0, K, N)


@pytest.fixture(scope="module")
def feats(spark):
    rows = [(i, [float(v) for v in XS[i]], int(YS[i])) for i in range(N)]
    return spark.createDataFrame(rows, "id long, features array<float>, label int").repartition(3).persist()


def np_grad(W, b, X, y):
    S = X.astype(np.float64) @ W + b
    S -= S.max(1, keepdims=True)
    P = np.exp(S) / np.exp(S).sum(1, keepdims=True)
    loss = -np.log(P[np.arange(len(y)), y]).sum()
    P[np.arange(len(y)), y] -= 1
    return X.T.astype(np.float64) @ P, P.sum(0), loss


def test_gradient_matches_numpy_and_finite_difference(feats):
    m = LIN.Model(RNG.standard_normal((D, K)) * 0.1, RNG.standard_normal(K) * 0.1)
    g = LIN.gradient(feats, m)
    gW, gb, loss = np_grad(m.W, m.b, XS, YS)
    assert g.n == N
    np.testing.assert_allclose(g.gW, gW, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(g.gb, gb, rtol=1e-9, atol=1e-9)
    assert abs(g.loss - loss) < 1e-7
    eps = 1e-6
    W2 = m.W.copy()
    W2[2, 1] += eps
    _, _, loss2 = np_grad(W2, m.b, XS, YS)
    assert abs((loss2 - loss) / eps - gW[2, 1]) < 1e-3


def test_direct_and_aggregated_combine_agree(feats):
    m = LIN.Model(RNG.standard_normal((D, K)) * 0.1, np.zeros(K))
    a, b = LIN.gradient(feats, m, direct=True), LIN.gradient(feats, m, direct=False)
    np.testing.assert_allclose(a.gW, b.gW, atol=1e-12)
    assert (a.n, a.hits) == (b.n, b.hits) and abs(a.loss - b.loss) < 1e-9


def test_replica_average_is_the_mean_of_the_replicas_means(feats):
    m = LIN.Model(RNG.standard_normal((D, K)) * 0.1, np.zeros(K))
    avg = {(r["param"], r["i"], r["j"]): r["g"] for r in LIN.replica_average(feats, m, 3).collect()}
    rep = np.array([int(hashlib.md5(f"{i}:0:replica".encode()).hexdigest()[:15], 16) % 3 for i in range(N)])
    sizes = [int((rep == r).sum()) for r in range(3)]
    assert min(sizes) > 0 and len(set(sizes)) > 1          # parts of unequal size
    parts = [np_grad(m.W, m.b, XS[rep == r], YS[rep == r]) for r in range(3)]
    gW = np.mean([p[0] / n for p, n in zip(parts, sizes)], axis=0)
    gb = np.mean([p[1] / n for p, n in zip(parts, sizes)], axis=0)
    assert len(avg) == D * K + K
    for (param, i, j), g in avg.items():
        assert abs(g - (gW[i, j] if param == LIN.WEIGHTS else gb[j])) < 1e-10


def test_full_fit_matches_numpy(feats):
    res = LIN.fit_full(feats, 3, 0.1, classes=K)
    W, b = np.zeros((D, K)), np.zeros(K)
    for _ in range(3):
        gW, gb, _ = np_grad(W, b, XS, YS)
        W -= 0.1 * gW / N
        b -= 0.1 * gb / N
    np.testing.assert_allclose(res.model.W, W, atol=1e-12)
    assert len(res.metrics) == 3


def _replay_local(order, X, y, W, b, batch, lr):
    for at in range(0, len(order), batch):
        own = order[at:at + batch]
        gW, gb, _ = np_grad(W, b, X[own], y[own])
        W, b = W - lr * gW / len(own), b - lr * gb / len(own)
    return W, b


@pytest.mark.parametrize("arrow_rows", [10000, 7])
@pytest.mark.parametrize("rows_per_replica", [1000, 30])
def test_local_sgd_replays_its_replicas(spark, feats, arrow_rows, rows_per_replica):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(arrow_rows))        # 7: mini-batches straddle Arrow batches
    try:
        res = SF.fit_local(feats, epochs=2, batch_size=16, lr=0.05, classes=K, rows_per_replica=rows_per_replica)
    finally:
        spark.conf.set(key, old)
    replicas = -(-N // rows_per_replica)
    of = [SF._hash60(f"{i}:0:replica") % replicas for i in range(N)]
    W, b = np.zeros((D, K)), np.zeros(K)
    for e in range(2):
        parts = []
        for r in sorted(set(of)):
            order = sorted((i for i in range(N) if of[i] == r), key=lambda i: SF._hash60(f"{i}:{e}:batch"))
            parts.append((len(order), *_replay_local(order, XS, YS, W, b, 16, 0.05)))
        W, b = sum(n * w for n, w, _ in parts) / N, sum(n * c for n, _, c in parts) / N
    np.testing.assert_allclose(res.model.W, W, atol=1e-10)
    np.testing.assert_allclose(res.model.b, b, atol=1e-10)
    assert [(e, n, r) for e, _, n, r in res.epochs] == [(0, N, len(set(of))), (1, N, len(set(of)))]


def test_local_sgd_does_not_depend_on_the_partitions(spark, feats):
    a = SF.fit_local(feats, epochs=2, lr=0.05, classes=K, rows_per_replica=25)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = SF.fit_local(feats.repartition(7), epochs=2, lr=0.05, classes=K, rows_per_replica=25)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    np.testing.assert_allclose(a.model.W, b.model.W, atol=1e-12)
    assert SF.replica_count(0) == 1 and SF.replica_count(4097) == 2


def _replay_sync(ids, X, y, epochs, batch, workers, lr, classes):
    n = len(ids)
    place = {i: p for p, i in enumerate(sorted(range(n), key=lambda i: (SF._hash60(f"{ids[i]}:0:sync"), ids[i])))}
    W, b, steps = np.zeros((X.shape[1], classes)), np.zeros(classes), []
    for e in range(epochs):
        orders = []
        for w in range(workers):
            stride, shift = SF.epoch_order(e, w, n)
            orders.append(sorted(range(n), key=lambda i: (stride * place[i] + shift) % n))
            assert sorted(orders[-1]) == list(range(n))
        for k in range(n // batch):
            parts = [np_grad(W, b, X[own], y[own]) for own in (o[k * batch:(k + 1) * batch] for o in orders)]
            own = np.concatenate([o[k * batch:(k + 1) * batch] for o in orders])
            hits = int(((X[own].astype(np.float64) @ W + b).argmax(1) == y[own]).sum())
            steps.append((e * (n // batch) + k, e, batch * workers, hits, np.mean([p[2] / batch for p in parts])))
            W, b = W - lr * np.mean([p[0] / batch for p in parts], axis=0), b - lr * np.mean([p[1] / batch for p in parts], axis=0)
    return W, b, steps


@pytest.mark.parametrize("segment, arrow_rows", [(512, 10000), (2, 10000), (4, 7)])
def test_sync_fit_makes_every_update(spark, feats, segment, arrow_rows):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(arrow_rows))
    try:
        fit = SF.fit_sync(feats, epochs=2, batch_size=23, workers=3, lr=0.1, classes=K, segment=segment)
    finally:
        spark.conf.set(key, old)
    W, b, steps = _replay_sync(list(range(N)), XS, YS, 2, 23, 3, 0.1, K)
    np.testing.assert_allclose(fit.model.W, W, atol=1e-10)
    np.testing.assert_allclose(fit.model.b, b, atol=1e-10)
    got = fit.metrics(spark).orderBy("step").collect()
    assert fit.updates == len(got) == 2 * (N // 23)
    assert [(r["step"], r["epoch"], r["examples"], r["hits"]) for r in got] == [s[:4] for s in steps]
    np.testing.assert_allclose([r["loss"] for r in got], [s[4] for s in steps], rtol=1e-9)
    assert all(r["seconds"] >= 0 for r in got)
    hist = fit.histograms(spark).collect()
    assert {r["step"] for r in hist} == {0} and sum(r["count"] for r in hist if r["name"] == LIN.WEIGHTS) == D * K


def test_sync_fit_of_one_worker_and_of_too_few_rows(spark, feats):
    one = SF.fit_sync(feats, epochs=1, batch_size=32, workers=1, lr=0.1, classes=K)
    W, b, _ = _replay_sync(list(range(N)), XS, YS, 1, 32, 1, 0.1, K)
    np.testing.assert_allclose(one.model.W, W, atol=1e-10)
    few = SF.fit_sync(feats, epochs=2, batch_size=500, classes=K)
    assert few.updates == 0 and not few.model.W.any() and few.metrics(spark).count() == 0


def test_wide_places_do_not_overflow(spark):
    n, p = (1 << 31) + 11, (1 << 31) + 3
    from pyspark.sql import functions as F
    stride, shift = SF.epoch_order(1, 2, n)
    got = spark.range(1).select(F.lit(p).cast("long").alias("_place")).select(SF._place(stride, shift, n).alias("at")).first()["at"]
    assert got == (stride * p + shift) % n


def test_array_functions(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0], 2)], "s array<double>, y int")
    r = df.select(A.argmax("s").alias("a"), A.top1_hit("s", "y").alias("h"),
                  A.softmax("s").alias("p"), A.cross_entropy("s", "y").alias("ce"),
                  A.standardize("s").alias("z")).first()
    assert r["a"] == 1 and r["h"] is True
    p = np.exp([1, 3, 3, 0]) / np.exp([1, 3, 3, 0]).sum()
    np.testing.assert_allclose(r["p"], p)
    assert abs(r["ce"] + np.log(p[2])) < 1e-12
    x = np.array([1.0, 3.0, 3.0, 0.0])
    np.testing.assert_allclose(r["z"], (x - x.mean()) / max(x.std(), 1 / np.sqrt(4)))


@pytest.mark.parametrize("batch_size, chunk", [(20, 1024), (4, 1), (4, 3)])
def test_sparse_momentum_replays_every_batch(spark, batch_size, chunk):
    n = 75
    rows = spark.createDataFrame([(i, XS[i].tolist(), int(YS[i])) for i in range(n)], "id long, features array<double>, label int")
    got = MOM.fit_centroids_sparse(rows, lr=0.1, momentum=0.9, batch_size=batch_size, classes=K + 1, chunk=chunk, fan=2)
    order = sorted(range(n), key=lambda i: int(hashlib.md5(f"{i}:0:batch".encode()).hexdigest()[:15], 16))
    C, V = np.zeros((K, D)), np.zeros((K, D))
    for s in range(0, n, batch_size):
        idx = np.array(order[s:s + batch_size])
        for k in set(YS[idx].tolist()):
            own = idx[YS[idx] == k]
            V[k] = 0.9 * V[k] + (C[k] - XS[own]).sum(axis=0) / len(idx)
            C[k] = C[k] - 0.1 * V[k]
    out = {(r["label"], r["i"]): (r["value"], r["velocity"]) for r in got.collect()}
    for k in range(K):
        for i in range(D):
            np.testing.assert_allclose(out[(k, i)], (C[k, i], V[k, i]), atol=1e-10)
    assert np.abs(C).sum() > 0 and len(out) == (K + 1) * D and out[(K, 0)] == (0.0, 0.0)   # a class without rows


def test_empty_checkpoint_is_reported(spark):
    empty = spark.createDataFrame([], "param string, i int, j int, value double")
    with pytest.raises(ValueError, match="no checkpoint"):
        LIN.Model.from_frame(empty)


def test_evaluation_without_a_checkpoint_is_empty(spark, feats, caplog):
    from lodestar.plans import ml_queries
    none = spark.createDataFrame([], "step int, param string, i int, j int, value double")
    got = ml_queries.evaluate(feats, none)
    assert got.count() == 0 and "no checkpoint" in caplog.text
    model = LIN.Model(RNG.standard_normal((D, K)), np.zeros(K)).to_frame(spark)
    from pyspark.sql import functions as F
    some = ml_queries.evaluate(feats, model.withColumn("step", F.lit(3)))
    assert some.columns == got.columns and some.count() == N // ml_queries.EVAL_BATCH


def test_staircase_decay(spark):
    df = spark.range(0, 10).select(A.staircase_decay(0.001, 250.0, 4, 9.0, "id").alias("lr"), "id")
    got = {r["id"]: r["lr"] for r in df.collect()}
    rate = (1 / 250.0) ** (1 / 3)
    for s, v in got.items():
        assert abs(v - 0.001 * rate ** np.floor(s / 3.0)) < 1e-15


def test_param_match_priorities(spark):
    names = spark.createDataFrame([("conv1/weights",), ("fc/biases",), ("other",), ("conv1/biases",)],
                                  "param string")
    groups = MOM.param_groups([("weights", 0.001, 0.9), ("biases", 0.002, 0.8),
                                      ("conv1/biases", 0.5, 0.1)])
    got = {r["param"]: (r["group"], r["learning_rate"], r["momentum"])
           for r in MOM.match_params(names, groups).collect()}
    assert got["conv1/weights"] == ("weights", 0.001, 0.9)
    assert got["fc/biases"] == ("biases", 0.002, 0.8)
    assert got["conv1/biases"] == ("conv1/biases", 0.5, 0.1)     # exact name first
    assert got["other"] == ("default", 0.02, 0.9)
    assert "Join" not in MOM.match_params(names, groups)._jdf.queryExecution().optimizedPlan().toString()
    assert MOM.match_params(names, []).select("group").distinct().collect() == [("default",)]


def test_momentum_dense_sparse_nesterov(spark):
    params = spark.createDataFrame([("w", 0, 0, 1.0, 0.5), ("w", 0, 1, 2.0, 0.0)],
                                   "param string, i int, j int, value double, velocity double")
    grads = spark.createDataFrame([("w", 0, 0, 0.1)], "param string, i int, j int, g double")
    hyper = spark.createDataFrame([("w", 0.1, 0.9)], "param string, learning_rate double, momentum double")
    out = {(r["i"], r["j"]): (r["value"], r["velocity"]) for r in MOM.apply_momentum(params, grads, hyper).collect()}
    v = 0.9 * 0.5 + 0.1
    assert out[(0, 0)] == pytest.approx((1.0 - 0.1 * v, v))
    assert out[(0, 1)] == (2.0, 0.0)                               # untouched
    nes = {(r["i"], r["j"]): r["value"] for r in
           MOM.apply_momentum(params, grads, hyper, nesterov=True).collect()}
    assert nes[(0, 0)] == pytest.approx(1.0 - 0.1 * (0.1 + 0.9 * v))


def test_block_loss_and_checkpoint_steps(spark):
    steps = spark.createDataFrame([(s, float(s)) for s in range(1, 46)], "step long, loss double")
    b = {r["block"]: r["block_loss"] for r in MET.block_mean_loss(steps, 45).collect()}
    assert len(b) == 22 and b[0] == pytest.approx((1 + 2) / 2)
    assert MET.checkpoint_steps(251) == [0, 100, 200, 250]
    saved = spark.createDataFrame([(0, 1.0), (2, 3.0)], "step int, value double")
    assert [r["value"] for r in MET.latest(saved).collect()] == [3.0]


def test_metrics_of_all_epochs_match_numpy(spark):
    from lodestar.plans import ml_queries

    sf = "/root/testdata/sf0.1"   # the smallest with many batches an epoch
    rows = ml_queries.train_rows(spark, sf).select("id", "features", "label").collect()
    X, y = np.array([r["features"] for r in rows], dtype=np.float64), np.array([r["label"] for r in rows])
    _, _, want = _replay_sync([r["id"] for r in rows], X, y, 20, LIN.SYNC_BATCH_SIZE, LIN.SYNC_WORKERS, LIN.LEARNING_RATE, 10)
    got = ml_queries.ml_metrics(spark, sf).orderBy("step").collect()
    assert len(got) == 20 * (len(rows) // 128)
    assert [(r["step"], r["epoch"], r["examples"], r["hits"]) for r in got] == [w[:4] for w in want]
    np.testing.assert_allclose([r["loss"] for r in got], [w[4] for w in want], atol=2e-6)
