"""DuckDB oracle SQL for the model-fitting queries.

Each gradient step is a chain of materialised CTEs over the exploded feature
table ``X(id, label, split, i, x)``: scores, max-shifted softmax, residual
``p - onehot``, gradient sums, update.  Only fixed step counts are expressible.
"""

from __future__ import annotations

HASH = "CAST('0x' || substr(md5({c} || ':' || {epoch} || ':{seed}'), 1, 15) AS BIGINT)"
TEST_CUT = (1 << 60) // 5       # ids hashing below are test rows

FEAT_CTE = f"""FEAT AS MATERIALIZED (SELECT vec_id AS id, embedding AS features, label,
  CASE WHEN {HASH.format(c='vec_id', epoch=0, seed='split')} < {TEST_CUT} THEN 'test' ELSE 'train' END AS split FROM embeddings),
X AS MATERIALIZED (SELECT id, label, split, CAST(generate_subscripts(features, 1) - 1 AS INTEGER) AS i,
  CAST(unnest(features) AS DOUBLE) AS x FROM FEAT),
TR AS MATERIALIZED (SELECT id, label FROM FEAT WHERE split = 'train')"""

ZERO_MODEL = """W0 AS MATERIALIZED (SELECT CAST(r // 10 AS INTEGER) AS i, CAST(r % 10 AS INTEGER) AS j,
  CAST(0.0 AS DOUBLE) AS w, CAST(0.0 AS DOUBLE) AS v FROM range((SELECT max(i) + 1 FROM X) * 10) t(r)),
B0 AS MATERIALIZED (SELECT CAST(r AS INTEGER) AS j, CAST(0.0 AS DOUBLE) AS b, CAST(0.0 AS DOUBLE) AS v
  FROM range(10) t(r))"""


def step_ctes(t: int, rows_filter: str = "TRUE", lr_w: float = 0.01, lr_b: float = 0.01,
              momentum: float | None = None, replicas: int = 1) -> list[str]:
    """CTEs that turn ``W{t}, B{t}`` into ``W{t+1}, B{t+1}``.

    A row weighs one over the rows of its replica and the number of replicas."""
    rep = f"({HASH.format(c='id', epoch=0, seed='replica')} % {replicas})"
    if momentum is None:
        w_new = f"W.w - {lr_w} * G.g AS w, W.v AS v"
        b_new = f"B.b - {lr_b} * G.g AS b, B.v AS v"
    else:
        w_new = (f"W.w - {lr_w} * ({momentum} * W.v + G.g) AS w, "
                 f"{momentum} * W.v + G.g AS v")
        b_new = (f"B.b - {lr_b} * ({momentum} * B.v + G.g) AS b, "
                 f"{momentum} * B.v + G.g AS v")
    return [
        f"R{t} AS MATERIALIZED (SELECT id, label, 1.0 / (count(*) OVER (PARTITION BY rep)) / "
        f"(SELECT count(DISTINCT {rep}) FROM TR WHERE {rows_filter}) AS wt FROM (SELECT *, {rep} AS rep FROM TR WHERE {rows_filter}))",
        f"S{t} AS (SELECT X.id, W.j, sum(X.x * W.w) AS s FROM X JOIN R{t} R ON X.id = R.id "
        f"JOIN W{t} W ON X.i = W.i GROUP BY X.id, W.j)",
        f"Z{t} AS (SELECT S.id, S.j, S.s + B.b - max(S.s + B.b) OVER (PARTITION BY S.id) AS z "
        f"FROM S{t} S JOIN B{t} B ON S.j = B.j)",
        f"D{t} AS MATERIALIZED (SELECT Z.id, Z.j, R.wt * (exp(Z.z) / sum(exp(Z.z)) OVER (PARTITION BY Z.id) "
        f"- CASE WHEN R.label = Z.j THEN 1.0 ELSE 0.0 END) AS d FROM Z{t} Z JOIN R{t} R ON Z.id = R.id)",
        f"W{t + 1} AS MATERIALIZED (SELECT W.i, W.j, {w_new} FROM W{t} W JOIN "
        f"(SELECT X.i, D.j, sum(X.x * D.d) AS g FROM X JOIN D{t} D ON X.id = D.id GROUP BY X.i, D.j) G "
        f"ON W.i = G.i AND W.j = G.j)",
        f"B{t + 1} AS MATERIALIZED (SELECT B.j, {b_new} FROM B{t} B JOIN "
        f"(SELECT j, sum(d) AS g FROM D{t} GROUP BY j) G ON B.j = G.j)",
    ]


def full_batch_fit(steps: int, lr: float = 0.01) -> str:
    """``WITH`` body ending in ``W{steps}``, ``B{steps}``: full-batch GD on train rows."""
    parts = [FEAT_CTE, ZERO_MODEL]
    for t in range(steps):
        parts += step_ctes(t, "TRUE", lr, lr)
    return "WITH " + ",\n".join(parts)


def momentum_fit(steps: int, lr_w: float, lr_b: float, momentum: float, replicas: int = 1) -> str:
    parts = [FEAT_CTE, ZERO_MODEL]
    for t in range(steps):
        parts += step_ctes(t, "TRUE", lr_w, lr_b, momentum, replicas)
    return "WITH " + ",\n".join(parts)


def model_rows(t: int, with_velocity: bool = False) -> str:
    v_w = ", round(v, 6) AS velocity" if with_velocity else ""
    return (f"SELECT 'softmax/weights' AS param, i, j, round(w, 6) AS value{v_w} FROM W{t} "
            f"UNION ALL SELECT 'softmax/biases' AS param, 0 AS i, j, round(b, 6) AS value{v_w} FROM B{t}")


def scores_cte(t: int, rows: str = "FEAT") -> str:
    """Scores ``(id, j, s)`` of every row in ``rows`` under ``W{t}, B{t}``."""
    return (f"SC AS MATERIALIZED (SELECT X.id, W.j, sum(X.x * W.w) + max(B.b) AS s FROM X "
            f"JOIN (SELECT id FROM {rows}) F ON X.id = F.id JOIN W{t} W ON X.i = W.i "
            f"JOIN B{t} B ON W.j = B.j GROUP BY X.id, W.j)")


# The recursive fits hold the model as rows (i, j, w); the biases are the weights of a feature -1 that is always 1.
MODEL_X = "XB AS MATERIALIZED (SELECT id, i, x FROM X WHERE split = 'train' UNION ALL SELECT id, -1, 1.0 FROM TR)"
MODEL_0 = "SELECT CAST(r // 10 - 1 AS INTEGER) AS i, CAST(r % 10 AS INTEGER) AS j, CAST(0.0 AS DOUBLE) AS w FROM range((SELECT max(i) + 2 FROM X) * 10) z(r)"


def sync_fit(epochs: int, batch: int, workers: int, lr: float) -> str:
    """``WITH`` body ending in ``SYNC(t, i, j, w)``: the model before update ``t`` of the synchronous schedule; ``BT(t, id, c)``: the rows of an update."""
    stride = f"{HASH.format(c='e', epoch='wk', seed='stride')} % n + 1"
    return f"""WITH RECURSIVE {FEAT_CTE},
{MODEL_X},
N AS MATERIALIZED (SELECT count(*) AS n, count(*) // {batch} AS u FROM TR),
PLACE AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY {HASH.format(c='id', epoch=0, seed='sync')}, id) - 1 AS p FROM TR),
ORD AS MATERIALIZED (SELECT e, wk, n, u, list_filter(range({stride}, {stride} + 1000), lambda v: gcd(v, n) = 1)[1] AS stride,
  {HASH.format(c='e', epoch='wk', seed='shift')} % n AS shift FROM range({epochs}) a(e), range({workers}) b(wk), N),
BT AS MATERIALIZED (SELECT e * u + k AS t, id, count(*) AS c FROM (SELECT e, u, id, ((stride * p + shift) % n) // {batch} AS k FROM PLACE, ORD)
  WHERE k < u GROUP BY ALL),
SYNC AS (SELECT CAST(0 AS BIGINT) AS t, i, j, w FROM ({MODEL_0})
  UNION ALL
  SELECT M.t + 1, M.i, M.j, M.w - {lr} * G.g FROM SYNC M JOIN (
    SELECT XB.i, D.j, sum(XB.x * D.d) AS g FROM XB JOIN (
      SELECT P.id, P.j, P.c * (P.p - CASE WHEN TR.label = P.j THEN 1.0 ELSE 0.0 END) / {batch * workers} AS d FROM (
        SELECT id, j, c, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY id) AS p FROM (
          SELECT *, max(s) OVER (PARTITION BY id) AS m FROM (
            SELECT BT.id, M.j, BT.c, sum(XB.x * M.w) AS s FROM SYNC M JOIN BT ON BT.t = M.t JOIN XB ON XB.id = BT.id AND XB.i = M.i
            GROUP BY BT.id, M.j, BT.c))) P JOIN TR ON TR.id = P.id) D ON D.id = XB.id GROUP BY XB.i, D.j) G ON G.i = M.i AND G.j = M.j
  WHERE M.t < {epochs} * (SELECT u FROM N))"""


def local_fit(epochs: int, batch: int, rows_per_replica: int, lr: float) -> str:
    """``WITH`` body ending in ``LOCAL(t, r, i, j, w)``: the model of replica ``r`` after ``t`` mini-batches; all replicas hold their mean at the end of an epoch."""
    return f"""WITH RECURSIVE {FEAT_CTE},
{MODEL_X},
REP AS MATERIALIZED (SELECT id, {HASH.format(c='id', epoch=0, seed='replica')} % (SELECT greatest(1, (count(*) + {rows_per_replica - 1}) // {rows_per_replica}) FROM TR) AS r FROM TR),
SIZE AS MATERIALIZED (SELECT r, count(*) AS n FROM REP GROUP BY r),
TOP AS MATERIALIZED (SELECT (max(n) + {batch - 1}) // {batch} AS b FROM SIZE),
BT0 AS MATERIALIZED (SELECT e, r, id, (row_number() OVER (PARTITION BY e, r ORDER BY {HASH.format(c='id', epoch='e', seed='batch')}, id) - 1) // {batch} AS k
  FROM REP, range({epochs}) a(e)),
BT AS MATERIALIZED (SELECT e * (SELECT b FROM TOP) + k AS t, r, id, count(*) OVER (PARTITION BY e, r, k) AS nb FROM BT0),
LOCAL AS (SELECT CAST(0 AS BIGINT) AS t, r, i, j, w FROM ({MODEL_0}), SIZE
  UNION ALL
  SELECT t + 1, r, i, j, CASE WHEN (t + 1) % (SELECT b FROM TOP) = 0 THEN sum(w * n) OVER (PARTITION BY i, j) / sum(n) OVER (PARTITION BY i, j) ELSE w END FROM (
    SELECT M.t, M.r, M.i, M.j, M.w - {lr} * coalesce(G.g, 0.0) AS w, SIZE.n FROM LOCAL M JOIN SIZE ON SIZE.r = M.r LEFT JOIN (
      SELECT D.r, XB.i, D.j, sum(XB.x * D.d) AS g FROM XB JOIN (
        SELECT P.r, P.id, P.j, (P.p - CASE WHEN TR.label = P.j THEN 1.0 ELSE 0.0 END) / P.nb AS d FROM (
          SELECT r, id, j, nb, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY id) AS p FROM (
            SELECT *, max(s) OVER (PARTITION BY id) AS m FROM (
              SELECT BT.r, BT.id, M.j, BT.nb, sum(XB.x * M.w) AS s FROM LOCAL M JOIN BT ON BT.t = M.t AND BT.r = M.r JOIN XB ON XB.id = BT.id AND XB.i = M.i
              GROUP BY BT.r, BT.id, M.j, BT.nb))) P JOIN TR ON TR.id = P.id) D ON D.id = XB.id GROUP BY D.r, XB.i, D.j) G
    ON G.r = M.r AND G.i = M.i AND G.j = M.j)
  WHERE t < {epochs} * (SELECT b FROM TOP))"""


def last_model(cte: str) -> str:
    """The fitted model from a recursive fit (replicas agree in the end)."""
    return f"""SELECT CASE WHEN i < 0 THEN 'softmax/biases' ELSE 'softmax/weights' END AS param, greatest(i, 0) AS i, j, round(avg(w), 6) AS value
FROM {cte} WHERE t = (SELECT max(t) FROM {cte}) GROUP BY {cte}.i, j"""


def _sync_scores(rows: str, keys: str) -> str:
    """Scores ``(keys, id, j, s)`` of ``rows(t, id, c)`` by the model before their update."""
    return (f"SELECT {keys}, B.id, M.j, sum(XB.x * M.w) AS s FROM {rows} B JOIN SYNC M ON M.t = B.t JOIN XB ON XB.id = B.id AND XB.i = M.i "
            f"GROUP BY {keys}, B.id, M.j")


def sync_metrics(batch: int, workers: int) -> str:
    """``(step, epoch, loss, examples, hits)`` of every update."""
    return f"""SELECT t AS step, CAST(t // (SELECT u FROM N) AS INTEGER) AS epoch, round(sum(c * (m + ln(z) - sl)) / {batch * workers}, 6) AS loss,
  CAST({batch * workers} AS BIGINT) AS examples, CAST(sum(CASE WHEN best = label THEN c ELSE 0 END) AS BIGINT) AS hits FROM (
  SELECT t, c, id, any_value(label) AS label, any_value(m) AS m, sum(exp(s - m)) AS z, max(CASE WHEN j = label THEN s END) AS sl, min(CASE WHEN s = m THEN j END) AS best
  FROM (SELECT S.*, TR.label, max(s) OVER (PARTITION BY t, S.id) AS m FROM ({_sync_scores('BT', 'B.t, B.c')}) S JOIN TR ON TR.id = S.id) GROUP BY t, c, id)
GROUP BY t"""


def sync_histograms(edges: list[float], every: int) -> str:
    """``(name, bucket, count, steps)`` of the variables after every ``every``-th update."""
    return f"""SELECT name, bucket, CAST(sum(count) AS BIGINT) AS count, count(DISTINCT step) AS steps FROM (
  SELECT t - 1 AS step, CASE WHEN i < 0 THEN 'softmax/biases' ELSE 'softmax/weights' END AS name,
    CAST(len(list_filter({edges!r}, lambda v: v <= w)) AS INTEGER) AS bucket, count(*) AS count
  FROM SYNC WHERE t > 0 AND (t - 1) % {every} = 0 GROUP BY ALL) GROUP BY name, bucket"""


def sync_accuracy() -> str:
    return """SELECT split, count(*) AS examples, CAST(sum(CASE WHEN best = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
  round(avg(CASE WHEN best = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM (
  SELECT id, min(j) AS best FROM (SELECT *, max(s) OVER (PARTITION BY id) AS m FROM (
    SELECT X.id, M.j, sum(X.x * M.w) + max(B.w) AS s FROM X JOIN SYNC M ON M.i = X.i JOIN SYNC B ON B.t = M.t AND B.j = M.j AND B.i = -1
    WHERE M.t = (SELECT max(t) FROM SYNC) GROUP BY X.id, M.j)) WHERE s = m GROUP BY id) JOIN FEAT USING (id) GROUP BY split"""
