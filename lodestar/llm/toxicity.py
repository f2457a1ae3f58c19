"""Operator 2, toxicity by a counterfactual-regularised classifier.

A document's features are which of a bounded set of words and word beginnings it holds.  The set is chosen on labelled
rows: features whose share among toxic documents exceeds their share among the others by a z-score of ``MIN_Z`` at
least, the ``FEATURES`` strongest, plus every identity term seen there.  The score is the logistic function of the
summed weights.

Fitting minimises the log loss, a ridge term, and for every labelled sentence with an identity term the squared change of
the summed weights when the term is swapped for each of ``SWAPS`` others.  So the weights of identity terms (and of
beginnings that they share with toxic words) are drawn together, and naming a group does not move a score.

The fit uses at most ``FIT_ROWS`` labelled rows, taken in the order of a hash of their id; every document is scored on its
whole text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import table
from .arrow_text import distinct, give_back, slices, strings, texts_of, words
from .registry import query

FIT_ROWS = 20_000        # labelled rows that a fit may use
FEATURES = 512
MIN_DOCS = 5             # documents that hold a feature
MIN_Z = 4.0
BEGINNINGS = (4, 5, 6, 7, 8)   # characters of the word beginnings that are features
RIDGE = 0.02
COUNTERFACTUAL = 4.0     # weight of a squared change of score by a swap
SWAPS = 4
THRESHOLD = 0.7
HELD_FEATURES = 100_000   # features that a task counts before it reports them
SLICE = 2 << 20
ROWS_AT_ONCE = 2000      # labelled rows in a block of the fit

# Names of groups that neutral text mentions; a parameter of the fit.
IDENTITY_TERMS = tuple("""women men girls boys woman man muslim muslims christian christians jewish jews hindu hindus buddhist
atheist black white asian african european american arab latino hispanic immigrant immigrants refugee refugees gay lesbian bisexual
transgender straight disabled deaf blind elderly young frauen männer femmes hommes mujeres hombres juifs musulmans judíos musulmanes
juden muslime""".split())

_LETTERS = re.compile(r"[^\W\d_]+")


def features_of_words(kinds: Iterable[str]) -> Iterator[list[str]]:
    """Features of each distinct word: its runs of letters in lower case, and their beginnings."""
    for w in kinds:
        own: list[str] = []
        for run in _LETTERS.findall(w.lower()):
            own.append(run)
            own += [f"{run[:k]}*" for k in BEGINNINGS if len(run) > k]
        yield own


def in_fit(doc_id: str = "doc_id"):
    """Rows that may teach: crc32 of the id as text, modulo 3, is not 1 (a null id may not)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Weight of each feature, and the constant."""

    weights: dict[str, float]
    constant: float

    def score(self, held: set[str]) -> float:
        z = self.constant + sum(self.weights[f] for f in held if f in self.weights)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _sets(texts: pa.Array) -> Iterator[set[str]]:
    """Features of each text."""
    n, flat = words(texts, lower=False)
    kinds, index = distinct(flat)
    of_kind = list(features_of_words(strings(kinds)))
    at = 0
    for k in n.tolist():
        own: set[str] = set()
        for i in np.unique(index[at:at + k]).tolist():
            own.update(of_kind[i])
        at += k
        yield own


def _swapped(text: str, terms: frozenset[str], all_terms: tuple[str, ...]) -> list[tuple[set[str], set[str]]]:
    """``(features that a swap takes away, features that it brings)`` for each sentence with identity terms."""
    out = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n", text):
        runs = _LETTERS.findall(sentence.lower())
        named = [w for w in runs if w in terms]
        if not named:
            continue
        base = {f for fs in features_of_words(runs) for f in fs}
        for w in dict.fromkeys(named):
            start = zlib.crc32(f"{w} {sentence}".encode())
            for j in range(SWAPS):
                other = all_terms[(start + j * 7919) % len(all_terms)]
                if other != w:
                    new = {f for fs in features_of_words([other if x == w else x for x in runs]) for f in fs}
                    out.append((base - new, new - base))
    return out


def swap_sums(pairs: Iterable[tuple[list[int], list[int]]]) -> Counter[tuple[int, int]]:
    """Sum of the outer products of swaps ``(lost, gained)``, by place; their number at (-1, -1)."""
    out: Counter[tuple[int, int]] = Counter()
    for lost, gained in pairs:
        out[-1, -1] += 1
        signed = [*((i, -1) for i in lost), *((i, 1) for i in gained)]
        for i, a in signed:
            for j, b in signed:
                out[i, j] += a * b
    return out


def held_matrix(rows: Iterable[Iterable[int]], n: int, size: int) -> np.ndarray:
    """One byte for each row and feature, whether the row holds it; the last column, of the constant, is always held."""
    x = np.zeros((n, size + 1), bool)
    for i, held in enumerate(rows):
        x[i, list(held)] = True
    x[:, size] = True
    return x


def fit_weights(x: np.ndarray, y: np.ndarray, pairs: Iterable[tuple[list[int], list[int]]] | Mapping[tuple[int, int], int],
                ridge: float = RIDGE, counterfactual: float = COUNTERFACTUAL, rounds: int = 25) -> np.ndarray:
    """Weights (the constant last) by Newton steps over a ``held_matrix``; ``pairs`` are the (lost, gained) features of swaps, or their ``swap_sums``.

    Sums over rows go block by block, so the driver holds a byte for each row and feature and little else."""
    n, size = len(x), x.shape[1] - 1
    d = np.zeros((size + 1, size + 1))
    sums = dict(pairs if isinstance(pairs, Mapping) else swap_sums(pairs))
    swaps = sums.pop((-1, -1), 0)
    for (i, j), v in sums.items():
        d[i, j] = v
    fixed = 2 * counterfactual * d / max(1, swaps) * max(1.0, n / 100)
    fixed += np.diag([ridge * 2] * size + [1e-6])
    # Both classes weigh alike up to a factor of three, so that the rarer one is not scored away.
    share = y.mean() if n else 0.5
    heavy = np.where(y == 1, min(3.0, max(1.0, (1 - share) / max(share, 1e-9))), 1.0)
    blocks = [slice(at, at + ROWS_AT_ONCE) for at in range(0, n, ROWS_AT_ONCE)]
    w = np.zeros(size + 1)

    row, column = (at.astype(np.int32) for at in np.nonzero(x))   # few features are held by a row

    def sums_of(v: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=v[column], minlength=n)

    def loss(v: np.ndarray) -> float:
        z = sums_of(v)
        return float((heavy * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * v @ fixed @ v)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(sums_of(w), -40, 40)))
        slope, curve = fixed @ w + np.bincount(column, weights=(heavy * (p - y))[row], minlength=size + 1), fixed.copy()
        for at in blocks:
            part = x[at].astype(float)
            curve += (part * (heavy * np.maximum(p * (1 - p), 1e-6))[at][:, None]).T @ part
        step = np.linalg.solve(curve + 1e-9 * np.eye(size + 1), slope)
        scale = 1.0
        while scale > 1e-4 and (new := loss(w - scale * step)) > now:
            scale /= 2
        if scale <= 1e-4:
            break
        w = w - scale * step
        if now - new < 1e-6 * max(1.0, abs(now)):
            break
        now = new
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        fit_rows: int = FIT_ROWS, identity_terms: tuple[str, ...] = IDENTITY_TERMS) -> Model:
    """The model of at most ``fit_rows`` labelled rows outside the held-out third.

    A document with several labels is toxic if one says so; null labels and null ids teach nothing; of rows that repeat an id one teaches (the one with the
    least text; a null text is empty).  Without rows of both classes every score is the share of toxic rows (0 without any)."""
    chosen = (labels.where(in_fit(doc_id) & F.col(label).isNotNull())
              .groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(fit_rows))
    rows = chosen.collect()    # ids and labels, at most fit_rows
    share = sum(r["y"] for r in rows) / len(rows) if rows else 0.0
    flat = Model({}, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    if not rows or share in (0.0, 1.0):
        return flat
    spark = docs.sparkSession
    known = spark.createDataFrame([(r["id"], r["y"]) for r in rows], "id long, y int")
    # One row for each labelled id, whatever rows repeat it (the least text), so at most fit_rows of them, written once for the passes below.
    path = scratch_path(spark, "taught")
    (docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
     .join(F.broadcast(known), "id").groupBy("id", "y").agg(F.min("text").alias("text")).write.parquet(path))
    taught = spark.read.parquet(path).select("y", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        toxic: Counter[str] = Counter()

        def report() -> pa.RecordBatch:
            names = list(n)
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n[x] for x in names], pa.int64()),
                                              pa.array([toxic[x] for x in names], pa.int64())], ["feature", "n", "toxic"])
            n.clear()
            toxic.clear()
            return out

        for batch in batches:
            ys = batch.column(0).to_pylist()
            for at, texts in slices(texts_of(batch.column(1)), SLICE):
                for k, own in enumerate(_sets(texts)):
                    n.update(own)
                    if ys[at + k]:
                        toxic.update(own)
                    if len(n) >= HELD_FEATURES:
                        yield report()
        yield report()

    met = taught.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic")).first()
    total, bad = met["n"], met["toxic"]
    if not bad or bad == total:   # the documents hold labelled rows of one class at most
        return flat
    rate = bad / total
    held = (taught.mapInArrow(count, "feature string, n long, toxic long")
            .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
            .withColumn("z", (F.col("toxic") - F.lit(rate) * F.col("n"))
                        / F.sqrt(F.lit(rate * (1 - rate)) * F.col("n") * (F.lit(1.0) - F.col("n") / F.lit(total + 1.0)) + F.lit(0.5))))
    strong = (held.where((F.col("n") >= MIN_DOCS) & (F.col("z") >= MIN_Z) & ~F.isnan("z"))
              .orderBy(F.desc("z"), "feature").limit(FEATURES).collect())
    names = list(dict.fromkeys([*(r["feature"] for r in strong), *identity_terms]))
    place = {f: i for i, f in enumerate(names)}
    terms, all_terms = frozenset(identity_terms), tuple(identity_terms)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ys = batch.column(0).to_pylist()
            for at, texts in slices(texts_of(batch.column(1)), SLICE):
                sets = [sorted(place[f] for f in own if f in place) for own in _sets(texts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ys[at:at + len(texts)], pa.int32()), pa.array(sets, pa.list_(pa.int32()))], ["y", "held"])

    def swap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[tuple[int, int]] = Counter()
        for batch in batches:
            for _, texts in slices(texts_of(batch.column(1)), SLICE):
                for t in texts.to_pylist():
                    if _names(t, terms):
                        sums.update(swap_sums([[place[f] for f in side if f in place] for side in pair] for pair in _swapped(t, terms, all_terms)))
        at = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()),
                                          pa.array([sums[x] for x in at], pa.int64())], ["i", "j", "v"])

    data = taught.mapInArrow(encode, "y int, held array<int>").toArrow()  # one row for each id, so <= fit_rows
    held_by = data["held"].combine_chunks()
    x = np.zeros((len(data), len(names) + 1), bool)
    x[np.repeat(np.arange(len(data)), np.diff(held_by.offsets.to_numpy())), held_by.flatten().to_numpy()] = True
    x[:, -1] = True
    y = data["y"].to_numpy().astype(float)
    # At most the square of the features, whatever the texts hold.
    swaps = {(r["i"], r["j"]): r["v"] for r in taught.mapInArrow(swap, "i int, j int, v long").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()} if terms else {}
    weights = fit_weights(x, y, swaps)
    del x, y, data, held_by, rows
    give_back()   # the driver serves other work
    return Model({f: float(weights[i]) for f, i in place.items()}, float(weights[-1]))


def _names(text: str, terms: frozenset[str]) -> bool:
    return not terms.isdisjoint(_LETTERS.findall(text.lower()))


def scores_of(texts: pa.Array, model: Model) -> np.ndarray:
    """Score of each text."""
    n, flat = words(texts, lower=False)
    kinds, index = distinct(flat)
    # Only words with a weighted feature matter; a text's features are the union over its words.
    live = [[f for f in fs if f in model.weights] for fs in features_of_words(strings(kinds))]
    marked = np.fromiter(map(bool, live), bool, len(live))
    hit = marked[index]
    row = np.repeat(np.arange(len(texts)), n)[hit]
    found: dict[int, set[str]] = {}
    for r, i in zip(row.tolist(), index[hit].tolist()):
        found.setdefault(r, set()).update(live[i])
    nothing: set[str] = set()
    return np.array([model.score(found.get(r, nothing)) for r in range(len(texts))])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row's whole text.

    Null texts are empty and get the score of a text without features.  Null ids are not held out.  Repeated rows stay;
    other columns are not read; an empty table gives an empty table."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(texts_of(batch.column(2)), SLICE):
                scores = scores_of(texts, known.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), pa.array(scores),
                     pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (~in_fit(doc_id) & F.col(doc_id).isNotNull()).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    return read.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose whole text scores below the threshold."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(texts_of(batch.column(at_text)), SLICE):
                yield batch.slice(at, len(texts)).filter(pa.array(scores_of(texts, known.value) < threshold))

    return docs.mapInArrow(run, docs.schema)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a model of the labelled ones outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
