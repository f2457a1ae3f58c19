"""Operator 12, periodic runs of words by recompression.

The words of a slice of documents become one string of integers with a sentinel between documents.  Two steps alternate until every
document is one symbol: block compression replaces each maximal block of one symbol by a symbol of its own for that symbol and length, and
pair compression splits the symbols in two halves and replaces each pair (left half, right half) by one symbol.  Equal pieces of text
get equal symbols up to a few at their borders, so the levels form a run-length grammar on which the longest common extension of two
places climbs while the symbols above agree and descends where they part: a bounded number of symbols a level.

A run of period ``q`` and at least ``4 * q`` words holds a multiple ``g`` of ``3 * q`` with ``g + q`` still inside, so places ``g`` and ``g + q`` with equal words
are the only candidates of period ``q``: a harmonic sum of them over all periods.  The exact extensions of a candidate to the left and to the right
give the run.  Of equal stretches the one with the smallest period counts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .arrow_text import distinct, segment_sums, slices, texts_of, words
from .registry import query

LEAST_WORDS = 6
LEAST_PERIODS = 4
GRID = LEAST_PERIODS - 1
AT_ONCE = 200_000   # candidates that are extended together


@dataclass(frozen=True)
class Level:
    """Symbols of a level; ``first`` is the place of each one's first child below (with one more at the end), ``parent`` the place above of each child."""

    symbols: np.ndarray
    first: np.ndarray | None
    parent: np.ndarray | None
    blocks: bool


def _half(symbols: np.ndarray, seed: int) -> np.ndarray:
    """Whether each symbol is in the left half, by a hash of it."""
    x = (symbols.astype(np.uint64) + np.uint64(seed * 0x9E3779B9 + 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return ((x * np.uint64(0x94D049BB133111EB)) >> np.uint64(63)).astype(bool)


def _raise(symbols: np.ndarray, starts: np.ndarray, new: np.ndarray, blocks: bool) -> Level:
    first = np.flatnonzero(starts)
    return Level(new[first], np.append(first, len(symbols)), np.cumsum(starts) - 1, blocks)


def grammar(letters: np.ndarray) -> list[Level]:
    """Levels of the run-length grammar of ``letters`` (positive; 0 parts documents and stands at both ends)."""
    levels = [Level(letters, None, None, False)]
    fresh = int(letters.max(initial=0)) + 1
    now = letters
    while True:
        # Neighbours that both belong to a document: without them, every document is one symbol.
        if not ((now[:-1] != 0) & (now[1:] != 0)).any():
            return levels
        starts = np.ones(len(now), bool)
        starts[1:] = (now[1:] != now[:-1]) | (now[1:] == 0)
        if not starts.all():
            at = np.flatnonzero(starts)
            n = np.diff(np.append(at, len(now)))
            long = n > 1
            key = now[at[long]] * (len(now) + 1) + n[long]
            kinds, code = np.unique(key, return_inverse=True)
            new = now.copy()
            new[at[long]] = fresh + code
            fresh += len(kinds)
            levels.append(_raise(now, starts, new, True))
            now = levels[-1].symbols
        alive = (now[:-1] != 0) & (now[1:] != 0)
        if not alive.any():
            continue
        best = None
        for seed in (len(levels), len(levels) + 7919):
            left = _half(now, seed)
            for pairs in (left[:-1] & ~left[1:] & alive, ~left[:-1] & left[1:] & alive):
                if best is None or pairs.sum() > best.sum():
                    best = pairs
        at = np.flatnonzero(best)
        if not len(at):   # a rare split without any pair: other halves on the next level
            levels.append(Level(now, np.arange(len(now) + 1), np.arange(len(now)), False))
            continue
        kinds, code = np.unique(now[at] * fresh + now[at + 1], return_inverse=True)
        starts = np.ones(len(now), bool)
        starts[at + 1] = False
        new = now.copy()
        new[at] = fresh + code
        fresh += len(kinds)
        levels.append(_raise(now, starts, new, False))
        now = levels[-1].symbols


def extensions(levels: list[Level], x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
    """Number of equal letters from the places ``x`` and ``y`` on (``forward``), or up to and with them."""
    step = 1 if forward else -1
    x, y = x.astype(np.int64), y.astype(np.int64)
    begin = x.copy()
    at = np.zeros(len(x), np.int64)   # the level on which a query is
    live = np.arange(len(x))

    def edge(up: Level, p: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Symbols of its parent from ``p`` on, in the direction."""
        return up.first[parent + 1] - p if forward else p - up.first[parent] + 1

    for k in range(len(levels) - 1):
        if not len(live):
            break
        here, up = levels[k], levels[k + 1]
        a, b = x[live], y[live]
        pa_, pb = up.parent[a], up.parent[b]
        ra, rb = edge(up, a, pa_), edge(up, b, pb)
        la, lb = up.first[pa_ + 1] - up.first[pa_], up.first[pb + 1] - up.first[pb]
        inner = (ra != la) | (rb != lb)   # not both at the border of a symbol above
        same = (here.symbols[a] == here.symbols[b]) & (here.symbols[a] != 0)
        # Inside a block both go to the nearer end of it; inside a pair both take one step.
        go = np.where(inner & same, np.minimum(ra, rb) if up.blocks else 1, 0)
        a, b = a + step * go, b + step * go
        x[live], y[live] = a, b
        ready = ~inner | (same & ((ra == rb) | (not up.blocks)))
        pa_, pb = up.parent[a], up.parent[b]
        rise = ready & (up.symbols[pa_] == up.symbols[pb]) & (up.symbols[pa_] != 0)
        live, pa_, pb = live[rise], pa_[rise], pb[rise]
        x[live], y[live], at[live] = pa_, pb, k + 1
    order = np.argsort(-at, kind="stable")
    tops = -at[order]
    for k in range(int(at.max(initial=0)), -1, -1):
        # Queries on this level: those that stopped here and those that came down.
        some = order[:int(np.searchsorted(tops, -k, side="right"))]
        here = levels[k]
        a, b = x[some], y[some]
        same = (here.symbols[a] == here.symbols[b]) & (here.symbols[a] != 0)
        go = same.astype(np.int64)
        if k + 1 < len(levels) and levels[k + 1].blocks:
            up = levels[k + 1]
            go *= np.minimum(edge(up, a, up.parent[a]), edge(up, b, up.parent[b]))
        a, b = a + step * go, b + step * go
        if k:
            a, b = (here.first[a], here.first[b]) if forward else (here.first[a + 1] - 1, here.first[b + 1] - 1)
        x[some], y[some] = a, b
    return (x - begin) * step


def runs_of(letters: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows ``(document, start, length, period)`` of all runs, in this order; ``letters`` (positive) of documents of ``n`` letters one after another."""
    string = np.zeros(len(letters) + len(n) + 1, np.int64)
    base = np.cumsum(n) - n + np.arange(len(n)) + 1   # place of each document's first letter
    doc = np.repeat(np.arange(len(n)), n)
    string[np.arange(len(letters)) + doc + 1] = letters
    of = np.full(len(string), -1, np.int32)
    of[np.arange(len(letters)) + doc + 1] = doc
    longest = int(n.max(initial=0))
    if longest < LEAST_WORDS:
        return np.zeros((0, 4), np.int64)
    levels = grammar(string)
    found: list[np.ndarray] = []

    def extend(place: list[np.ndarray], period: list[int]) -> None:
        g = np.concatenate(place)
        q = np.repeat(np.array(period, np.int64), [len(p) for p in place])
        for lo in range(0, len(g), AT_ONCE):
            a, p = g[lo:lo + AT_ONCE], q[lo:lo + AT_ONCE]
            right = extensions(levels, a, a + p, True)
            left = extensions(levels, a - 1, a + p - 1, False)
            length = left + right + p
            keep = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
            own = np.stack([a - left, length, p], axis=1)[keep]
            found.append(np.unique(own, axis=0) if len(own) else own)

    place: list[np.ndarray] = []
    period: list[int] = []
    held = 0
    for q in range(1, longest // LEAST_PERIODS + 1):
        a = string[:-q:GRID * q]
        g = np.flatnonzero(a == string[q::GRID * q][:len(a)]) * (GRID * q)
        g = g[(of[g] >= 0) & (of[g] == of[g + q])]
        if len(g):
            place.append(g)
            period.append(q)
            held += len(g)
        if held >= AT_ONCE:
            extend(place, period)
            place, period, held = [], [], 0
    if place:
        extend(place, period)
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    if not len(rows):
        return np.zeros((0, 4), np.int64)
    # Equal stretches: the smallest period; then by start and period.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[fresh]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    own = of[rows[:, 0]].astype(np.int64)
    return np.column_stack([own, rows[:, 0] - base[own], rows[:, 1], rows[:, 2]])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; ties: the least start, then the least period."""
    best = None
    for start, length, period in runs:
        if best is None or (d := length * best[2] - best[1] * period) > 0 or (d == 0 and (start, period) < (best[0], best[2])):
            best = (start, length, period)
    return best


def seeded_repeats(doc: int | None, n: int) -> np.ndarray | None:
    """The edit of the query's contract: for a tenth of the documents, which word stands at each place from some place on."""
    if doc is None or n == 0 or (h := zlib.crc32(str(doc).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite: Callable[[int | None, int], np.ndarray | None] | None = None,
                  with_runs: bool = False) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256[, runs, collapsed])`` of every row's whole text.

    Runs are maximal stretches of at least six words and four times their smallest period; ``collapsed`` is the text with each run cut to its
    first period, words joined by one space.  ``rewrite(doc_id, words)`` may give the word to read at each place.  Null texts are empty:
    no runs, the digests of empty strings.  Repeated rows and rows without an id are rows of their own; other columns are not read; an
    empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(texts_of(batch.column(1))):
                ids = batch.column(0).slice(at, len(texts))
                n, flat = words(texts, lower=False)
                ends = np.cumsum(n)
                if rewrite is not None:
                    order = np.arange(len(flat))
                    for doc, k, to in zip(ids.to_pylist(), n.tolist(), ends.tolist()):
                        if (own := rewrite(doc, k)) is not None:
                            order[to - k:to] = own + (to - k)
                    flat = flat.take(pa.array(order))
                _, letters = distinct(flat)
                found = runs_of(letters.astype(np.int64) + 1, n)
                drop = np.zeros(len(flat) + 1, np.int64)
                first = (ends - n)[found[:, 0]] + found[:, 1]
                np.add.at(drop, first + found[:, 3], 1)
                np.add.at(drop, first + found[:, 2], -1)
                kept = np.cumsum(drop)[:-1] == 0
                offsets = np.concatenate([[0], np.cumsum(segment_sums(kept.astype(np.int64), n))])
                collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat.filter(pa.array(kept))), pa.scalar(" ", pa.large_string())).to_pylist()
                cuts = np.searchsorted(found[:, 0], np.arange(len(texts) + 1)).tolist()
                rows = list(map(tuple, found[:, 1:].tolist()))
                own = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
                best = [strongest(r) for r in own]
                digest = [hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in r).encode()).hexdigest() for r in own]
                column = lambda f: pa.array([None if b is None else f(b) for b in best], pa.int64())
                out = [ids, pa.array([len(r) for r in own], pa.int64()), column(lambda b: b[0]), column(lambda b: b[1]), column(lambda b: b[2]),
                       column(lambda b: 1000 * b[1] // b[2]), pa.array(digest, pa.string()),
                       pa.array([hashlib.sha256(c.encode()).hexdigest() for c in collapsed], pa.string())]
                names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
                if with_runs:
                    kind = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])
                    out += [pa.array([[dict(zip(("start", "length", "period"), x)) for x in r] for r in own], pa.list_(kind)), pa.array(collapsed, pa.string())]
                    names += ["runs", "collapsed"]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
              + (", runs array<struct<start: long, length: long, period: long>>, collapsed string" if with_runs else ""))
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of them with repeats put in."""
    return periodic_runs(table(spark, sf_dir, "documents"), rewrite=seeded_repeats)
