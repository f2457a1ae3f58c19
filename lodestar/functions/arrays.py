"""Array and numeric column functions (SCL-6..10, SCL-12, SCL-14, SCL-15).

All are built-in higher-order expressions (``transform`` / ``aggregate``), so
they run inside whole-stage code generation with no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_array(c: Column | str) -> Column:
    """SCL-10: element-wise cast."""
    return _c(c).cast("array<double>")


def argmax(scores: Column | str) -> Column:
    """SCL-7: 0-based index of the largest score (first of ties)."""
    s = _c(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def top1_hit(scores: Column | str, label: Column | str) -> Column:
    """SCL-8: ``in_top_k(k=1)`` – the label's score reaches the largest (ties count)."""
    s = _c(scores)
    return F.element_at(s, _c(label).cast("int") + 1) >= F.array_max(s)


def _with_row_const(arr: Column, const: Column, fn) -> Column:
    """``fn(x, c)`` for every element with ``const`` evaluated once per row.

    A value written inside a lambda body is evaluated per element (and the
    optimizer may inline a precomputed column back into it), so per-row
    constants travel next to the elements instead.
    """
    return F.zip_with(arr, F.array_repeat(const, F.size(arr)), fn)


def _sum_shifted_exp(s: Column) -> Column:
    """``struct(m = max(s), t = Σ exp(x - m))`` in one pass; ``m`` is computed once."""
    init = F.struct(F.array_max(s).alias("m"), F.lit(0.0).alias("t"))
    return F.aggregate(s, init, lambda acc, x: F.struct(
        acc.getField("m").alias("m"), (acc.getField("t") + F.exp(x - acc.getField("m"))).alias("t")))


def log_sum_exp(scores: Column | str) -> Column:
    st = _sum_shifted_exp(to_double_array(scores))
    return st.getField("m") + F.log(st.getField("t"))


def softmax(scores: Column | str) -> Column:
    """SCL-9: class probabilities, largest score subtracted for stability (O(n) per row)."""
    s = to_double_array(scores)
    return _with_row_const(s, _sum_shifted_exp(s),
                           lambda x, c: F.exp(x - c.getField("m")) / c.getField("t"))


def cross_entropy(scores: Column | str, label: Column | str) -> Column:
    """ML-2 per row: ``-log softmax(s)[label]`` as log-sum-exp minus the label's
    score (finite where ``log(softmax)`` would give ``log 0``)."""
    s = to_double_array(scores)
    return log_sum_exp(s) - F.element_at(s, _c(label).cast("int") + 1)


def row_mean(arr: Column | str) -> Column:
    a = to_double_array(arr)
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)


def standardize(arr: Column | str) -> Column:
    """SCL-12: ``(x - mean) / max(stddev, 1/sqrt(n))`` over the row's own values.

    Two-pass variance; the mean rides in the accumulator and the bounded
    stddev next to the elements, so every pass is O(n).
    """
    a = to_double_array(arr)
    n = F.size(a).cast("double")
    mean = row_mean(a)
    init = F.struct(mean.alias("mu"), F.lit(0.0).alias("ss"))
    st = F.aggregate(a, init, lambda acc, x: F.struct(
        acc.getField("mu").alias("mu"),
        (acc.getField("ss") + (x - acc.getField("mu")) * (x - acc.getField("mu"))).alias("ss")))
    const = F.struct(st.getField("mu").alias("mu"),
                     F.greatest(F.sqrt(st.getField("ss") / n), F.lit(1.0) / F.sqrt(n)).alias("sd"))
    return _with_row_const(a, const, lambda x, c: (x - c.getField("mu")) / c.getField("sd"))


def l2_term(values: Column | str) -> Column:
    """SCL-15 per element: ``w² / 2`` (sum and multiply by the decay)."""
    v = _c(values).cast("double")
    return v * v / 2


def staircase_decay(start: float, target_factor: float, num_stairs: int, total_steps: float,
                    step: Column | str) -> Column:
    """SCL-6: ``start · ((1/f)^(1/(n-1)))^floor(step / (total/(n-1)))``."""
    decay_step = total_steps / (num_stairs - 1)
    rate = (1.0 / target_factor) ** (1.0 / (num_stairs - 1))
    return F.lit(start) * F.pow(F.lit(rate), F.floor(_c(step).cast("double") / F.lit(decay_step)))

