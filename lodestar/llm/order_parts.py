"""Contiguous key ranges ("parts") of a table in ascending id order, without a driver-side sort.

The bounds are ids of the table itself, found by one pass over the id column alone, so the part of a row is a
binary search over a bounded array and a part's first row is known by its id.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = -(1 << 63)   # the order key of a null id: before all others
MOST_PARTS = 100_000


@dataclass(frozen=True)
class Parts:
    """Ascending first ids of parts 1, 2, ...; ``least`` is the smallest id (None for an empty table); ``hot`` are ids of more rows than a shuffle partition's share."""

    bounds: np.ndarray
    least: int | None
    hot: tuple[int, ...] = ()

    @property
    def count(self) -> int:
        return len(self.bounds) + 1

    def with_hot_apart(self) -> Parts:
        """The same parts, but a hot id is a part of its own."""
        cuts = {k for h in self.hot for k in (h, h + 1) if k != self.least and k < 1 << 63}
        return Parts(np.array(sorted({*self.bounds.tolist(), *cuts}), np.int64), self.least, self.hot)

    def of(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, keys, side="right")


def order_key(column: str):
    return F.coalesce(F.col(column).cast("long"), F.lit(LEAST))


def parts_of(docs: DataFrame, doc_id: str = "doc_id", per_task: int = 8) -> Parts:
    """About ``per_task`` parts for each shuffle partition, with nearly equal numbers of rows."""
    want = min(MOST_PARTS, per_task * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    quantiles = [i / want for i in range(1, want)]
    keys = docs.select(order_key(doc_id).alias("k"))
    row = keys.agg(F.min("k").alias("least"),
                   F.percentile_approx("k", quantiles, 10 * want).alias("bounds")).first()
    bounds = sorted({b for b in (row["bounds"] or []) if b > row["least"]})
    # An id that several quantiles fall on holds as many parts' rows.
    hot = sorted(k for k, n in Counter(row["bounds"] or []).items() if n > per_task)
    return Parts(np.array(bounds, np.int64), row["least"], tuple(hot))
