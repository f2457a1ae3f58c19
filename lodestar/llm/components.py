"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two grouped minima with a join each, so a node of any degree is spread over the tasks of its edges; nothing is
collected.  Rounds are cut by written tables, whose small files are read by few tasks, and joins stay shuffled: the driver
then keeps no broadcast tables, and few tasks and exchanges, of rounds that may be many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import free_shuffles, scratch_path
from ..sinks.tables import delete_path

MAX_ROUNDS = 60
BLOCK = 1_000_000    # edges that a task contracts at once


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def _least(edges: DataFrame) -> DataFrame:
    """Of each node: the least of its neighbourhood, and whether it is the centre of a star or hangs on one centre only."""
    smaller, larger = F.count_if(F.col("b") < F.col("a")), F.count_if(F.col("b") > F.col("a"))
    return _both_ways(edges).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"),
                                              ((smaller == 0) | ((smaller == 1) & (larger == 0))).alias("star"))


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbourhood: a row for each edge, its end ``a`` the larger."""
    return (_both_ways(edges).where(F.col("b") > F.col("a")).join(least.select("a", "m").hint("merge"), "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(down: DataFrame) -> DataFrame:
    """Each node ``a`` links itself and its smaller neighbours ``b`` to the least of them."""
    linked = down.join(down.groupBy("a").agg(F.min("b").alias("m")).hint("merge"), "a")
    return (linked.select(F.inline(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
            .where(F.col("a") != F.col("b")).distinct())


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the least node of its component, of the components of these edges."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    own = np.arange(len(nodes))
    root, before = own.copy(), None
    while before is None or (root != before).any():
        before, low = root.copy(), np.minimum(root[x], root[y])
        np.minimum.at(root, before[x], low)
        np.minimum.at(root, before[y], low)
        while (root[root] != root).any():
            root = root[root]
    hung = root != own
    return nodes[hung], nodes[root[hung]]


def contracted(edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` with the components of ``edges``: each block of at most ``block`` edges is replaced by its stars.

    Components over edges that fit one block then take no round, others fewer.  ``edges`` are counted first, so they
    should be a written table; a task holds one block at a time."""
    tasks = max(1, -(-edges.count() // block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> pa.RecordBatch:
            a, b = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in held]) for i in range(2))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v) for v in _stars(a, b)], ["a", "b"])

        for batch in batches:
            for at in range(0, batch.num_rows, block):
                piece = batch.slice(at, block)
                if held and sum(x.num_rows for x in held) + piece.num_rows > block:
                    yield stars()
                held.append(piece)
        if held:
            yield stars()

    return (edges.select("a", "b").where(F.col("a") != F.col("b")).coalesce(tasks)
            .mapInArrow(run, "a long, b long"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of the edges ``(a, b)``; a component is named by its least node.

    Loops and repeated edges are harmless; an empty edge table gives an empty table."""
    spark = edges.sparkSession
    path = scratch_path(spark, "components")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    now = written(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "edges-0")
    for i in range(MAX_ROUNDS):
        least = written(_least(now), f"least-{i}")
        # Where every component is a star, its least node is the centre: a further round would give the same edges.
        if least.agg(F.coalesce(F.bool_and("star"), F.lit(True))).first()[0]:
            delete_path(spark, f"{path}/edges-{i}")
            return least.select(F.col("a").alias("node"), F.col("m").alias("component"))
        now = written(_small_star(_large_star(now, least)), f"edges-{i + 1}")
        for name in ("edges", "least"):
            delete_path(spark, f"{path}/{name}-{i}")
        free_shuffles(spark)
    raise RuntimeError("components did not settle")
