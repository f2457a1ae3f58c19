"""SRT-1: global sort by composite keys, and positions without a global window.

``orderBy`` plans as range partitioning (sampled bounds) + an external,
spillable sort per partition.

``positions`` numbers rows in key order and writes nothing.  A pass over the
keys alone range-partitions them and keeps, of each range, its least key and
its number of rows: a histogram of one row per range.  A row then finds its
range by a binary search over those least keys, and its position is the
number of rows of earlier ranges plus its row number inside its own.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .joins import HOT_ROWS, heavy_hitters


def key_columns(df: DataFrame, keys: Sequence[str | int]) -> list[Column]:
    """PRJ-1: keys by name or by 0-based position."""
    return [F.col(df.columns[k]) if isinstance(k, int) else F.col(k) for k in keys]


def sort_by_keys(df: DataFrame, keys: Sequence[str | int], descending: bool = False) -> DataFrame:
    """Global order by ``keys`` (nulls first when ascending); rows unchanged."""
    cols = key_columns(df, keys)
    return df.orderBy(*[c.desc_nulls_last() if descending else c.asc_nulls_first() for c in cols])


# Keys survive JSON exactly: numbers do by themselves, times need all their digits.
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


TREE_RANGES = 256   # ranges up to which the search is an expression of comparisons, which compiles; beyond, a loop over one constant


def _range_of(key: Column, kind: str, least: list[str]) -> Column:
    """Number of the least keys (JSON, ascending) that are not above ``key``, by binary search."""
    bounds = F.from_json(F.lit("[" + ",".join(least) + "]"), f"array<{kind}>", _EXACT)
    key = key.cast(kind)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.get(bounds, F.lit(middle)) <= key, between(middle + 1, high)).otherwise(between(low, middle))

    if len(least) < TREE_RANGES:
        return between(0, len(least))
    steps = [1 << k for k in reversed(range(len(least).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0),
                       lambda at, step: F.when(F.get(bounds, at + step - 1) <= key, at + step).otherwise(at))


def key_ranges(df: DataFrame, cols: Sequence[Column], ranges: int | None = None) -> tuple[Column, list[int], list[str]]:
    """``(range of a row, rows before each range, least key of each range as JSON)``; one row per range reaches the driver."""
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])
    own = df.select(key.alias("_key"))
    kind = own.schema["_key"].dataType.simpleString()
    n = ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (own.repartitionByRange(n, "_key").groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min("_key").alias("least"), F.count(F.lit(1)).alias("n"))
             .select("p", F.to_json("least", _EXACT).alias("least"), "n").collect())
    found.sort(key=lambda r: r["p"])
    before, total = [], 0
    for r in found:
        before.append(total)
        total += r["n"]
    least = [r["least"] for r in found]
    return _range_of(key, kind, least[1:]), before, least


def positions(df: DataFrame, keys: Sequence[str | int], name: str = "position", ranges: int | None = None) -> DataFrame:
    """Append each row's 0-based position in the order of ``keys`` (ascending, nulls first; ties in any order).

    ``df`` is read twice for its keys (sampled and counted) and once for its rows, so it must give the same rows
    each time; rows are shuffled once, to their range, and never written.  Rows with equal keys share a range, so keys
    should tell most rows apart.  ``ranges`` is twice the shuffle partitions by default; an empty table gives an empty table.
    """
    cols = key_columns(df, keys)
    of, before, _ = key_ranges(df, cols, ranges)
    inside = Window.partitionBy("_range").orderBy(*[c.asc_nulls_first() for c in cols])
    offsets = F.from_json(F.lit(json.dumps(before or [0])), "array<bigint>")
    return (df.withColumn("_range", of)
            .select(*df.columns, (F.get(offsets, F.col("_range")) + F.row_number().over(inside) - 1).alias(name)))


def positions_in_group(df: DataFrame, group: str, keys: Sequence[str], name: str = "position", ranges: int | None = None) -> DataFrame:
    """Append each row's 0-based position inside its ``group`` in the order of ``keys``; a group of any size is spread over ranges.

    Most groups lie in one range, where a row number is the position.  A group that goes on in a later range begins that range, so it is
    among the least keys; the rows of these groups (at most one for each range) are counted by range, and a row adds those before its range.

    Without ``ranges``, groups are first looked through for large ones by a sketch; if there are none, a plain row number does.
    """
    spark = df.sparkSession
    if ranges is None:
        total = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(group)).alias("named")).first()
        if total["n"] - total["named"] <= HOT_ROWS and not heavy_hitters(df, group, total["n"]):
            order = [c.asc_nulls_first() for c in key_columns(df, keys)]
            return df.withColumn(name, (F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1).cast("long"))
    own, cols = F.col(group), key_columns(df, keys)
    of, _, least = key_ranges(df, [own, *cols], ranges)
    kind = df.select(group).schema[0].dataType.simpleString()
    spread = (spark.createDataFrame([(x,) for x in least[1:]], "key string")
              .select(F.from_json("key", f"k0 {kind}", _EXACT)["k0"].alias("_group")).distinct())
    met = (df.withColumn("_range", of).join(F.broadcast(spread), own.eqNullSafe(F.col("_group")))
           .groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("n")))   # each range holds at most two groups that go on
    earlier = met.select("_group", F.col("_range").alias("_at"),
                         (F.sum("n").over(Window.partitionBy("_group").orderBy("_range")) - F.col("n")).alias("_before"))
    inside = Window.partitionBy("_range", group).orderBy(*[c.asc_nulls_first() for c in cols])
    placed = df.withColumn("_range", of).withColumn("_row", F.row_number().over(inside) - 1)
    return (placed.join(F.broadcast(earlier), (F.col("_range") == F.col("_at")) & own.eqNullSafe(F.col("_group")), "left")
            .select(*df.columns, (F.coalesce("_before", F.lit(0)) + F.col("_row")).alias(name)))


def with_position(sorted_df: DataFrame, name: str = "position") -> DataFrame:
    """Append the 0-based position of each row in the order of ``sorted_df``.

    ``sorted_df`` must be the direct result of a global sort.  The partition
    index and the in-partition row index are taken in the same projection and
    materialised by a reliable checkpoint, so counting and numbering see the
    same partitions.
    """
    checkpoint_dir(sorted_df.sparkSession)
    cols = sorted_df.columns
    mat = (sorted_df.select("*", F.spark_partition_id().alias("_pid"),
                            F.monotonically_increasing_id().alias("_mid"))
           .checkpoint(eager=True))
    counts = mat.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a window over it is bounded by the partition count.
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (mat.join(F.broadcast(offsets), "_pid")
            .select(*cols, (F.col("_off") + local).alias(name)))
