"""Example records: split readers with field defaults (SRC-8, SRC-9, FLT-5).

Records are parquet partitioned by ``split`` (and ``shard``), so reading one
split prunes the other folders.  Missing fields take the layout's defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Split sizes and field defaults of the two record layouts.
FLOWER_SPLITS = {"train": 3320, "validation": 350}
FLOWER_DEFAULTS = {"encoded": "", "format": "png", "label": 0}
BOX_SPLITS = {"train": 1281167, "validation": 50000}
BOX_DEFAULTS = {"encoded": "", "format": "jpeg", "label": -1, "text": ""}
BOX_ORDER = ("ymin", "xmin", "ymax", "xmax")


def check_split(split: str, sizes: dict[str, int]) -> None:
    """FLT-5: an unknown split name is an error before any job runs."""
    if split not in sizes:
        raise ValueError(f"split name {split} was not recognized.")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
                       if c in defaults else F.col(c) for c in df.columns])


def get_split(spark: SparkSession, path: str, split: str,
              sizes: dict[str, int] = FLOWER_SPLITS,
              defaults: dict[str, object] = FLOWER_DEFAULTS) -> DataFrame:
    """SRC-8: one split of a record table, defaults applied."""
    check_split(split, sizes)
    df = spark.read.parquet(path).where(F.col("split") == F.lit(split))
    return with_defaults(df, defaults)


def get_box_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """SRC-9: records with four ragged coordinate arrays and object labels."""
    return get_split(spark, path, split, BOX_SPLITS, BOX_DEFAULTS)


def boxes(records: DataFrame, keys: list[str]) -> DataFrame:
    """SRC-9 bounding boxes ``[ymin, xmin, ymax, xmax]``: one row per box.

    ``arrays_zip`` pairs the i-th entries; ``posexplode_outer`` keeps records
    without boxes (one row with null box fields).
    """
    zipped = F.arrays_zip(*[F.col(c) for c in BOX_ORDER], F.col("object_label"))
    cols = [*keys, "text", "format", "label"]
    ex = records.select(*cols, F.posexplode_outer(zipped).alias("box", "b"))
    return ex.select(*cols, "box", *[F.col("b").getField(c).alias(c) for c in BOX_ORDER],
                     F.col("b").getField("object_label").alias("object_label"))
