"""Hold-out splits, shards and split checks (SRT-4, SET-4, SNK-4/5, AGG-12, ML-13).

Randomness comes from hashing a key, never from ``rand()``: the same rows go
to the same split on every cluster and partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_if_small
from .sorting import positions, positions_in_group

HASH_RANGE = 1 << 60
ROWS_PER_FILE = 1_000_000     # rows of a file in a shard, at most
MANIFEST = "_manifest"        # below a shard set; readers of the set skip it
MANIFEST_SCHEMA = "split string, shard int, rows long"


def key_hash(c: Column | str, seed: str, epoch: Column | int = 0) -> Column:
    """60 bits of ``md5("key:epoch:seed")``: the same on every cluster, for any key.

    Splits, batches, replicas and shards use seeds of their own, so that none
    of them is a function of another; DuckDB computes the same number.
    """
    c = F.col(c) if isinstance(c, str) else c
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    text = F.concat_ws(":", c.cast("string"), epoch.cast("string"), F.lit(seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def holdout(df: DataFrame, key: str, n_validation: int, seed: str = "holdout",
            names: tuple[str, str] = ("validation", "train")) -> DataFrame:
    """SRT-4 / SET-4: the first ``n_validation`` rows by ``(key hash, key)`` are
    validation, the rest train (the complement needs no anti join: one
    threshold decides).  Rows with the same key stay together."""
    hashed = df.withColumn("_h", key_hash(key, seed))
    if n_validation <= 0:
        return hashed.withColumn("split", F.lit(names[1])).drop("_h")
    # A top-k of keys: the last of the first n_validation decides for all rows.
    first = hashed.select("_h", F.col(key).alias("_k")).orderBy("_h", F.col("_k").asc_nulls_first()).limit(n_validation)
    last = first.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("_h", "_k")).alias("m")).first()
    if last["n"] < n_validation:
        return hashed.withColumn("split", F.lit(names[0])).drop("_h")
    last = last["m"]
    first = (F.col("_h") < F.lit(last["_h"])) | ((F.col("_h") == F.lit(last["_h"])) & (F.col(key) <= F.lit(last["_k"])))
    return hashed.withColumn("split", F.when(first, names[0]).otherwise(names[1])).drop("_h")


def position_in_group(df: DataFrame, group: str, order: str | list[str], name: str = "pos") -> DataFrame:
    """0-based position inside ``group`` in ``order``; no task holds a whole group."""
    return positions_in_group(df, group, [order] if isinstance(order, str) else order, name)


def assign_shards(df: DataFrame, group: str, order: str, num_shards: int = 5) -> DataFrame:
    """SNK-4 / SCL-14: contiguous shards of size ``ceil(n / num_shards)`` per group."""
    placed = position_in_group(df, group, order, "_pos")
    # one row per group: broadcast only when the group count is small
    sizes = df.groupBy(F.col(group).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    sized = placed.join(broadcast_if_small(sizes), F.col(group).eqNullSafe(F.col("_of")))
    return sized.withColumn("shard", F.floor(F.col("_pos") / F.ceil(F.col("_n") / F.lit(num_shards))).cast("int")).drop("_pos", "_n", "_of")


def shard_name(prefix: str, split: Column, shard: Column, num_shards: int) -> Column:
    """SCL-4: ``<prefix>_<split>_%05d-of-%05d``."""
    return F.format_string(f"{prefix}_%s_%05d-of-%05d", split, shard, F.lit(num_shards))


def write_shards(df: DataFrame, path: str, splits: list[str], num_shards: int, rows_per_file: int = ROWS_PER_FILE) -> str:
    """SNK-4: one folder per (split, shard), each in files of at most ``rows_per_file`` rows; all shuffle partitions write.

    The set is committed by its manifest, which is written last: the rows of every expected shard, empty ones too.
    """
    spark = df.sparkSession
    writers = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // (len(splits) * num_shards))
    (df.repartition("split", "shard", F.pmod(F.xxhash64(*df.columns), F.lit(writers)))
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("split", "shard").parquet(path))
    sizes = _shard_sizes(spark.read.schema(df.schema).parquet(path))
    expected = [(s, k, sizes.get((s, k), 0)) for s in splits for k in range(num_shards)]
    spark.createDataFrame(expected, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    return path


def _shard_sizes(written: DataFrame) -> dict[tuple[str, int], int]:
    """Rows of each shard that has any, from the files' own counts; splits × shards rows."""
    return {(str(r["split"]), int(r["shard"])): r["n"] for r in written.groupBy("split", "shard").agg(F.count(F.lit(1)).alias("n")).collect()}


def shards_complete(spark, path: str, splits: list[str], num_shards: int) -> bool:
    """SNK-5: the manifest lists exactly the expected shards and every one of them holds its rows."""
    if not path_exists(spark, f"{path}/{MANIFEST}/_SUCCESS"):
        return False
    listed = {(r["split"], r["shard"]): r["rows"] for r in spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}").collect()}
    if set(listed) != {(s, k) for s in splits for k in range(num_shards)}:
        return False
    if not any(listed.values()):
        return True
    return _shard_sizes(spark.read.parquet(path)) == {k: n for k, n in listed.items() if n}


def path_exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def write_shards_once(df: DataFrame, path: str, splits: list[str], num_shards: int) -> bool:
    """SNK-5: skip everything when the complete shard set already exists,
    otherwise (re)write it.  Returns whether anything was written."""
    if shards_complete(df.sparkSession, path, splits, num_shards):
        return False
    write_shards(df, path, splits, num_shards)
    return True


def fixed_batches(df: DataFrame, order: str, batch_size: int) -> DataFrame:
    """ML-13: batches of ``batch_size`` in ``order``; the trailing partial batch
    is dropped (``int(n / batch)`` batches)."""
    pos = positions(df, [order], "_pos")
    total = df.count()
    full = (total // batch_size) * batch_size
    return (pos.where(F.col("_pos") < full)
            .withColumn("batch_id", F.floor(F.col("_pos") / batch_size).cast("long")).drop("_pos"))


def epoch_batches(df: DataFrame, key: str, batch_size: int, epochs: int = 1) -> DataFrame:
    """Every row once per ``epoch``, in batches of ``batch_size`` (the last one may
    be short) in the epoch's own order of the key hash."""
    rows = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    rows = rows.withColumn("_h", key_hash(key, "batch", F.col("epoch")))
    pos = positions(rows, ["epoch", "_h", key], "_pos")
    n = df.count()
    place = F.col("_pos") - F.col("epoch") * F.lit(n)
    return pos.withColumn("batch_id", F.floor(place / batch_size).cast("long")).drop("_h", "_pos")
