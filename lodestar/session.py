"""Session construction and the shared scratch folder.

Iterative jobs cut their lineage with reliable ``DataFrame.checkpoint()`` and
materialise derived inputs (CSV / text renderings of the tables) as written
tables.  Both go to the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent *and* the master is local (tests, bench) do
we pick a private folder ourselves; on a cluster a missing setting is an error,
because a machine-local folder would not survive the loss of an executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

SPARK_ARROW_BYTES = "67108864b"   # Spark's own default of the batch bound
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, app: str = "lodestar",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and a sane partition count."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("LODESTAR_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def bound_arrow_batches(spark: SparkSession) -> None:
    """PRT-5: bound the bytes of an Arrow batch in a session that still has Spark's default.

    A batch is held by the JVM and by a Python worker of every running task at once, so whole
    rows with long texts need a bound in bytes, not only in rows.  A setting of the user's own stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, SPARK_ARROW_BYTES):
        spark.conf.set(key, DEFAULT_CONF[key])


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Order: an explicit ``SparkContext.setCheckpointDir``; the
    ``spark.checkpoint.dir`` setting; a private folder in local mode only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative jobs need a shared, "
                "reliable folder (HDFS/S3/...) to cut lineage")
        configured = tempfile.mkdtemp(prefix="lodestar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for a written table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"lodestar-{name}-{uuid.uuid4().hex[:12]}")


def local_path(uri: str) -> str:
    """A path Python file IO inside tasks can use: ``file:`` URIs and plain
    paths only.  Other schemes must be mounted on the executors first."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    if "://" in uri:
        raise ValueError(f"{uri!r}: Python tasks can only write to a mounted file system")
    return uri


def free_shuffles(spark: SparkSession) -> None:
    """Collect the driver's garbage, upon which Spark deletes the shuffle files that no frame reads any more.

    Its own collection comes each half hour; a loop of many shuffles cut by checkpoints would keep all its files till then."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def shuffles_end_with_queries(spark: SparkSession) -> Iterator[None]:
    """Frames made in here lose their shuffle files as soon as a query over them ends, without waiting for the driver's garbage.

    For loops that run each frame once and cut it by a checkpoint; a frame that is run again shuffles anew."""
    own = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, own)
