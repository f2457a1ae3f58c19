"""SRC-13: the input provider of image training and evaluation, as one lazy table.

Training reads ``ceil(batches * batch_size / n)`` epochs, each in an order of its own, as one stream; evaluation reads one
epoch.  The stream is cut into batches of exactly ``batch_size`` across epoch borders; a short batch at its end is
dropped.  Batches are numbered from keys alone: image bytes are read, cropped or padded and standardised once per image, and
meet their places in the stream by the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sorting import positions
from ..operators.splits import key_hash
from .images import TARGET_SIZE, crop_or_pad


def epochs_needed(n: int, batch_size: int, batches: int | None) -> int:
    """Epochs of a run of ``batches`` batches; one for evaluation (``None``)."""
    return 1 if batches is None else -(-batches * batch_size // n) if n else 0


def stream_places(keys: DataFrame, key: str, batch_size: int, batches: int | None = None) -> DataFrame:
    """``(key, epoch, batch_id, place)`` of every use of a key in full batches; ``batches=None`` is evaluation.

    Keys are distinct; an empty table gives an empty table."""
    n = keys.count()
    epochs = epochs_needed(n, batch_size, batches)
    rows = (keys.select(key, F.explode(F.sequence(F.lit(0), F.lit(max(epochs, 1) - 1))).alias("epoch"))
            .withColumn("_h", key_hash(key, "provider", F.col("epoch"))))
    at = F.col("_at")
    full = epochs * n // batch_size if batches is None else min(batches, epochs * n // batch_size)
    return (positions(rows, ["epoch", "_h", key], "_at").where(at < full * batch_size)
            .select(key, "epoch", F.floor(at / batch_size).cast("long").alias("batch_id"), (at % batch_size).cast("int").alias("place")))


def provide(images: DataFrame, keys: DataFrame, key: str, batch_size: int, batches: int | None = None, size: int = TARGET_SIZE,
            keep: tuple[str, ...] = (), summary: bool = False) -> DataFrame:
    """One row for each use of an image: ``(key, *keep, epoch, batch_id, place, pixels, pixel_mean, pixel_scale, ...)``.

    ``images`` are decoded rows with the ``key``; ``keys`` lists the same keys without the bytes (a folder listing), so that numbering reads
    none of them.  ``summary`` gives sums and moments in place of the pixels.
    """
    return at_places(images, stream_places(keys, key, batch_size, batches), key, size, keep, summary)


def at_places(images: DataFrame, places: DataFrame, key: str, size: int = TARGET_SIZE, keep: tuple[str, ...] = (), summary: bool = False) -> DataFrame:
    """``provide`` at given places, of several runs too: each image is prepared once for all of them."""
    ready = crop_or_pad(images, size, size, keep=[key, *keep], summary=summary, standardize=True)
    return ready.join(places, key)
