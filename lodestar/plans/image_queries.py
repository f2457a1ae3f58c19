"""Image-set queries (SRC-6/7/13, SCL-5/10/11/12) on images Spark derives
from ``embeddings``: every row becomes an 8×8 RGB PNG in the folder of its
class (``digit_<label>``), written by the tasks into the shared folder.

Pixel rule (fixed): value v → byte ``clip(floor((v + 1) · 128), 0, 255)``;
red from v, green from −v, blue from v/2; pixel (r, c) holds feature
``r · side + c``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import labels as L
from ..session import local_path, scratch_path
from ..sources import images as IM
from ..sinks.tables import write_table
from ..sources.provider import at_places, stream_places
from ..sources.tables import table
from .registry import query


def _byte(v: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((v.astype(np.float64) + 1.0) * 128.0), 0, 255).astype(np.uint8)


def _writer(root: str):
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            paths = []
            for vid, label, feats in zip(pdf["vec_id"], pdf["label"], pdf["embedding"]):
                v = np.asarray(feats, dtype=np.float32)
                side = int(np.sqrt(len(v)))
                v = v[: side * side].reshape(side, side)
                rgb = np.stack([_byte(v), _byte(-v), _byte(v / 2.0)], axis=-1)
                folder = os.path.join(root, f"digit_{int(label)}")
                os.makedirs(folder, exist_ok=True)
                path = os.path.join(folder, f"{int(vid)}.png")
                with open(path, "wb") as fh:       # same bytes on a retried task
                    fh.write(IM.encode_png(rgb))
                paths.append(path)
            yield pd.DataFrame({"path": paths})
    return fn


def write_embedding_images(spark: SparkSession, sf_dir: str) -> str:
    """Write the image tree; returns its root.  Needs the checkpoint folder to
    be a shared file system mounted on every executor."""
    root = local_path(scratch_path(spark, "images"))
    os.makedirs(root, exist_ok=True)
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    emb.mapInPandas(_writer(root), "path string").write.format("noop").mode("overwrite").save()
    return root


def _vec_id(c="file_name"):
    return F.regexp_extract(F.col(c), r"^(\d+)\.", 1).try_cast("long")


IMAGE_CLASS_SQL = """SELECT vec_id, 'digit_' || label AS class_name FROM embeddings"""


@query("src_image_dir", oracle=f"""WITH C AS ({IMAGE_CLASS_SQL}),
I AS (SELECT CAST(row_number() OVER (ORDER BY class_name) - 1 AS INTEGER) AS label, class_name
      FROM (SELECT DISTINCT class_name FROM C))
SELECT C.vec_id, C.class_name, I.label FROM C JOIN I USING (class_name)""")
def src_image_dir(spark, sf_dir):
    """SRC-6 / SCL-5 / SRT-3 / JN-3: two-level listing, class = parent folder,
    classes numbered in sorted order."""
    files = IM.scan_image_dir(spark, write_embedding_images(spark, sf_dir))
    classes = L.index_sorted_names(files.select(F.col("class_name").alias("name")))
    matched, _ = L.lookup_labels(files, classes, "class_name")
    return matched.select(_vec_id().alias("vec_id"), "class_name", "label")


@query("src_image_dims", oracle="""SELECT vec_id, CAST(floor(sqrt(len(embedding))) AS INTEGER) AS height,
  CAST(floor(sqrt(len(embedding))) AS INTEGER) AS width, 3 AS channels FROM embeddings""")
def src_image_dims(spark, sf_dir):
    """SRC-7: decode with the built-in image source; 3 channels asserted."""
    ok, _bad = IM.read_images(spark, write_embedding_images(spark, sf_dir))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return ok.select(F.regexp_extract(name, r"^(\d+)\.", 1).try_cast("long").alias("vec_id"),
                     "height", "width", "channels")


def _byte_sql(expr: str) -> str:
    return f"least(greatest(floor((CAST({expr} AS DOUBLE) + 1.0) * 128.0), 0), 255)"


@query("image_crop_pad", oracle=f"""WITH P AS (
  SELECT vec_id, CAST(floor(sqrt(len(embedding))) AS INTEGER) AS side,
    CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS k, unnest(embedding) AS v FROM embeddings),
Q AS (SELECT vec_id, side, k // side AS r, k % side AS c,
    {_byte_sql('v')} + {_byte_sql('-v')} + {_byte_sql('CAST(v AS DOUBLE) / 2.0')} AS px
  FROM P WHERE k < side * side)
SELECT vec_id, sum(px) AS total, sum(px * (r + (256 - side) // 2)) AS row_moment,
  sum(px * (c + (256 - side) // 2)) AS col_moment, 256 AS out_height, 256 AS out_width
FROM Q GROUP BY vec_id, side""")
def image_crop_pad(spark, sf_dir):
    """SCL-11: decode, centre crop/pad to 256×256, RGB floats; reported per
    image as sum and row/column moments of the output array."""
    ok, _bad = IM.read_images(spark, write_embedding_images(spark, sf_dir))
    out = IM.crop_or_pad(ok, keep=["path"], summary=True)
    return out.select(F.regexp_extract(F.regexp_extract("path", r"([^/]+)$", 1), r"^(\d+)\.", 1)
                      .try_cast("long").alias("vec_id"),
                      "total", "row_moment", "col_moment", "out_height", "out_width")


@query("image_standardize", oracle=f"""WITH P AS (
  SELECT vec_id, CAST(floor(sqrt(len(embedding))) AS INTEGER) AS side,
    CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS k, unnest(embedding) AS v FROM embeddings),
Q AS (SELECT vec_id, side, {_byte_sql('v')} AS r, {_byte_sql('-v')} AS g,
    {_byte_sql('CAST(v AS DOUBLE) / 2.0')} AS b FROM P WHERE k < side * side),
S AS (SELECT vec_id, sum(r + g + b) AS s1, sum(r * r + g * g + b * b) AS s2, 256.0 * 256.0 * 3.0 AS n
  FROM Q GROUP BY vec_id)
SELECT vec_id, round(s1 / n, 6) AS pixel_mean,
  round(greatest(sqrt(s2 / n - (s1 / n) * (s1 / n)), 1.0 / sqrt(n)), 6) AS pixel_scale FROM S""")
def image_standardize(spark, sf_dir):
    """SRC-13 feed: decode → float → crop/pad to 256×256 → per-image
    standardisation (SCL-10/11/12); the mean and bounded std used per image."""
    ok, _bad = IM.read_images(spark, write_embedding_images(spark, sf_dir))
    out = IM.crop_or_pad(ok, keep=["path"], summary=True, standardize=True)
    return out.select(F.regexp_extract(F.regexp_extract("path", r"([^/]+)$", 1), r"^(\d+)\.", 1)
                      .try_cast("long").alias("vec_id"),
                      F.round("pixel_mean", 6).alias("pixel_mean"), F.round("pixel_scale", 6).alias("pixel_scale"))


# ------------------------------------------------------------- input provider
PROVIDER_BATCH, PROVIDER_BATCHES = 32, 20     # rows of a batch, batches of the training run
_ORDER = "CAST('0x' || substr(md5(vec_id || ':' || epoch || ':provider'), 1, 15) AS BIGINT)"


@query("src_provider", oracle=f"""WITH P AS (
  SELECT vec_id, CAST(floor(sqrt(len(embedding))) AS INTEGER) AS side,
    CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS k, unnest(embedding) AS v FROM embeddings),
Q AS (SELECT vec_id, side, {_byte_sql('v')} AS r, {_byte_sql('-v')} AS g,
    {_byte_sql('CAST(v AS DOUBLE) / 2.0')} AS b FROM P WHERE k < side * side),
S AS (SELECT vec_id, sum(r + g + b) AS s1, sum(r * r + g * g + b * b) AS s2, 256.0 * 256.0 * 3.0 AS n FROM Q GROUP BY vec_id),
IMG AS (SELECT E.vec_id, 'digit_' || label AS class_name, round(s1 / n, 6) AS pixel_mean,
  round(greatest(sqrt(s2 / n - (s1 / n) * (s1 / n)), 1.0 / sqrt(n)), 6) AS pixel_scale FROM S JOIN embeddings E USING (vec_id)),
N AS (SELECT count(*) AS n FROM IMG),
RUN AS (SELECT 'train' AS split, ({PROVIDER_BATCH * PROVIDER_BATCHES} + n - 1) // n AS epochs, least({PROVIDER_BATCHES}, ({PROVIDER_BATCH * PROVIDER_BATCHES} + n - 1) // n * n // {PROVIDER_BATCH}) AS whole FROM N
  UNION ALL SELECT 'validation', 1, n // {PROVIDER_BATCH} FROM N),
ST AS (SELECT split, whole, epoch, vec_id, row_number() OVER (PARTITION BY split ORDER BY epoch, {_ORDER}, vec_id) - 1 AS pos
  FROM (SELECT split, whole, CAST(unnest(range(epochs)) AS INTEGER) AS epoch FROM RUN), (SELECT vec_id FROM IMG))
SELECT split, epoch, pos // {PROVIDER_BATCH} AS batch_id, CAST(pos % {PROVIDER_BATCH} AS INTEGER) AS place, vec_id, class_name, pixel_mean, pixel_scale
FROM ST JOIN IMG USING (vec_id) WHERE pos < whole * {PROVIDER_BATCH}""")
def src_provider(spark, sf_dir):
    """SRC-13: the training run (20 batches of 32 over as many epochs as they take) and one pass of evaluation, all batches full."""
    root = write_embedding_images(spark, sf_dir)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    # The folders are listed once: counts and numbering read the written keys.
    keys = write_table(IM.scan_image_dir(spark, root).select(_vec_id().alias("vec_id")), "image-keys")
    decoded, _bad = IM.read_images(spark, root)
    images = (decoded.withColumn("file_name", name).withColumn("vec_id", _vec_id())
              .withColumn("class_name", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)))
    places = None
    for split, batches in (("train", PROVIDER_BATCHES), ("validation", None)):
        own = stream_places(keys, "vec_id", PROVIDER_BATCH, batches).withColumn("split", F.lit(split))
        places = own if places is None else places.unionByName(own)
    out = at_places(images, places, "vec_id", keep=("class_name",), summary=True)
    return out.select("split", "epoch", "batch_id", "place", "vec_id", "class_name",
                      F.round("pixel_mean", 6).alias("pixel_mean"), F.round("pixel_scale", 6).alias("pixel_scale"))
