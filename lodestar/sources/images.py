"""Image sources and the crop-or-pad operator (SRC-6, SRC-7, SCL-5, SCL-11).

* directory scan: Spark's ``binaryFile`` source lists the tree; the class is
  the parent folder (files directly under the root are skipped); the content
  column is not selected, so no bytes are read for the listing;
* decode: Spark's built-in ``image`` source (BGR bytes, height, width,
  channels); images without exactly 3 channels are rejected;
* crop or pad: centre crop / zero pad to a fixed size in Arrow batches
  (``mapInPandas``), returning RGB floats.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The image extensions scanned and the reference's target size.
IMAGE_GLOB = "*.{png,jpg,jpeg,PNG,JPG,JPEG}"
TARGET_SIZE = 256
OUTPUT_CHUNK = 64          # images per output Arrow batch when full arrays are returned


def encode_png(rgb: np.ndarray) -> bytes:
    """8-bit RGB PNG (no filter, one IDAT) – a small per-image helper."""
    h, w, _ = rgb.shape

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + rgb[r].astype(np.uint8).tobytes() for r in range(h))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def _root(root: str) -> str:
    return root.rstrip("/")


def scan_image_dir(spark: SparkSession, root: str) -> DataFrame:
    """SRC-6 / SCL-5: ``(path, class_name, file_name)`` for ``root/<class>/<file>``."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", IMAGE_GLOB).load(root).select("path"))
    base = _root(root).split(":", 1)[-1] if root.startswith("file:") else _root(root).split("://")[-1]
    base = base.replace("'", "''")
    rel = F.expr(f"substring(path, instr(path, '{base}') + {len(base)} + 1)")
    two_level = rel.rlike(r"^[^/]+/[^/]+$")      # files directly under the root are skipped
    return files.where(two_level).select(
        "path",
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("class_name"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"))


def read_images(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """SRC-7: decoded images ``(path, height, width, channels, data)`` with 3
    channels, and the rejected ones (undecodable or other channel counts)."""
    img = (spark.read.format("image").option("recursiveFileLookup", True)
           .option("pathGlobFilter", IMAGE_GLOB).load(root))
    flat = img.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"),
                      F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"),
                      F.col("image.data").alias("data"))
    ok = (F.col("channels") == 3) & (F.col("height") > 0)
    return flat.where(ok), flat.where(~ok)


def _crop_pad(h: int, w: int, th: int, tw: int, img: np.ndarray) -> np.ndarray:
    """Centre crop where larger, centre zero-pad where smaller (per axis)."""
    out = np.zeros((th, tw, img.shape[2]), dtype=np.float32)
    part, dy, dx = _crop(h, w, th, tw, img)
    out[dy:dy + part.shape[0], dx:dx + part.shape[1]] = part
    return out


def _crop(h: int, w: int, th: int, tw: int, img: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The part of the image that stays, and its row and column in the target."""
    ch, cw = min(h, th), min(w, tw)
    sy, sx = max((h - th) // 2, 0), max((w - tw) // 2, 0)
    return img[sy:sy + ch, sx:sx + cw], max((th - h) // 2, 0), max((tw - w) // 2, 0)


def crop_or_pad(images: DataFrame, height: int = TARGET_SIZE, width: int = TARGET_SIZE,
                keep: list[str] | None = None, summary: bool = False,
                standardize: bool = False) -> DataFrame:
    """SCL-11 (+ SCL-10 to float): RGB ``float`` arrays of ``height × width × 3``.

    Lower ``spark.sql.execution.arrow.maxRecordsPerBatch`` for large images: it
    bounds the input batch; the output is emitted in chunks of
    ``OUTPUT_CHUNK`` images.  With ``summary`` each image is reduced in the same task to
    ``(total, row_moment, col_moment)`` – sum of values and sums weighted by
    the row / column index – instead of returning the full array.

    ``standardize`` (SCL-12, as the input provider does after crop/pad):
    ``(x - mean) / max(std, 1/sqrt(N))`` over the padded image; the mean and
    the bounded std are returned as ``pixel_mean`` / ``pixel_scale``.
    """
    keep = keep or ["path"]

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            # bounded output batches: a full 256×256×3 float image is 786 KB
            step = len(whole) if summary else OUTPUT_CHUNK
            for lo in range(0, len(whole), max(step, 1)):
                yield _one(whole.iloc[lo:lo + step])

    def _one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        stats = []
        lines, columns = np.arange(height, dtype=np.float64), np.arange(width, dtype=np.float64)
        size = height * width * 3
        for h, w, c, data in zip(pdf["height"], pdf["width"], pdf["channels"], pdf["data"]):
            bgr = np.frombuffer(data, dtype=np.uint8).reshape(int(h), int(w), int(c))
            if summary:
                # Sums over the cropped part alone: the padding adds zeros.  Bytes are whole numbers, so these sums are exact.
                part, top, left = _crop(int(h), int(w), height, width, bgr.astype(np.float64))
                plane = part.sum(axis=2)
                by_line, by_column = plane.sum(axis=1), plane.sum(axis=0)
                total = float(plane.sum())
                sums = (total, float(by_line @ lines[top:top + len(by_line)]), float(by_column @ columns[left:left + len(by_column)]))
                mu = total / size
                variance = max(float((part * part).sum()) / size - mu * mu, 0.0)
                scale = max(float(np.sqrt(variance)), 1.0 / np.sqrt(size))
                stats.append((mu, scale))
                if standardize:
                    whole = (size, 3.0 * width * lines.sum(), 3.0 * height * columns.sum())
                    sums = tuple((s - mu * n) / scale for s, n in zip(sums, whole))
                rows.append(sums)
                continue
            out = _crop_pad(int(h), int(w), height, width, bgr[:, :, ::-1].astype(np.float32))
            o64 = out.astype(np.float64)
            mu = float(o64.mean())
            scale = max(float(o64.std()), 1.0 / np.sqrt(o64.size))
            stats.append((mu, scale))
            if standardize:
                out = ((o64 - mu) / scale).astype(np.float32)
            rows.append(out.ravel())
        res = pdf[keep].copy()
        if summary:
            res["total"], res["row_moment"], res["col_moment"] = zip(*rows) if rows else ([], [], [])
        else:
            res["pixels"] = rows
        res["pixel_mean"] = [m for m, _ in stats]
        res["pixel_scale"] = [c for _, c in stats]
        res["out_height"], res["out_width"] = height, width
        return res

    fields = {f.name: f.dataType.simpleString() for f in images.schema.fields}
    cols = ", ".join(f"{k} {fields[k]}" for k in keep)
    tail = ("total double, row_moment double, col_moment double" if summary else "pixels array<float>")
    return images.mapInPandas(fn, f"{cols}, {tail}, pixel_mean double, pixel_scale double, "
                                  "out_height int, out_width int")
