from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.sources import images as IM
from lodestar.sources.provider import epochs_needed, provide, stream_places
from lodestar.streaming.precision import final_row, stream_running_precision, write_trigger


def write_png(path, rgb):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(IM.encode_png(rgb))


def test_image_dir_scan_decode_and_crop_pad(spark, tmpdir_path):
    rng = np.random.default_rng(3)
    big = rng.integers(0, 255, (10, 12, 3), dtype=np.uint8)
    small = rng.integers(0, 255, (3, 4, 3), dtype=np.uint8)
    write_png(os.path.join(tmpdir_path, "tulip", "1.png"), big)
    write_png(os.path.join(tmpdir_path, "daisy", "2.png"), small)
    write_png(os.path.join(tmpdir_path, "loose.png"), small)          # directly under the root: skipped
    files = IM.scan_image_dir(spark, tmpdir_path)
    assert sorted((r["class_name"], r["file_name"]) for r in files.collect()) == [("daisy", "2.png"), ("tulip", "1.png")]
    ok, bad = IM.read_images(spark, os.path.join(tmpdir_path, "tulip"))
    r = ok.first()
    assert (r["height"], r["width"], r["channels"]) == (10, 12, 3)
    assert bad.count() == 0
    out = IM.crop_or_pad(ok, 6, 16).first()
    arr = np.asarray(out["pixels"]).reshape(6, 16, 3)
    # rows cropped (10 → 6, offset 2), columns padded (12 → 16, offset 2)
    np.testing.assert_array_equal(arr[:, 2:14], big[2:8].astype(np.float32))
    assert arr[:, :2].sum() == 0 and arr[:, 14:].sum() == 0
    std = IM.crop_or_pad(ok, 6, 16, standardize=True).first()
    z = np.asarray(std["pixels"], dtype=np.float64)
    assert abs(z.mean()) < 1e-5 and abs(z.std() - 1.0) < 1e-4
    assert std["pixel_mean"] == pytest.approx(arr.mean())


def test_stream_drains_queue_to_final_totals(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "scored")
    df = spark.range(0, 250).select(F.col("id"), (F.col("id") % 3 == 0).alias("hit"))
    df.repartition(5, "id").write.parquet(src)
    schema = spark.read.parquet(src).schema
    cum = stream_running_precision(spark, src, schema, bytes_per_trigger=1000)
    assert cum.count() >= 2                          # one row per trigger
    last = final_row(cum).first()
    assert (last["hits"], last["examples"]) == (84, 250)
    whole = stream_running_precision(spark, src, schema)
    assert [tuple(r)[1:3] for r in whole.collect()] == [(84, 250)]    # all bytes fit in one trigger


def test_a_retried_trigger_leaves_one_row(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "sink")
    row = lambda hits, examples: spark.createDataFrame([(hits, examples)], "hits long, examples long")
    for trigger, hits, examples in ((0, 1, 2), (1, 3, 4), (1, 3, 4), (0, 1, 2)):
        write_trigger(row(hits, examples), trigger, out)
    got = spark.read.schema("hits long, examples long, trigger long").parquet(out)
    assert sorted((r["trigger"], r["hits"], r["examples"]) for r in got.collect()) == [(0, 1, 2), (1, 3, 4)]


def test_provider_cuts_full_batches_across_epochs(spark, tmpdir_path):
    rng = np.random.default_rng(5)
    sizes = {f"{k}.png": (3 + k % 4, 2 + k % 5) for k in range(7)}
    for name, (h, w) in sizes.items():
        write_png(os.path.join(tmpdir_path, "rose", name), rng.integers(0, 255, (h, w, 3), dtype=np.uint8))
    ok, _ = IM.read_images(spark, tmpdir_path)
    images = ok.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    keys = IM.scan_image_dir(spark, tmpdir_path).select(F.col("file_name").alias("name"))
    rows = provide(images, keys, "name", 4, 5, size=6).collect()          # 20 uses of 7 images: 3 epochs
    stream = [r for r in sorted(rows, key=lambda r: (r["batch_id"], r["place"]))]
    assert [(r["batch_id"], r["place"]) for r in stream] == [(k // 4, k % 4) for k in range(20)]
    order = [r["name"] for r in stream]
    assert sorted(order[:7]) == sorted(order[7:14]) == sorted(sizes) and order[:7] != order[7:14] and [r["epoch"] for r in stream] == [0] * 7 + [1] * 7 + [2] * 6
    assert all(len(r["pixels"]) == 6 * 6 * 3 and abs(np.mean(r["pixels"])) < 1e-5 for r in stream)
    once = provide(images, keys, "name", 4, None, size=6, summary=True).collect()
    assert len(once) == 4 and {r["epoch"] for r in once} == {0}              # evaluation: one pass, the short batch dropped
    assert epochs_needed(0, 4, 5) == 0 and stream_places(keys.limit(0), "name", 4, 5).count() == 0


def test_summaries_equal_those_of_the_pixels_and_images_are_prepared_once(spark, tmpdir_path):
    from lodestar.sources.provider import at_places
    rng = np.random.default_rng(8)
    for k, (h, w) in enumerate([(3, 9), (12, 4), (8, 8), (11, 13)]):
        write_png(os.path.join(tmpdir_path, "rose", f"{k}.png"), rng.integers(0, 255, (h, w, 3), dtype=np.uint8))
    ok, _ = IM.read_images(spark, tmpdir_path)
    for standardize in (False, True):
        full = {r["path"]: r for r in IM.crop_or_pad(ok, 8, 8, standardize=standardize).collect()}
        for r in IM.crop_or_pad(ok, 8, 8, summary=True, standardize=standardize).collect():
            f = full[r["path"]]
            x = np.asarray(f["pixels"], np.float64).reshape(8, 8, 3)
            at = np.arange(8.0)
            want = (x.sum(), (x * at[:, None, None]).sum(), (x * at[None, :, None]).sum(), f["pixel_mean"], f["pixel_scale"])
            np.testing.assert_allclose((r["total"], r["row_moment"], r["col_moment"], r["pixel_mean"], r["pixel_scale"]), want, rtol=1e-6, atol=1e-3)
    images = ok.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    keys = IM.scan_image_dir(spark, tmpdir_path).select(F.col("file_name").alias("name"))
    places = stream_places(keys, "name", 2, 3).withColumn("split", F.lit("a")).unionByName(stream_places(keys, "name", 2).withColumn("split", F.lit("b")))
    df = at_places(images, places, "name", 8, summary=True)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1
    assert sorted((r["split"], r["batch_id"], r["place"]) for r in df.collect()) == [("a", k // 2, k % 2) for k in range(6)] + [("b", k // 2, k % 2) for k in range(4)]
