from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lodestar.operators import labels as L
from lodestar.operators import splits as S
from lodestar.sources import examples as X


def test_label_file_first_colon_blank_lines_last_wins(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "labels.txt")
    with open(path, "w") as fh:
        fh.write("0:tulip\n\n3:a:b\n1:rose\n1:daisy\nbad line\n")
    lm, bad = L.read_label_file(spark, path)
    assert sorted((r["label"], r["name"]) for r in lm.collect()) == [(0, "tulip"), (1, "daisy"), (3, "a:b")]
    assert [r["value"] for r in bad.collect()] == ["bad line"]


def test_label_round_trip_and_index(spark, tmpdir_path):
    names = spark.createDataFrame([("tulip",), ("daisy",), ("rose",), ("daisy",)], "name string")
    idx = L.index_sorted_names(names)
    assert [(r["label"], r["name"]) for r in idx.orderBy("label").collect()] == \
        [(0, "daisy"), (1, "rose"), (2, "tulip")]
    path = L.write_label_file(idx, os.path.join(tmpdir_path, "lab"))
    lm, _ = L.read_label_file(spark, path)
    assert sorted(tuple(r) for r in lm.collect()) == sorted(tuple(r) for r in idx.collect())
    assert L.has_labels(spark, path)
    assert not L.has_labels(spark, os.path.join(tmpdir_path, "missing"))


def test_lookup_reports_unmatched(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "zz")], "id int, name string")
    lm = spark.createDataFrame([(0, "a")], "label int, name string")
    matched, missing = L.lookup_labels(docs, lm, "name")
    assert [r["id"] for r in matched.collect()] == [1]
    assert [r["id"] for r in missing.collect()] == [2]


def test_unknown_split_raises_before_any_job(spark):
    with pytest.raises(ValueError, match="not recognized"):
        X.get_split(spark, "/nonexistent", "test")


def test_defaults_and_boxes(spark, tmpdir_path):
    rec = spark.createDataFrame(
        [(1, None, None, None, "train", [0.1, 0.2], [0.3, 0.4], [0.5, 0.6], [0.7, 0.8], [1, 2]),
         (2, "t", "png", 7, "train", [], [], [], [], [])],
        "k int, text string, format string, label long, split string, ymin array<float>, "
        "xmin array<float>, ymax array<float>, xmax array<float>, object_label array<long>")
    rec = rec.withColumn("encoded", F.lit(None).cast("string"))
    path = os.path.join(tmpdir_path, "boxes")
    rec.write.partitionBy("split").parquet(path)
    got = X.get_box_split(spark, path, "train")
    row1 = [r for r in got.collect() if r["k"] == 1][0]
    assert (row1["text"], row1["format"], row1["label"], row1["encoded"]) == ("", "jpeg", -1, "")
    boxes = X.boxes(got, ["k"]).orderBy("k", "box").collect()
    assert [(r["k"], r["box"], r["object_label"]) for r in boxes] == [(1, 0, 1), (1, 1, 2), (2, None, None)]


def test_holdout_and_shards(spark, tmpdir_path):
    df = spark.range(1000).select(F.col("id").alias("doc_id"))
    h = S.holdout(df, "doc_id", 350)
    counts = {r["split"]: r["count"] for r in h.groupBy("split").count().collect()}
    assert counts == {"validation": 350, "train": 650}
    big = S.holdout(df, "doc_id", 350)
    assert sorted(r["doc_id"] for r in big.where("split = 'validation'").collect()) == \
        sorted(r["doc_id"] for r in h.where("split = 'validation'").collect())
    sh = S.assign_shards(h.withColumn("_h", S.key_hash("doc_id", "holdout")), "split", "_h", 5)
    sizes = {(r["split"], r["shard"]): r["count"] for r in sh.groupBy("split", "shard").count().collect()}
    assert sizes[("train", 0)] == 130 and sizes[("validation", 4)] == 70
    path = os.path.join(tmpdir_path, "shards")
    splits, rows = ["train", "validation"], sh.drop("_h")
    S.write_shards(rows, path, splits, 5, rows_per_file=40)
    assert S.shards_complete(spark, path, splits, 5) and spark.read.parquet(path).count() == 1000
    files = spark.read.parquet(path).where("split = 'train' and shard = 0").select(F.input_file_name()).distinct().count()
    assert files > 1                                   # a shard of 130 rows in files of at most 40
    # complete set: skipped; other expectations or a half-written set: rewritten
    assert not S.write_shards_once(rows, path, splits, 5)
    assert not S.shards_complete(spark, path, splits, 6) and not S.shards_complete(spark, path, ["train"], 5)
    part = os.path.join(tmpdir_path, "partial")
    rows.where("shard < 2").write.partitionBy("split", "shard").parquet(part)    # no manifest: the writer died
    assert S.write_shards_once(rows, part, splits, 5)
    assert spark.read.parquet(part).count() == 1000
    spark.range(1).select(F.lit(1000).alias("doc_id"), F.lit("train").alias("split"), F.lit(0).alias("shard")) \
        .write.mode("append").partitionBy("split", "shard").parquet(part)        # rows that the manifest does not know
    assert S.write_shards_once(rows, part, splits, 5) and spark.read.parquet(part).count() == 1000


def test_empty_shards_are_complete(spark, tmpdir_path):
    rows = spark.createDataFrame([(i, "train", i) for i in range(3)], "doc_id long, split string, shard int")
    path = os.path.join(tmpdir_path, "few")
    assert S.write_shards_once(rows, path, ["train", "validation"], 5)
    assert not S.write_shards_once(rows, path, ["train", "validation"], 5)
    none = os.path.join(tmpdir_path, "none")
    assert S.write_shards_once(rows.limit(0), none, ["train"], 2) and not S.write_shards_once(rows.limit(0), none, ["train"], 2)


def test_fixed_batches_drop_remainder(spark):
    df = spark.range(1050).select(F.col("id").alias("k"))
    b = S.fixed_batches(df, "k", 100)
    assert b.count() == 1000
    assert b.select("batch_id").distinct().count() == 10


def _hash(key, seed, epoch=0):
    import hashlib
    return int(hashlib.md5(f"{key}:{epoch}:{seed}".encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("k", [0, 1, 350, 12000, 30000, 40000])
def test_holdout_has_one_path_and_matches_brute_force(spark, k):
    df = spark.range(30000).select(F.col("id").alias("doc_id"))
    got = {r["doc_id"] for r in S.holdout(df, "doc_id", k).where("split = 'validation'").collect()}
    assert got == set(sorted(range(30000), key=lambda i: (_hash(i, "holdout"), i))[:k])


def test_key_hash_takes_any_key(spark):
    keys = [0, 1, 77, 65_535, 65_536, 3_470_000_000, 4_000_000_000, 1 << 41, (1 << 62) + 5, -3]
    got = spark.createDataFrame([(k,) for k in keys], "id long").select("id", S.key_hash("id", "split", 2).alias("h")).collect()
    assert {r["id"]: r["h"] for r in got} == {k: _hash(k, "split", 2) for k in keys}


def test_epoch_batches_are_full_and_reshuffled(spark):
    df = spark.range(1 << 41, (1 << 41) + 1000).select(F.col("id").alias("k"))
    rows = S.epoch_batches(df, "k", 32, epochs=2).collect()
    order = []
    for e in range(2):
        batches = {}
        for r in rows:
            if r["epoch"] == e:
                batches.setdefault(r["batch_id"], []).append(r["k"])
        assert [len(batches[b]) for b in range(32)] == [32] * 31 + [8]
        ranked = sorted(range(1 << 41, (1 << 41) + 1000), key=lambda i: _hash(i, "batch", e))
        assert [sorted(batches[b]) for b in range(32)] == [sorted(ranked[32 * b:32 * b + 32]) for b in range(32)]
        order.append(ranked)
    at = order[1].index(order[0][0])
    assert order[1][at:] + order[1][:at] != order[0]        # not a rotation


def test_every_box_is_a_line_and_records_stay_small(spark, tmpdir_path):
    from lodestar.plans import dataset_queries as D
    folder = os.path.join(tmpdir_path, "boxes-in")
    # One hot order with repeated rows, one small order.
    lines = [(1, i % 7, float(i % 3), 0.1 * (i % 5), float(i), 10.0 * i, "A" if i == 3 else "N", "F") for i in range(101)]
    lines += [(1, 0, 0.0, 0.0, 0.0, 0.0, "N", "O")] * 3 + [(2, 1, 0.5, 0.25, 3.0, 30.0, "N", "O")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_discount double, l_tax double, l_quantity double, "
                          "l_extendedprice double, l_returnflag string, l_linestatus string") \
        .write.parquet(os.path.join(folder, "lineitem.parquet"))
    from collections import Counter
    rec = D.box_records(spark, folder)
    assert rec.agg(F.max(F.size("ymin"))).first()[0] == D.BOX_CHUNK
    import numpy as np
    f = lambda x: float(np.float32(x))
    want = Counter((k, f(d), f(t), f(q), f(p), n) for k, n, d, t, q, p, *_ in lines)
    got = Counter((r["l_orderkey"], r["ymin"], r["xmin"], r["ymax"], r["xmax"], r["object_label"])
                  for r in D.src_boxes(spark, folder).collect())
    assert got == want


def test_unlisted_event_types_are_read(spark, tmpdir_path):
    from datetime import datetime
    from lodestar.plans import edge_queries as E
    folder = os.path.join(tmpdir_path, "events-in")
    rows = [(i, datetime(2024, 1, 1, 0, i), i, t) for i, t in enumerate(["view", "hover", None, "click", "view"])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string") \
        .write.parquet(os.path.join(folder, "events.parquet"))
    got = {r["value"] for r in E.src_multi_file(spark, folder).collect()}
    assert got == {"0\t1  ", "1\t2", "2\tCategory:3", "Category:3\t4"}
