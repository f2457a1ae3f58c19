"""Data-set preparation: labels, synsets, splits, shards, records.

* class names: ``documents.source``;
* synsets: nation keys as ``n%08d`` in key order (file order matters), names
  from ``n_name``; the name file is a superset (regions as ``r%08d``);
* flower-style records: ``documents ⟕ labels`` (missing labels → defaults),
  hold-out of 350 by the key hash, 5 shards per split;
* box records: ``lineitem`` grouped per order in chunks of a few lines
  (by position in the order) into four coordinate arrays.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import labels as L
from ..operators import splits as S
from ..operators.joins import lookup
from ..session import scratch_path
from ..sources import examples as X
from ..sources.tables import table
from ..sources.text import read_lines
from .registry import query

N_VALIDATION = 350
NUM_SHARDS = 5
BOX_CHUNK = 4            # boxes of a record
BOX_VALIDATION = S.HASH_RANGE // 10
BOX_LINE = ["l_linenumber", "l_discount", "l_tax", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
HASH_SQL = "CAST('0x' || substr(md5({c} || ':0:{seed}'), 1, 15) AS BIGINT)"


# ------------------------------------------------------------ class names
def class_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.index_sorted_names(table(spark, sf_dir, "documents").select(F.col("source").alias("name")))


LABEL_INDEX_SQL = """SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER) AS label, name
FROM (SELECT DISTINCT source AS name FROM documents WHERE source IS NOT NULL)"""


@query("label_index", oracle=LABEL_INDEX_SQL)
def label_index(spark, sf_dir):
    """SRT-3: sorted class names numbered from 0."""
    return class_index(spark, sf_dir)


@query("label_lookup", oracle=f"""SELECT d.doc_id, d.source, l.label FROM documents d
JOIN ({LABEL_INDEX_SQL}) l ON d.source = l.name""")
def label_lookup(spark, sf_dir):
    """JN-3: class name → id for every document (size-checked broadcast of the map)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    matched, _ = L.lookup_labels(docs, class_index(spark, sf_dir), "source")
    return matched.select("doc_id", "source", "label")


@query("label_unmatched", oracle="""SELECT doc_id, source FROM documents
WHERE source IS NULL OR source = (SELECT max(source) FROM documents)""")
def label_unmatched(spark, sf_dir):
    """JN-3: names missing from the map are reported (the source raised); the map here lacks the last class."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    classes = class_index(spark, sf_dir)
    last = classes.agg(F.max("label")).first()[0]
    _, missing = L.lookup_labels(docs, classes.where(F.col("label") < last), "source")
    return missing


def written_label_file(spark: SparkSession, sf_dir: str) -> str:
    return L.write_label_file(class_index(spark, sf_dir), scratch_path(spark, "labels-txt"))


@query("snk_label_map", oracle=f"SELECT label || ':' || name AS value FROM ({LABEL_INDEX_SQL})")
def snk_label_map(spark, sf_dir):
    """SNK-6: ``%d:%s`` label file, read back as lines."""
    return read_lines(spark, written_label_file(spark, sf_dir))


@query("src_label_map", oracle=LABEL_INDEX_SQL)
def src_label_map(spark, sf_dir):
    """SRC-10: label file parsed at the first ``:`` (round trip of SNK-6)."""
    lm, _ = L.read_label_file(spark, written_label_file(spark, sf_dir))
    return lm


# ---------------------------------------------------------------- synsets
def write_synset_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """synsets.txt (nation ids in key order) and names.tsv (nations + regions)."""
    base = scratch_path(spark, "synsets")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    sid = F.format_string("n%08d", "n_nationkey")
    nation.orderBy("n_nationkey").select(sid.alias("value")).write.text(os.path.join(base, "synsets"))
    names = (nation.select(sid.alias("synset"), F.col("n_name").alias("name"))
             .unionByName(region.select(F.format_string("r%08d", "r_regionkey").alias("synset"),
                                        F.col("r_name").alias("name"))))
    names.select(F.concat_ws("\t", "synset", "name").alias("value")).write.text(os.path.join(base, "names"))
    return os.path.join(base, "synsets"), os.path.join(base, "names")


SYNSET_SQL = "SELECT printf('n%08d', n_nationkey) AS synset, n_nationkey AS k, n_name AS name FROM nation"


@query("synset_ids", oracle=f"""SELECT 0 AS label, 'background' AS name
UNION ALL SELECT CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS label, name FROM ({SYNSET_SQL})""")
def synset_ids(spark, sf_dir):
    """SRT-3 (file order) + JN-4 + SET-3: synsets numbered from 1 as listed,
    mapped to their readable names, ``0 = background`` in front."""
    syn, names = write_synset_files(spark, sf_dir)
    ids = L.number_in_file_order(spark, syn, start=1)
    named = lookup(ids, L.read_tsv_pairs(spark, names), "synset")   # size-checked broadcast
    return L.with_background(named.select("label", "name"))


@query("synset_join", oracle=f"SELECT synset, name FROM ({SYNSET_SQL})")
def synset_join(spark, sf_dir):
    """JN-4: synset ids looked up in the (larger) names table."""
    syn, names = write_synset_files(spark, sf_dir)
    ids = read_lines(spark, syn).select(F.col("value").alias("synset"))
    return lookup(ids, L.read_tsv_pairs(spark, names), "synset")


@query("src_tsv_counts", oracle="""SELECT 'synsets' AS what, count(*) AS rows, count(*) AS expected, true AS ok FROM nation
UNION ALL SELECT 'names', (SELECT count(*) FROM nation) + (SELECT count(*) FROM region),
  (SELECT count(*) FROM nation) + (SELECT count(*) FROM region), true""")
def src_tsv_counts(spark, sf_dir):
    """SRC-11: two-column TSV scan with the line-count checks as data."""
    syn, names = write_synset_files(spark, sf_dir)
    n_nation = table(spark, sf_dir, "nation").count()
    n_region = table(spark, sf_dir, "region").count()
    return L.count_check(read_lines(spark, syn), n_nation, "synsets").unionByName(
        L.count_check(L.read_tsv_pairs(spark, names), n_nation + n_region, "names"))


# ------------------------------------------------------- flower records
def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rec = d.join(lab, "doc_id", "left").select(
        "doc_id", F.md5("text").alias("encoded"),
        F.when(F.col("toxic") == 1, F.lit("jpeg")).alias("format"),
        F.col("quality").cast("long").alias("label"),
        F.col("n_chars").alias("height"), F.col("toxic").cast("long").alias("width"))
    return S.holdout(rec, "doc_id", N_VALIDATION)


def written_records(spark: SparkSession, sf_dir: str) -> str:
    rec = _sharded(spark, sf_dir)
    path = scratch_path(spark, "records")
    S.write_shards_once(rec, path, list(X.FLOWER_SPLITS), NUM_SHARDS)
    return path


def _sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = document_records(spark, sf_dir).withColumn("_h", S.key_hash("doc_id", "holdout"))
    sh = S.assign_shards(rec, "split", "_h", NUM_SHARDS).drop("_h")
    return sh.withColumn("shard_name", S.shard_name("flowers", F.col("split"), F.col("shard"), NUM_SHARDS))


HOLDOUT_SQL = f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {HASH_SQL.format(c='doc_id', seed='holdout')}) <= {N_VALIDATION}
  THEN 'validation' ELSE 'train' END AS split, {HASH_SQL.format(c='doc_id', seed='holdout')} AS h FROM documents"""

SHARD_SQL = f"""SELECT doc_id, split,
  CAST(floor((row_number() OVER (PARTITION BY split ORDER BY h) - 1)
             / CAST(ceil(count(*) OVER (PARTITION BY split) / {NUM_SHARDS}) AS BIGINT)) AS INTEGER) AS shard
FROM ({HOLDOUT_SQL})"""


@query("holdout_split", oracle=f"SELECT doc_id, split FROM ({HOLDOUT_SQL})")
def holdout_split(spark, sf_dir):
    """SRT-4 / SET-4: 350 validation rows by seeded key hash, the rest train."""
    return document_records(spark, sf_dir).select("doc_id", "split")


@query("snk_shards", oracle=f"""SELECT doc_id, split, shard,
  printf('flowers_%s_%05d-of-%05d', split, shard, {NUM_SHARDS}) AS shard_name FROM ({SHARD_SQL})""")
def snk_shards(spark, sf_dir):
    """SNK-4: 5 contiguous shards per split, written per (split, shard), read back."""
    return spark.read.parquet(written_records(spark, sf_dir)).select("doc_id", "split", "shard", "shard_name")


@query("split_counts", oracle=f"""SELECT split, count(*) AS examples, count(l.doc_id) AS labelled
FROM ({HOLDOUT_SQL}) h LEFT JOIN labels l USING (doc_id) GROUP BY split""")
def split_counts(spark, sf_dir):
    """AGG-12: rows per split and how many carry a label."""
    rec = spark.read.parquet(written_records(spark, sf_dir))
    return rec.groupBy("split").agg(F.count(F.lit(1)).alias("examples"),
                                    F.count("label").alias("labelled"))


@query("src_split_defaults", oracle=f"""SELECT d.doc_id, h.split, md5(d.text) AS encoded,
  coalesce(CASE WHEN l.toxic = 1 THEN 'jpeg' END, 'png') AS format,
  coalesce(CAST(l.quality AS BIGINT), 0) AS label, d.n_chars AS height, CAST(l.toxic AS BIGINT) AS width
FROM documents d LEFT JOIN labels l USING (doc_id) JOIN ({HOLDOUT_SQL}) h USING (doc_id)""")
def src_split_defaults(spark, sf_dir):
    """SRC-8: each split read by name with ``'' / 'png' / 0`` defaults for missing fields."""
    path = written_records(spark, sf_dir)
    out = None
    for split in X.FLOWER_SPLITS:
        rec = X.get_split(spark, path, split).select(
            "doc_id", "split", "encoded", "format", "label", "height", "width")
        out = rec if out is None else out.unionByName(rec)
    return out


# ---------------------------------------------------------- box records
def box_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order in a fixed total order, ``BOX_CHUNK`` of them to a record: no group
    grows with an order, and the i-th entries of all arrays come from the same line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *BOX_LINE)
    placed = S.position_in_group(li, "l_orderkey", BOX_LINE)
    line = F.struct("pos", F.col("l_discount").cast("float").alias("ymin"), F.col("l_tax").cast("float").alias("xmin"),
                    F.col("l_quantity").cast("float").alias("ymax"), F.col("l_extendedprice").cast("float").alias("xmax"),
                    F.col("l_linenumber").cast("long").alias("object_label"))
    chunk = F.floor(F.col("pos") / BOX_CHUNK).cast("int")
    rec = placed.groupBy("l_orderkey", chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(line)).alias("lines"),
        F.max(F.when(F.col("l_returnflag") == "A", F.lit("returned"))).alias("text"),
        F.max(F.when(F.col("l_linestatus") == "F", F.lit(1))).cast("long").alias("label"))
    split = F.when(S.key_hash("l_orderkey", "boxes") < F.lit(BOX_VALIDATION), "validation").otherwise("train")
    return rec.select("l_orderkey", "chunk", *[F.col(f"lines.{c}").alias(c) for c in (*X.BOX_ORDER, "object_label")],
                      "text", "label", F.lit(None).cast("string").alias("format"),
                      F.lit(None).cast("string").alias("encoded"), split.alias("split"))


@query("src_boxes", oracle=f"""WITH p AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(c + ' NULLS FIRST' for c in BOX_LINE)}) - 1 AS pos FROM lineitem)
SELECT l_orderkey, CAST(pos // {BOX_CHUNK} AS INTEGER) AS chunk,
  CASE WHEN {HASH_SQL.format(c='l_orderkey', seed='boxes')} < {BOX_VALIDATION} THEN 'validation' ELSE 'train' END AS split,
  coalesce(max(CASE WHEN l_returnflag = 'A' THEN 'returned' END) OVER w, '') AS text, 'jpeg' AS format,
  coalesce(CAST(max(CASE WHEN l_linestatus = 'F' THEN 1 END) OVER w AS BIGINT), -1) AS label,
  CAST(pos % {BOX_CHUNK} AS INTEGER) AS box, CAST(l_discount AS FLOAT) AS ymin, CAST(l_tax AS FLOAT) AS xmin,
  CAST(l_quantity AS FLOAT) AS ymax, CAST(l_extendedprice AS FLOAT) AS xmax, CAST(l_linenumber AS BIGINT) AS object_label
FROM p WINDOW w AS (PARTITION BY l_orderkey, pos // {BOX_CHUNK})""")
def src_boxes(spark, sf_dir):
    """SRC-9: box records of every split with defaults, one row per box."""
    path = scratch_path(spark, "boxes")
    box_records(spark, sf_dir).write.partitionBy("split").parquet(path)
    out = None
    for split in ("train", "validation"):
        b = X.boxes(X.get_box_split(spark, path, split), ["l_orderkey", "chunk", "split"])
        out = b if out is None else out.unionByName(b)
    return out


# ------------------------------------------------------------ epochs
BATCH_NUM, BATCH_SIZE = 10, 128


@query("src_epochs", oracle=f"""WITH H AS ({HOLDOUT_SQL}),
T AS (SELECT doc_id FROM H WHERE split = 'train'),
E AS (SELECT ({BATCH_NUM} * {BATCH_SIZE} + count(*) - 1) // count(*) AS epochs FROM T)
SELECT doc_id, CAST(unnest(range(1, (SELECT epochs FROM E) + 1)) AS INTEGER) AS epoch FROM T""")
def src_epochs(spark, sf_dir):
    """SRC-13: train examples repeated for ``ceil(batch_num · batch_size / n)``
    epochs (``explode(sequence(1, epochs))``); evaluation reads once."""
    train = document_records(spark, sf_dir).where(F.col("split") == "train").select("doc_id")
    n = train.count()
    epochs = -(-BATCH_NUM * BATCH_SIZE // n) if n else 0      # SCL-14 ceil division
    if epochs == 0:
        return train.select("doc_id", F.lit(1).alias("epoch")).limit(0)
    return train.select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"))
