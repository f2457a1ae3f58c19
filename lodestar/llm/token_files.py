"""Operator 5, token-id files: a static range asymmetric numeral system (``rans``) over whole documents.

1. Every text is encoded once; its ids go, as 16- or 32-bit integers packed with zstd, to the part of its id
   (``order_parts``) and are written there in ascending id order.
2. The frequencies of all ids make one shared table (at most the vocabulary's size).
3. Each part is cut into blocks of whole documents, each coded independently with checkpoints and a checksum, and
   written as rows of a Parquet folder, beside the folder of the table.
4. Reading decodes the blocks in parallel; a document's start is the total of the parts before its part (one number
   a part), of the blocks before its block in the part, and of the documents before it in the block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import table
from . import rans
from .arrow_text import PieceCache, slices, texts_of
from .order_parts import LEAST, order_key, parts_of
from .public_bpe import encode_pieces, held as held_ids, ids_of
from .registry import query

BLOCK_IDS = 1 << 19   # a block is closed by the document that brings it to so many ids

HOT_PARTS = 64        # parts of an id that holds more rows than a shuffle partition's share

BLOCK_SCHEMA = ("part int, first_key long, uid long, n_ids long, keys array<long>, lens array<long>, payload binary")


@lru_cache(maxsize=1)
def _zstd():
    import zstandard
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(ids: np.ndarray) -> bytes:
    small = len(ids) == 0 or int(ids.max()) < 1 << 16
    raw = ids.astype("<u2" if small else "<u4").tobytes()
    return (b"2" if small else b"4") + _zstd()[0].compress(raw)


def _unpack(data: bytes) -> np.ndarray:
    raw = _zstd()[1].decompress(data[1:])
    return np.frombuffer(raw, "<u2" if data[:1] == b"2" else "<u4")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None,
                      doc_id: str = "doc_id", text: str = "text") -> str:
    """Write ``path/table`` (id, frequency count) and ``path/blocks`` (``BLOCK_SCHEMA``); return ``path``.

    Null texts are empty (only the end id); null ids come first; rows with the same id stay rows of their own, in the
    order of their ids' bytes (an id of very many rows is dealt out to ``HOT_PARTS`` parts by a hash of the text, which come one after another);
    an empty table writes no blocks.  Other columns are not read.
    """
    spark = docs.sparkSession
    parts = parts_of(docs, doc_id).with_hot_apart()
    known = spark.sparkContext.broadcast(parts)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = PieceCache(lambda xs: encode_pieces(tokenizer, xs), held_ids(tokenizer, "ids"))
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            part = (known.value.of(keys) * HOT_PARTS).astype(np.int32)
            hot = np.isin(keys, known.value.hot)
            for at, texts in slices(texts_of(batch.column(1)), 8 << 20):
                for i in np.flatnonzero(hot[at:at + len(texts)]).tolist():
                    part[at + i] += zlib.crc32(texts[i].as_py().encode("utf-8", "surrogatepass")) % HOT_PARTS
                n, ids = ids_of(texts, tokenizer, cache)
                ends = np.cumsum(n)
                packed = [_pack(np.concatenate([ids[e - k:e], end])) for e, k in zip(ends.tolist(), n.tolist())]
                to = at + len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(part[at:to]), pa.array(keys[at:to]), pa.array(packed, pa.binary())],
                                                 ["part", "key", "ids"])

    ids_path = scratch_path(spark, "token-ids")
    (docs.select(order_key(doc_id).alias("key"), F.col(text).cast("string"))
     .mapInArrow(tokens, "part int, key long, ids binary")
     .repartition("part").sortWithinPartitions("part", "key", "ids")
     .write.option("compression", "none").parquet(ids_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1, np.int64)
        for batch in batches:
            for data in batch.column(0):
                own = np.bincount(_unpack(data.as_py()))
                if len(own) > len(n):
                    n = np.pad(n, (0, len(own) - len(n)))
                n[:len(own)] += own
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["id", "n"])

    counts = (spark.read.parquet(ids_path).select("ids").mapInArrow(count, "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")))
    counts.write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(read_table(spark, path))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, made = TaskContext.get().partitionId(), 0
        keys, held, size, of_part = [], [], 0, -1

        def close() -> pa.RecordBatch:
            row = [of_part, keys[0], (task << 32) | made, size, keys, [len(x) for x in held],
                   rans.encode(np.concatenate(held).astype(np.int64), shared.value)]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              ["part", "first_key", "uid", "n_ids", "keys", "lens", "payload"])

        for batch in batches:
            for part, key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if keys and (part != of_part or key < keys[-1] or size >= BLOCK_IDS):
                    yield close()
                    made, keys, held, size = made + 1, [], [], 0
                own = _unpack(data.as_py())
                of_part, size = part, size + len(own)
                keys.append(key)
                held.append(own)
        if keys:
            yield close()

    (spark.read.parquet(ids_path).select("part", "key", "ids").mapInArrow(blocks, BLOCK_SCHEMA)
     .write.option("compression", "none").parquet(f"{path}/blocks"))
    return path


def read_table(spark: SparkSession, path: str) -> rans.Table:
    """The shared frequency table; at most one row for each id of the vocabulary."""
    rows = spark.read.schema("id long, n long").parquet(f"{path}/table").collect()
    return rans.Table(np.array([r["id"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document in the files."""
    shared = spark.sparkContext.broadcast(read_table(spark, path))
    files = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, keys, lens, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                batch.column(2).to_pylist(), batch.column(3)):
                ids = rans.decode(payload.as_py(), shared.value).astype("<u4")
                ends = np.cumsum(lens)
                own = [ids[e - k:e] for e, k in zip(ends.tolist(), lens)]
                out = [pa.array([uid] * len(keys)), pa.array([None if k == LEAST else k for k in keys], pa.int64()),
                       pa.array(ends - np.array(lens)), pa.array(lens, pa.int64()),
                       pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())]
                names = ["uid", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "uid long, doc_id long, inside long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    docs = files.select("uid", "keys", "lens", "payload").mapInArrow(decode, schema)
    of_part = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()   # one row a part, and parts are bounded
    before, total = [], 0
    for r in sorted(of_part, key=lambda r: r["part"]):
        before.append((r["part"], total))
        total += r["n"]
    offsets = spark.createDataFrame(before, "part int, part_start long")
    in_part = Window.partitionBy("part").orderBy("first_key", "uid")
    starts = (files.select("part", "first_key", "uid", "n_ids")
              .withColumn("part_at", F.sum("n_ids").over(in_part) - F.col("n_ids"))
              .join(F.broadcast(offsets), "part")
              .select("uid", (F.col("part_start") + F.col("part_at")).alias("block_start")))
    return (docs.join(starts, "uid")
            .select("doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
                    *(["ids"] if with_ids else [])))


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written to token-id files and read back."""
    import public_tokenizers
    path = write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"),
                             public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, path)
