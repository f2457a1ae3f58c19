"""Operator 1, token counts: a map-side lookup in two tiers, without a shuffle of pre-tokens.

Tier one is a broadcast table of the lengths of frequent pre-tokens; tier two a cache in each worker,
filled by encoding what tier one does not hold.  The first pass that finds the frequent pre-tokens reads
all texts: each task keeps the ``PER_TASK`` most frequent of its own part (a bounded summary), the
summaries are added up, and the ``TABLE_SIZE`` largest sums make the table.  The table decides only where a
length is found, never what it is, so the counts are the library's whatever the summaries hold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .arrow_text import PieceCache, distinct, slices, strings, texts_of
from .public_bpe import _split, count_ids, encode_lengths, held
from .registry import query

TABLE_SIZE = 32_768      # entries of the broadcast table
PER_TASK = 2_048         # pre-tokens that a task's summary reports
HELD_BY_TASK = 200_000   # pre-tokens that a task counts at once
LONGEST = 64             # characters of a pre-token in the table or a cache
TOKENS_LIMIT = 512


def frequent_pieces(docs: DataFrame, path: str, text: str = "text", size: int = TABLE_SIZE) -> list[str]:
    """The (about) ``size`` most frequent pre-tokens of all texts; at most ``size`` strings reach the driver."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often: Counter[str] = Counter()
        for batch in batches:
            for _, texts in slices(texts_of(batch.column(0)), 8 << 20):
                _, flat = _split(texts, path)
                pieces, index = distinct(flat)
                n = np.bincount(index, minlength=len(pieces))
                again = np.flatnonzero(n > 1)
                for piece, count in zip(strings(pieces.take(pa.array(again))), n[again].tolist()):
                    if len(piece) <= LONGEST:
                        often[piece] += count
                if len(often) > HELD_BY_TASK:
                    often = Counter(dict(often.most_common(HELD_BY_TASK // 4)))
        top = often.most_common(PER_TASK)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    rows = (docs.select(F.col(text)).mapInArrow(summary, "piece string, n long")
            .groupBy("piece").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "piece").limit(size).collect())
    return [r["piece"] for r in rows]


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 table_size: int = TABLE_SIZE) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row's whole text, counted as the library counts.

    Null texts count as empty: 0 bytes, 0 tokens.  Repeated rows and null ids stay rows of their own; other columns
    of ``docs`` are not read.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    pieces = frequent_pieces(docs, path, text, table_size)
    fixed = spark.sparkContext.broadcast(dict(zip(pieces, encode_lengths(path, pieces))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = PieceCache(lambda xs: encode_lengths(path, xs), held(path, "lengths"), longest=LONGEST, fixed=fixed.value)
        for batch in batches:
            texts = texts_of(batch.column(1))
            n = [count_ids(part, path, cache) for _, part in slices(texts, 8 << 20)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()),
                 pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by byte_bpe_50k.json."""
    import public_tokenizers
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKENS_LIMIT)
