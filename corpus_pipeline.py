"""A corpus pipeline over ``documents``: drop toxic texts, drop junk, keep one of each group of near copies, select the
target mix of sources, encode.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and is written as Parquet before the next one reads it; all but the last
return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import jaccard_join, quality_rules, sentence_pieces, source_mix, toxicity as toxic
from lodestar.session import bound_arrow_batches, scratch_path
from lodestar.sources.tables import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the counterfactual-regularised classifier predicts to be toxic."""
    bound_arrow_batches(spark)   # whole rows go through Python from here on
    return toxic.drop_toxic(docs, toxic.fit(docs, table(spark, sf_dir, "labels")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or stray from the references of their language."""
    bound_arrow_batches(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each component of the n-gram Jaccard join."""
    return jaccard_join.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Select documents up to the token budgets of the domain, language and source tree."""
    return source_mix.select_mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document by piece_bpe_32k.model, with digests of the ids and of the decoded text."""
    import public_tokenizers
    bound_arrow_batches(spark)
    return sentence_pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True).drop("decoded")


STAGES = [("toxicity", toxicity), ("quality_rules", quality), ("jaccard_join", near_duplicates), ("source_mix", mixing),
          ("sentence_pieces", encoding)]

# Trained weights, distances and tokenizer ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
