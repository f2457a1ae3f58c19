"""Physical-plan properties the design relies on (checked with explain output)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF001
from lodestar.operators import rank as R
from lodestar.plans.graphs import supply_edges
from lodestar.sources import examples as X


def plan(df, mode: str = "formatted") -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_rank_round_never_shuffles_the_links(spark):
    e = supply_edges(spark, SF001)
    prep = R.prepare_links(e, dedupe=False, partitions=8)
    txt = plan(R.rank_round(prep, R.initial_ranks(prep)), "simple")
    exchanges = [ln.strip(" :+-") for ln in txt.splitlines() if "Exchange" in ln]
    # one exchange for the node-sized shares (to the links' bucketing), one for the sum
    assert len(exchanges) == 2, txt
    assert any(x.startswith("Exchange hashpartitioning(src") and "salt" in x for x in exchanges), txt
    assert any(x.startswith("Exchange hashpartitioning(dst") for x in exchanges), txt
    scan = [ln for ln in txt.splitlines() if "lodestar_links" in ln]
    assert scan and "Bucketed: true" in scan[0], txt
    prep.release()


def test_supply_edges_scan_only_key_columns(spark):
    txt = plan(supply_edges(spark, SF001))
    read = [ln for ln in txt.splitlines() if ln.startswith("ReadSchema")]
    assert "struct<l_orderkey:bigint,l_suppkey:bigint>" in "\n".join(read)
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in "\n".join(read)


def test_split_reader_prunes_partitions(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "rec")
    spark.range(10).select(F.col("id").alias("doc_id"), F.lit("x").alias("encoded"),
                           F.lit(None).cast("string").alias("format"), F.lit(None).cast("long").alias("label"),
                           F.when(F.col("id") < 3, "validation").otherwise("train").alias("split")) \
        .write.partitionBy("split").parquet(path)
    df = X.get_split(spark, path, "validation")
    assert "PartitionFilters: [isnotnull(split" in plan(df)
    assert df.count() == 3


def test_top_k_is_take_ordered(spark):
    ranks = spark.createDataFrame([(f"n{i}", float(i)) for i in range(50)], "id string, rank double")
    assert "TakeOrderedAndProject" in plan(R.top_ranks(ranks, 5))
