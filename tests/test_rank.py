from __future__ import annotations

import re
import time

import pytest

from lodestar.operators import joins as J
from lodestar.operators import rank as R
from lodestar.session import SHUFFLE_CLEANUP


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def as_dict(df):
    return {r["id"]: round(r["rank"], 10) for r in df.collect()}


def test_two_cycle_plus_feeder_round_1_and_2(spark):
    e = edges(spark, [("a", "b"), ("b", "a"), ("c", "a")])
    assert as_dict(R.rank(e, rounds=1)) == {"a": 1.85, "b": 1.0}
    assert as_dict(R.rank(e, rounds=2)) == {"a": 1.0, "b": round(0.15 + 0.85 * 1.85, 10)}


def test_chain_empties_after_three_rounds(spark):
    e = edges(spark, [("a", "b"), ("b", "c")])
    assert as_dict(R.rank(e, rounds=1)) == {"b": 1.0, "c": 1.0}
    assert as_dict(R.rank(e, rounds=2)) == {"c": 1.0}
    assert as_dict(R.rank(e, rounds=3)) == {}


def test_duplicates_count_once_and_self_loop_counts(spark):
    e = edges(spark, [("a", "a"), ("a", "b"), ("a", "b"), ("b", "a")])
    deg = {r["src"]: r["out_degree"] for r in R.out_degree(R.dedupe_edges(e)).collect()}
    assert deg == {"a": 2, "b": 1}
    got = as_dict(R.rank(e, rounds=1))
    assert got == {"a": round(0.15 + 0.85 * (0.5 + 1.0), 10), "b": round(0.15 + 0.85 * 0.5, 10)}


@pytest.mark.parametrize("kw", [
    dict(cache=False),
    dict(cache=False, partitions=3),
    dict(cache=True, partitions=5, checkpoint_every=1),
    dict(checkpoint_every=None),
    dict(hot_split=1),
    dict(hot_split=2, max_hot=3),
    dict(encode_ids=True),
    dict(encode_ids=True, hot_split=2, cache=False),
])
def test_placement_does_not_change_result(spark, kw):
    pairs = [(f"n{i}", f"n{(i * 7 + 3) % 23}") for i in range(40)] + \
            [("hub", f"n{i}") for i in range(23)] + [(f"n{i}", "hub") for i in range(0, 23, 2)]
    e = edges(spark, pairs)
    base = as_dict(R.rank(e, rounds=6))
    assert base
    assert as_dict(R.rank(e, rounds=6, **kw)) == base


def test_hot_split_is_bounded(spark):
    pairs = [("hub", f"t{i}") for i in range(50)] + [(f"t{i}", "hub") for i in range(50)]
    e = edges(spark, pairs)
    prep = R.prepare_links(e, hot_split=4, max_hot=1000, cache=False)
    salts = prep.links.where("src = 'hub'").select("salt").distinct().count()
    assert salts > 1
    # the hot table may never exceed max_hot rows: with max_hot=1 the split grows
    prep2 = R.prepare_links(e, hot_split=1, max_hot=1, cache=False)
    assert prep2.hot_split >= 100


def test_sum_of_ranks_on_cycle_is_node_count(spark):
    e = edges(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")])
    got = R.rank(e, rounds=10)
    assert abs(sum(as_dict(got).values()) - 3.0) < 1e-9


def test_top_ranks_line(spark):
    e = edges(spark, [("a", "b"), ("b", "a"), ("c", "a")])
    rows = R.top_ranks(R.rank(e, rounds=1), 1).collect()
    assert rows[0]["id"] == "a" and rows[0]["line"] == "a has rank: 1.850000"


def test_long_names_are_encoded_automatically(spark):
    base = [("a", "b"), ("b", "a"), ("c", "a"), ("a", "c")]
    long = [(f"https://example.org/page/{s}" * 2, f"https://example.org/page/{d}" * 2) for s, d in base]
    prep = R.prepare_links(edges(spark, long), cache=False)
    assert prep.names is not None                      # mean name length >= 16
    short = R.prepare_links(edges(spark, base), cache=False)
    assert short.names is None
    got = {k[len("https://example.org/page/"):][0]: v for k, v in as_dict(R.rank(edges(spark, long), rounds=3)).items()}
    assert got == as_dict(R.rank(edges(spark, base), rounds=3))


def test_adjacency_splits_large_lists_without_losing_targets(spark):
    pairs = [("hub", f"t{i:02d}") for i in range(25)] + [("x", "hub")]
    rows = R.adjacency(edges(spark, pairs), max_list=10).collect()
    hub = [r for r in rows if r["src"] == "hub"]
    assert all(r["n_parts"] == 3 for r in hub) and 1 <= len(hub) <= 3
    got = sorted(t for r in hub for t in r["targets"])
    assert got == sorted(f"t{i:02d}" for i in range(25))
    assert all(list(r["targets"]) == sorted(r["targets"]) for r in hub)
    assert [list(r["targets"]) for r in rows if r["src"] == "x"] == [["hub"]]


def test_heavy_hitters_and_spread_joins(spark):
    rows = [("hub" if i % 3 == 0 else None if i % 50 == 1 else f"n{i % 40}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(4)
    assert J.heavy_hitters(df, "k", 3000, least=900) == ["hub"] and J.heavy_hitters(df, "k", 3000) == []
    table = spark.createDataFrame([(f"n{i}", i) for i in range(20)] + [("hub", -1)], "k string, w long")
    for how in ("left", "inner"):
        want = sorted(map(str, df.join(table, "k", how).collect()))
        for hot in (["hub"], ["hub", "n3", "n39", "absent"]):
            assert sorted(map(str, J.join_spread(df, table, "k", how, hot).collect())) == want
    plan = J.join_spread(df, table, "k", "left", ["hub"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 1 and "LeftAnti" in plan


@pytest.mark.parametrize("encode_ids", [False, True])
def test_hot_targets_join_apart_with_the_same_ranks(spark, encode_ids):
    pairs = [(f"n{i}", "hub") for i in range(200)] + [(f"n{i}", f"n{(i * 7 + 3) % 200}") for i in range(200)] + [("hub", "n1")]
    e = edges(spark, pairs)
    plain, split = (R.prepare_links(e, cache=False, encode_ids=encode_ids, hot_rows=h) for h in (10**9, 20))
    assert "LeftAnti" in split.links._jdf.queryExecution().optimizedPlan().toString()
    a, b = (as_dict(R.decode_ids(p, R.rank_round(p, R.initial_ranks(p)))) for p in (plain, split))
    assert a == b and len(a) > 100


def test_edges_of_wide_sources_meet_at_their_target(spark):
    pairs = [(f"s{i}", f"c{j}") for i in range(12) for j in range(90) if (i + j) % 3]
    e = edges(spark, pairs + [(b, a) for a, b in pairs])
    before = spark.conf.get(R.SUBSET_KEYS)
    prep = R.prepare_links(e, dedupe=False, partitions=6)
    to_c = prep.links.where("src like 's%'").groupBy("dst").agg({"src_salt": "min", "src_salt": "max"})
    assert to_c.count() == 90
    spread = prep.links.where("src like 's%'").select("dst", "src_salt").distinct().count()
    assert spread == 90                                 # all edges of a customer from the suppliers lie in one bucket
    back = prep.links.where("src like 'c%'").select("src", "src_salt").distinct().count()
    assert back == 90                                   # a narrow source lies in one bucket
    # A round sums per bucket before the shuffle: one row per customer, six per supplier at most.
    got = as_dict(R.rank_round(prep, R.initial_ranks(prep)))
    prep.release()
    assert spark.conf.get(R.SUBSET_KEYS) == before
    deg = {}
    for a, b in pairs + [(b, a) for a, b in pairs]:
        deg[a] = deg.get(a, 0) + 1
    want = {}
    for a, b in pairs + [(b, a) for a, b in pairs]:
        want[b] = want.get(b, 0.0) + 1.0 / deg[a]
    assert got == {k: round(v * 0.85 + 0.15, 10) for k, v in want.items()}


def test_large_buckets_are_written_by_several_tasks(spark, monkeypatch):
    from lodestar.sinks import tables as T
    monkeypatch.setattr(T, "ROWS_PER_WRITE", 50)
    rows = spark.range(400).selectExpr("cast(id % 2 as int) AS b", "id")
    df, name, path = T.write_bucketed(rows, 2, ["b"], "t", 400, "id")
    assert df.count() == 400 and len(df.inputFiles()) > 4
    T.drop_table(spark, name, path)


def test_pairs_and_edges_are_dealt_out_by_rows(spark, monkeypatch, tmpdir_path):
    from lodestar.plans import graphs as G, rank_queries as Q
    spark.range(300).selectExpr("id % 60 AS l_orderkey", "id % 7 AS l_suppkey").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    spark.range(60).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey").write.parquet(f"{tmpdir_path}/orders.parquet")
    monkeypatch.setattr(G, "ROWS_PER_TASK", 20)
    df = Q.edges_distinct(spark, tmpdir_path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 3 and ", 30)" in plan       # 600 edges, 20 to a task
    assert df.count() == df.distinct().count() > 0


def shuffles_on_disk(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return set(re.findall(r"shuffle_(\d+)_\d+_\d+\.data", files))


def test_rounds_without_cached_links_leave_no_shuffle_files(spark):
    own = spark.conf.get(SHUFFLE_CLEANUP)
    e = edges(spark, [(f"n{i}", f"n{(i * k + 3) % 60}") for i in range(60) for k in (3, 7, 11)])
    before = shuffles_on_disk(spark)
    ranks = R.rank(e, rounds=8, cache=False)
    for _ in range(50):                                 # executors delete in the background
        if len(left := shuffles_on_disk(spark) - before) < 8:
            break
        time.sleep(0.2)
    assert len(left) < 8                                # those of the degrees, not some of each round
    assert spark.conf.get(SHUFFLE_CLEANUP) == own
    assert as_dict(ranks) == as_dict(R.rank(e, rounds=8))


def test_links_derived_each_round_move_once(spark):
    pairs = [(f"s{i}", f"c{j}") for i in range(12) for j in range(30) if (i + j) % 3]
    e = edges(spark, pairs + [(b, a) for a, b in pairs] + [("s1", None), (None, "c1"), ("c2", "end")])
    ranks = []
    for carry in (True, False):
        prep = R.prepare_links(e, partitions=4, cache=False, hot_split=5, encode_ids=False, carry=carry)
        assert ("dst_degree" in prep.links.columns) == carry and (prep.targets is None) == carry
        one = R.rank_round(prep, R.initial_ranks(prep)).checkpoint()
        two = R.rank_round(prep, one)
        ranks.append([{r["id"]: (round(r["rank"], 10), r["out_degree"], r["n_salts"]) for r in df.collect()} for df in (one, two)])
        prep.release()
    assert ranks[0] == ranks[1] and ranks[0][0]["end"][1:] == (None, None) and None in ranks[0][0]
