from __future__ import annotations

import os

from lodestar.operators.metrics import running_totals
from lodestar.operators.sequence import next_in_order
from lodestar.operators.sorting import positions, positions_in_group, sort_by_keys, with_position
from lodestar.sinks.files import write_csv
from lodestar.sources.csv import read_csv_strings, read_csv_with_header


def test_string_keys_sort_lexically_nulls_first(spark):
    df = spark.createDataFrame([("9", "b"), ("10", "a"), (None, "z"), ("10", "0")], "k1 string, k2 string")
    got = [(r["k1"], r["k2"]) for r in sort_by_keys(df, ["k1", "k2"]).collect()]
    assert got == [(None, "z"), ("10", "0"), ("10", "a"), ("9", "b")]


def test_positions_match_brute_force(spark):
    vals = [(i * 7919 % 1000, f"r{i}") for i in range(1000)]
    df = spark.createDataFrame(vals, "k int, v string").repartition(7)
    pos = with_position(sort_by_keys(df, ["k", "v"])).collect()
    expected = {v: p for p, (k, v) in enumerate(sorted(vals))}
    assert {r["v"]: r["position"] for r in pos} == expected


def test_next_in_order_matches_lead(spark):
    rows = [(i, (i * 37) % 101, (i * 13) % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, u long, t long").repartition(5)
    got = {r["k"]: r["next_u"] for r in next_in_order(df, ["k"], ["u", "t"], partitions=6).collect()}
    srt = sorted(rows)
    exp = {srt[i][0]: (srt[i + 1][1] if i + 1 < len(srt) else None) for i in range(len(srt))}
    assert got == exp


def test_running_totals_match_cumsum(spark):
    rows = [(i, i % 3, 1) for i in range(300)]
    df = spark.createDataFrame(rows, "b long, h long, n long").repartition(4)
    got = {r["b"]: (r["cum_h"], r["cum_n"]) for r in running_totals(df, "b", ["h", "n"]).collect()}
    acc_h = acc_n = 0
    for b, h, n in rows:
        acc_h += h
        acc_n += n
        assert got[b] == (acc_h, acc_n)


def test_csv_header_copies_dropped_and_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([("1", "x"), ("a", "b"), ("2", "y")], "a string, b string")
    path = os.path.join(tmpdir_path, "csv")
    write_csv(df, path, header=True)              # the row ("a","b") repeats the header
    back = read_csv_with_header(spark, path)
    assert back.columns == ["a", "b"]
    assert sorted(tuple(r) for r in back.collect()) == [("1", "x"), ("2", "y")]
    raw = read_csv_strings(spark, path)
    assert raw.columns[:2] == ["_c0", "_c1"]


def test_csv_sink_refuses_existing_path(spark, tmpdir_path):
    df = spark.createDataFrame([("1",)], "a string")
    path = os.path.join(tmpdir_path, "out")
    write_csv(df, path)
    try:
        write_csv(df, path)
    except Exception as exc:  # noqa: BLE001
        assert "already exists" in str(exc).lower() or "path" in str(exc).lower()
    else:
        raise AssertionError("second write should fail")


def test_next_in_order_skips_empty_partitions(spark):
    rows = [(k, k * 10) for k in (3, 40, 41, 900, 5000)]
    df = spark.createDataFrame(rows, "k long, u long")
    got = {r["k"]: r["next_u"] for r in next_in_order(df, ["k"], ["u"], partitions=16).collect()}
    assert got == {3: 400, 40: 410, 41: 9000, 900: 50000, 5000: None}


def _mixed_rows():
    import datetime
    import decimal
    day = datetime.datetime(2020, 1, 1)
    return [(None if i % 11 == 0 else f"k{i * 7919 % 13}é", None if i % 7 == 0 else float(i % 5) / 3,
             day + datetime.timedelta(microseconds=i * 7919 % 97), decimal.Decimal(i * 31 % 17) / 4, i) for i in range(1500)]


def _nulls_first(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def test_positions_of_mixed_keys_without_a_checkpoint(spark):
    df = spark.createDataFrame(_mixed_rows(), "a string, b double, c timestamp, d decimal(10,2), _range long").withColumnRenamed("_range", "e").repartition(5)
    for ranges in (1, 40, 600):      # 600: the search as a loop
        got = sorted(positions(df, ["a", "b", "c", "d", "e"], ranges=ranges).collect(), key=lambda r: r["position"])
        assert [r["position"] for r in got] == list(range(1500))
        assert [tuple(r[:5]) for r in got] == sorted((tuple(r[:5]) for r in got), key=_nulls_first)
    assert positions(df.limit(0), ["a"]).count() == 0


def test_positions_in_groups_that_span_ranges(spark):
    rows = [("hot" if i % 3 else None if i % 2 else f"g{i % 40}", i * 7919 % 4001) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(5)
    want = {}
    for g in {r[0] for r in rows}:
        for k, v in enumerate(sorted(v for h, v in rows if h == g)):
            want[(g, v)] = k
    for ranges in (1, 3, 60):
        got = positions_in_group(df, "g", ["v"], ranges=ranges).collect()
        assert {(r["g"], r["v"]): r["position"] for r in got} == want and len(got) == 1500
    assert positions_in_group(df.limit(0), "g", ["v"]).count() == 0


def test_small_groups_are_numbered_without_ranges(spark):
    from lodestar.operators.sorting import positions_in_group
    rows = [(k % 40 if k % 11 else None, -k) for k in range(400)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(5)
    plain, ranged = (positions_in_group(df, "g", ["v"], "pos", n) for n in (None, 6))
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, plain.collect())) == sorted(map(str, ranged.collect())) and plain.schema == ranged.schema
