from __future__ import annotations

import os

from pyspark.sql import functions as F

from lodestar.operators import edges as ED
from lodestar.sources.text import read_lines, read_lines_numbered


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_whitespace_parse_edge_cases(spark):
    df = lines(spark, ["# nodes: 3", "", " e f", "h ", "g", "c d", "a\tb extra", "x　y"])
    got = {r["value"]: (r["status"], r["src"], r["dst"]) for r in ED.classify_whitespace_lines(df).collect()}
    assert got["# nodes: 3"][0] == "comment"
    assert got[""][0] == "empty"
    assert got[" e f"] == ("edge", "", "e")
    assert got["h "] == ("edge", "h", "")
    assert got["g"][0] == "single"
    assert got["c d"] == ("edge", "c", "d")
    assert got["a\tb extra"] == ("edge", "a", "b")
    assert got["x　y"] == ("edge", "x", "y")


def test_whitespace_matches_python_split(spark):
    import re
    samples = ["a  b", "\x1c a\x1fb c", "  ", "p q", "k​v w"]
    rows = ED.classify_whitespace_lines(lines(spark, samples)).collect()
    for r in rows:
        parts = re.split(r"\s+", r["value"])
        if len(parts) >= 2:
            assert (r["src"], r["dst"]) == (parts[0], parts[1]), r["value"]
        else:
            assert r["status"] == "single"


def test_tab_parse_namespace_rules(spark):
    df = lines(spark, ["Talk:X\tY", "category:x\tY", " Category:x\tY", "Category:Q:R\ty",
                       "Category:Z\t Foo\tBar ", "A\tB", "a\tb ", "notab", "a\ta"])
    cl = {r["value"]: (r["status"], r["src"], r["dst"]) for r in ED.classify_tab_lines(df).collect()}
    assert cl["Talk:X\tY"][0] == "namespace"
    assert cl["category:x\tY"][0] == "namespace"
    assert cl[" Category:x\tY"][0] == "namespace"
    assert cl["Category:Q:R\ty"] == ("edge", "category:q:r", "y")
    assert cl["Category:Z\t Foo\tBar "] == ("edge", "category:z", "foo\tbar")
    assert cl["notab"][0] == "arity"
    edges = ED.parse_tab_edges(df).distinct().collect()
    assert ("a", "b") in {(r["src"], r["dst"]) for r in edges}
    assert len([r for r in edges if (r["src"], r["dst"]) == ("a", "b")]) == 1
    assert ("a", "a") in {(r["src"], r["dst"]) for r in edges}


def test_multi_path_read_and_numbered_lines(spark, tmpdir_path):
    for k, chunk in enumerate([["l0", "l1"], ["l2"], ["l3", "l4", "l5"]]):
        d = os.path.join(tmpdir_path, f"part{k}")
        os.makedirs(d)
        with open(os.path.join(d, "f.txt"), "w") as fh:
            fh.write("\n".join(chunk) + "\n")
    paths = [os.path.join(tmpdir_path, f"part{k}") for k in range(3)]
    assert sorted(r["value"] for r in read_lines(spark, paths).collect()) == [f"l{i}" for i in range(6)]
    numbered = read_lines_numbered(spark, paths).collect()
    assert sorted((r["line_no"], r["value"]) for r in numbered) == [(i, f"l{i}") for i in range(6)]


def test_full_split_and_strip_match_python(spark):
    import re

    from lodestar.functions.text import py_split_ws, py_strip
    samples = [" a  b\tc ", "x y z", "", "　lead", "tail\x1c"]
    rows = lines(spark, samples).select("value", py_split_ws(F.col("value")).alias("parts"),
                                        py_strip(F.col("value")).alias("stripped")).collect()
    for r in rows:
        assert list(r["parts"]) == re.split(r"\s+", r["value"]), r["value"]
        assert r["stripped"] == r["value"].strip(), r["value"]
