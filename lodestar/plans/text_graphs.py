"""Edge-list text files that Spark derives from the tables.

events, ordered by ``(ts, event_id)``, give one edge per consecutive pair of
events: ``user_id → next user_id``.  Two renderings are written to the shared
folder and read back as text, so the parsers meet real files:

* whitespace form: separators vary by event type (space, tab, no-break space,
  a leading blank, an ideographic space plus an ignored third field) and each
  signup adds a comment line;
* tab form: node names carry a namespace by event type (``Category:`` for
  click, ``Talk:`` for error), view lines get trailing blanks, each signup adds
  a line without a tab; one folder per event type (a multi-path read).

documents (first two words of each line) and pages (host → each href) give two more edge
sets without files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import next_in_order
from ..session import scratch_path
from ..sources.tables import table

# How each event type is rendered.
WS_SEP = {"view": " ", "signup": "\t", "click": "\u00a0", "error": " ", "purchase": " \u3000"}
NAMESPACE = {"click": "Category:", "error": "Talk:"}


def successions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, ts, user_id, event_type, next_user_id, next_event_type)`` for
    every event but the last, in ``(ts, event_id)`` order."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    nxt = next_in_order(ev, ["ts", "event_id"], ["user_id", "event_type"])
    return nxt.where(F.col("next_user_id").isNotNull())


def _case(c: Column, mapping: dict[str, str], default: str = "") -> Column:
    out = F.lit(default)
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def whitespace_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = successions(spark, sf_dir)
    u, n, t = F.col("user_id").cast("string"), F.col("next_user_id").cast("string"), F.col("event_type")
    sep = _case(t, WS_SEP, " ")
    line = (F.when(t == "error", F.concat(F.lit(" "), u, sep, n))
            .when(t == "purchase", F.concat(u, sep, n, F.lit(" "), t))
            .otherwise(F.concat(u, sep, n)))
    comments = s.where(t == "signup").select(F.concat(F.lit("# signup "), u).alias("value"))
    return s.select(line.alias("value")).unionByName(comments)


def write_whitespace_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "edges-ws")
    whitespace_lines(spark, sf_dir).write.text(path)
    return path


def tab_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_type, value)`` tab-form lines."""
    s = successions(spark, sf_dir)
    t, nt = F.col("event_type"), F.col("next_event_type")
    a = F.concat(_case(t, NAMESPACE), F.col("user_id").cast("string"))
    b = F.concat(_case(nt, NAMESPACE), F.col("next_user_id").cast("string"))
    line = F.concat(a, F.lit("\t"), b, F.when(t == "view", F.lit("  ")).otherwise(F.lit("")))
    no_tab = s.where(t == "signup").select("event_type", F.concat(F.lit("signup "), a).alias("value"))
    return s.select("event_type", line.alias("value")).unionByName(no_tab)


def write_tab_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """One folder per event type, whatever the types are; returns the written folders (SRC-4 input)."""
    path = scratch_path(spark, "edges-tab")
    tab_lines(spark, sf_dir).write.partitionBy("event_type").text(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(str(f.getPath()) for f in listed if f.isDirectory()) or [path]


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document: ``(doc_id, line, value)``, lines counted from 0."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "value"))


def page_link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``host<TAB>href`` for every href of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)
    hrefs = F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1))
    return pages.select("page_id", F.posexplode(hrefs).alias("pos", "href"), host.alias("host")) \
        .select("page_id", "pos", F.concat("host", F.lit("\t"), "href").alias("value"))
