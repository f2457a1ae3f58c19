"""Dirty-text edge pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import PY_NON_SPACE, PY_SPACE
from ..operators import edges as ED
from ..operators import rank as R
from ..sources.text import read_lines
from . import text_graphs as TG
from .rank_queries import rank_ctes
from .registry import query

# ---------------------------------------------------------------- oracle SQL
NS_SQL = "(CASE {c} WHEN 'click' THEN 'Category:' WHEN 'error' THEN 'Talk:' ELSE '' END)"

SUCC_CTES = """s0 AS (
  SELECT event_id, ts, user_id, event_type,
         lead(user_id) OVER w AS nu, lead(event_type) OVER w AS nt
  FROM events WINDOW w AS (ORDER BY ts, event_id)),
s AS MATERIALIZED (SELECT * FROM s0 WHERE nu IS NOT NULL)"""

WS_LINES_CTE = """ws_lines AS (
  SELECT CASE event_type
           WHEN 'error' THEN ' ' || user_id || ' ' || nu
           WHEN 'purchase' THEN user_id || ' ' || chr(12288) || nu || ' ' || event_type
           WHEN 'signup' THEN user_id || chr(9) || nu
           WHEN 'click' THEN user_id || chr(160) || nu
           ELSE user_id || ' ' || nu END AS value
  FROM s
  UNION ALL
  SELECT '# signup ' || user_id AS value FROM s WHERE event_type = 'signup')"""

TAB_LINES_CTE = f"""tab_lines AS (
  SELECT event_type,
         {NS_SQL.format(c='event_type')} || user_id || chr(9) || {NS_SQL.format(c='nt')} || nu
           || (CASE WHEN event_type = 'view' THEN '  ' ELSE '' END) AS value
  FROM s
  UNION ALL
  SELECT event_type, 'signup ' || {NS_SQL.format(c='event_type')} || user_id AS value
  FROM s WHERE event_type = 'signup')"""

WS_PAT = f"^({PY_NON_SPACE}*){PY_SPACE}+({PY_NON_SPACE}*)"


def ws_parse_sql(src: str, extra: str = "") -> str:
    return f"""SELECT {extra}value,
  CASE WHEN value IS NULL OR length(value) = 0 THEN 'empty'
       WHEN substr(value, 1, 1) = '#' THEN 'comment'
       WHEN NOT regexp_matches(value, '{PY_SPACE}') THEN 'single'
       ELSE 'edge' END AS status,
  regexp_extract(value, '{WS_PAT}', 1) AS src,
  regexp_extract(value, '{WS_PAT}', 2) AS dst
FROM {src}"""


def _strip_lower(c: str) -> str:
    return f"lower(regexp_replace({c}, '^{PY_SPACE}+|{PY_SPACE}+$', '', 'g'))"


def _ns_bad(c: str) -> str:
    return f"(strpos({c}, ':') > 0 AND NOT starts_with({c}, 'Category:'))"


def tab_parse_sql(src: str, extra: str = "") -> str:
    return f"""SELECT {extra}value, status, {_strip_lower('a')} AS src, {_strip_lower('b')} AS dst FROM (
  SELECT {extra}value, a, b,
    CASE WHEN {_ns_bad('a')} THEN 'namespace'
         WHEN p = 0 THEN 'arity'
         WHEN {_ns_bad('b')} THEN 'namespace'
         ELSE 'edge' END AS status
  FROM (SELECT {extra}value, p,
               CASE WHEN p > 0 THEN substr(value, 1, p - 1) ELSE value END AS a,
               CASE WHEN p > 0 THEN substr(value, p + 1) ELSE NULL END AS b
        FROM (SELECT {extra}value, strpos(value, chr(9)) AS p FROM {src})))"""


WS_EDGES_CTE = (SUCC_CTES + ",\n" + WS_LINES_CTE + ",\nws_parsed AS (" + ws_parse_sql("ws_lines") + ")"
                + ",\nedges AS MATERIALIZED (SELECT DISTINCT src, dst FROM ws_parsed WHERE status = 'edge')")
TAB_EDGES_CTE = (SUCC_CTES + ",\n" + TAB_LINES_CTE + ",\ntab_parsed AS (" + tab_parse_sql("tab_lines") + ")"
                 + ",\nedges AS MATERIALIZED (SELECT DISTINCT src, dst FROM tab_parsed WHERE status = 'edge')")

PAGE_LINES_SQL = r"""(SELECT page_id, CAST(pos AS INTEGER) AS pos, host || chr(9) || href AS value FROM (
  SELECT page_id, host, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM (
    SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1) AS host,
           regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages)))"""


# ------------------------------------------------------------------- queries
@query("src_text_edges", oracle="WITH " + SUCC_CTES + ",\n" + WS_LINES_CTE + "\nSELECT value FROM ws_lines")
def src_text_edges(spark, sf_dir):
    """SRC-3: the whitespace edge file, read back as lines."""
    return read_lines(spark, TG.write_whitespace_file(spark, sf_dir))


@query("src_multi_file", oracle="WITH " + SUCC_CTES + ",\n" + TAB_LINES_CTE + "\nSELECT value FROM tab_lines")
def src_multi_file(spark, sf_dir):
    """SRC-4 / SET-1: five folders read as one multi-path scan (bag union)."""
    return read_lines(spark, TG.write_tab_files(spark, sf_dir))


@query("edges_whitespace", oracle="SELECT doc_id, line, status, src, dst FROM (" +
       ws_parse_sql("""(SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line, unnest(lines) AS value
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""", "doc_id, line, ") + ")")
def edges_whitespace(spark, sf_dir):
    """PRJ-3 / FLT-1 over every line of the documents: first two blank-separated fields."""
    return ED.classify_whitespace_lines(TG.document_lines(spark, sf_dir)).select("doc_id", "line", "status", "src", "dst")


@query("edges_tab", oracle="SELECT page_id, pos, src, dst FROM (" +
       tab_parse_sql(PAGE_LINES_SQL, "page_id, pos, ") + ") WHERE status = 'edge'")
def edges_tab(spark, sf_dir):
    """PRJ-4 / SCL-1/2: host → href lines split at the first tab, stripped, lower-cased."""
    cl = ED.classify_tab_lines(TG.page_link_lines(spark, sf_dir))
    return cl.where(F.col("status") == "edge").select("page_id", "pos", "src", "dst")


@query("edges_namespace", oracle="WITH " + TAB_EDGES_CTE + "\nSELECT src, dst FROM edges")
def edges_namespace(spark, sf_dir):
    """FLT-2/3 + AGG-1: distinct tab-form edges surviving the namespace filter."""
    lines = read_lines(spark, TG.write_tab_files(spark, sf_dir))
    return ED.parse_tab_edges(lines).distinct()


@query("edge_line_report", oracle="WITH " + SUCC_CTES + ",\n" + TAB_LINES_CTE +
       ",\ntab_parsed AS (" + tab_parse_sql("tab_lines") + ")\n"
       "SELECT status, count(*) AS lines FROM tab_parsed GROUP BY status")
def edge_line_report(spark, sf_dir):
    """Rejected lines are counted, not thrown: lines per status in the tab form."""
    lines = read_lines(spark, TG.write_tab_files(spark, sf_dir))
    return ED.line_report(ED.classify_tab_lines(lines))


@query("text_rank_small", oracle=rank_ctes(WS_EDGES_CTE, 10) + """
SELECT id, round(rank, 6) AS rank, printf('%s has rank: %.6f', id, round(rank, 6)) AS line
FROM r10 ORDER BY rank DESC, id LIMIT 5""")
def text_rank_small(spark, sf_dir):
    """GR-5: text → comment filter → whitespace parse → distinct → 10 rounds → top 5."""
    lines = read_lines(spark, TG.write_whitespace_file(spark, sf_dir))
    return R.top_ranks(R.rank(ED.parse_whitespace_edges(lines), rounds=10), 5)


@query("text_rank_large", oracle=rank_ctes(TAB_EDGES_CTE, 10) +
       "\nSELECT id, round(rank, 6) AS rank FROM r10")
def text_rank_large(spark, sf_dir):
    """GR-6: several files → namespace filter → tab parse → distinct → 10 rounds."""
    lines = read_lines(spark, TG.write_tab_files(spark, sf_dir))
    return R.round_rank(R.rank(ED.parse_tab_edges(lines), rounds=10))


PAGE_EDGES_CTE = ("page_parsed AS (" + tab_parse_sql(PAGE_LINES_SQL, "page_id, pos, ") + ")"
                  + ",\nedges AS MATERIALIZED (SELECT DISTINCT src, dst FROM page_parsed WHERE status = 'edge')")


@query("rank_pages", oracle=rank_ctes(PAGE_EDGES_CTE, 1) + "\nSELECT id, round(rank, 6) AS rank FROM r1")
def rank_pages(spark, sf_dir):
    """Page host → href graph (tab form, cleaned, distinct), one round: hosts and
    link targets are disjoint, so a second round would leave nothing (rule 3)."""
    edges = ED.parse_tab_edges(TG.page_link_lines(spark, sf_dir))
    return R.round_rank(R.rank(edges, rounds=1))
