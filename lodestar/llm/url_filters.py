"""Operator 4, URL filters by association rules that FP-growth mines.

A URL is a set of tokens: host labels, host suffixes, words of the path, the query's keys, a mark for numbers.  Of the labelled
URLs, tokens in fewer than ``MIN_COUNT`` blocked ones are left; tokens that stand in exactly the same URLs are one *item* (they are told by
equal sums of hashes of their URLs), so sets that say the same are mined once.  Spark's FP-growth mines the frequent item sets with the label
as an item of its own, of any length.  A set is a rule "these items: block" if the lower confidence bound (Wilson, ``Z``
standard deviations) of its blocked share is ``MIN_CONFIDENCE`` at least and above the share of all labelled URLs, so the same test holds at
every size; a rule is pruned if a shorter one inside it has at least its bound.  The kept rules reach the driver, which their count bounds.
Rules match through an inverted index from each rule's rarest item, so a URL looks up its own items only, all of them; a URL has an item if
it holds one of the item's tokens, as each of them alone would have made the same rule.

Explicit rules (host and path prefix) come first; the mined rules judge what no explicit rule fits.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from math import ceil, sqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..session import scratch_path
from ..sinks.tables import write_table
from ..sources.tables import table
from .registry import query

MIN_COUNT = 10           # blocked URLs that hold a rule's tokens
MIN_CONFIDENCE = 0.5     # least lower bound of a rule's blocked share
Z = 3.0
MAX_ITEMS = 200_000      # tokens with their items that are broadcast; more are joined
BLOCKED = "!blocked"     # the label as an item; tokens have a letter and a colon in front

# Fixed rules of the query: (host and path prefix, verdict).
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
_AFTER_HOST = re.compile(r"[/?#]")
_AFTER_PATH = re.compile(r"[?#]")
_WORD = re.compile(r"[^\W_]+")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = _AFTER_HOST.search(rest)
    host, rest = (rest[:m.start()], rest[m.start():]) if m else (rest, "")
    m = _AFTER_PATH.search(rest)
    return host.translate(_UPPER), rest[:m.start()] if m else rest


def fitting_rule(host: str, path: str, rules: Sequence[tuple[str, str]]) -> tuple[str, str] | None:
    """The longest rule whose host is the URL's host or a parent of it, and whose path starts the URL's path."""
    best = None
    for rule, verdict in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return best


def tokens_of(url: str | None) -> list[str]:
    """Distinct tokens of a URL, in order: host labels, their suffixes, path words, query keys."""
    host, path = host_and_path(url)
    if not host:
        return []
    labels = host.split(".")
    out = [f"h:{x}" for x in labels if x]
    out += [f"s:{'.'.join(labels[i:])}" for i in range(1, len(labels) - 1)]
    for part in path.split("/"):
        out += ["p:#" if w.isdigit() else f"p:{w.lower()}" for w in _WORD.findall(part)]
    if "?" in (url or ""):
        out += [f"q:{pair.partition('=')[0]}" for pair in url.split("?", 1)[1].split("#")[0].split("&") if pair]
    return list(dict.fromkeys(out))


class Rule(NamedTuple):
    """URLs that hold one token of each item are blocked; with the blocked share of the labelled ones, and these as a share of all."""

    items: tuple[tuple[str, ...], ...]
    confidence: float
    support: float


def lower_bound(n: int, bad: int) -> float:
    """Wilson's lower bound of the blocked share."""
    share, z2 = bad / n, Z * Z
    return round((share + z2 / (2 * n) - Z * sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n), 12)


def _items(baskets: DataFrame, least: int) -> DataFrame:
    """``(item, members)``: frequent tokens, those of exactly the same URLs together; the item is named by its least token."""
    held = baskets.select(F.explode("tokens").alias("token"), F.col("bad").cast("int").alias("bad"),
                          F.xxhash64("tokens", "bad").alias("a"), F.xxhash64(F.reverse("tokens"), "bad", F.lit(1)).alias("b"))
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    counted = (held.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"), wide("a").alias("a"), wide("b").alias("b"))
               .where(F.col("bad") >= least))
    return (counted.groupBy("n", "bad", "a", "b").agg(F.sort_array(F.collect_list("token")).alias("members"))   # tokens of one URL
            .select(F.col("members")[0].alias("item"), "members"))


def mine_rules(labelled: DataFrame, url: str = "url", blocked: str = "blocked", min_support: float = 0.0,
               min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT) -> list[Rule]:
    """The kept rules, from rows ``(url, blocked)``.

    A rule's items are in ``min_count`` blocked URLs and in the share ``min_support`` of all at least.  Rows with a null label
    or without tokens teach nothing; repeated rows count each time; without a blocked URL there is no rule."""
    spark = labelled.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = batch.column(1).to_pylist()
            out = [sorted(tokens_of(u)) if b is not None else [] for u, b in zip(batch.column(0).to_pylist(), bad)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string())), pa.array(bad, pa.bool_())], ["tokens", "bad"])

    path = scratch_path(spark, "url-baskets")   # written, so that a lost executor changes no row
    (labelled.select(F.col(url).cast("string"), F.col(blocked).cast("boolean"))
     .mapInArrow(cut, "tokens array<string>, bad boolean").where(F.size("tokens") > 0).write.parquet(path))
    baskets = spark.read.parquet(path)
    total, bad = baskets.agg(F.count(F.lit(1)), F.sum(F.col("bad").cast("long"))).first()
    if not bad:
        return []
    least = max(min_count, ceil(min_support * total))
    items = write_table(_items(baskets, least), "url-items")
    return _kept(_mined(baskets, items, least, total), items, total, bad / total, min_confidence)


def _mined(baskets: DataFrame, items: DataFrame, least: int, total: int) -> DataFrame:
    """``(items, n, bad)`` of every item set that ``least`` blocked URLs hold."""
    of_token = broadcast_if_small(items.select(F.explode("members").alias("token"), "item"), MAX_ITEMS)
    known = (baskets.select("tokens", "bad", F.monotonically_increasing_id().alias("uid"))
             .select("uid", "bad", F.explode("tokens").alias("token")).join(of_token, "token")
             .groupBy("uid", "bad").agg(F.collect_set("item").alias("own")))
    mark = F.when(F.col("bad"), F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<string>"))
    growth = FPGrowth(itemsCol="basket", minSupport=1.0, minConfidence=1.0)
    rows = write_table(known.select(F.concat("own", mark).alias("basket")), "url-items-of-rows")
    size = rows.count()
    if size < least:
        return baskets.sparkSession.createDataFrame([], "items array<string>, n long, bad long")
    found = growth.setMinSupport(min(1.0, (least - 0.5) / size)).fit(rows).freqItemsets   # the library rounds the count up
    with_mark = F.array_contains("items", BLOCKED)
    sets = found.where(~with_mark).select(F.sort_array("items").alias("items"), F.col("freq").alias("n"))
    marked = found.where(with_mark & (F.size("items") > 1)).select(F.sort_array(F.array_remove("items", BLOCKED)).alias("items"), F.col("freq").alias("bad"))
    return sets.join(marked, "items")


def _kept(mined: DataFrame, items: DataFrame, total: int, share: float, min_confidence: float) -> list[Rule]:
    """Rules by their bound, without those that a shorter rule inside them makes needless."""
    # What the bound needs at least comes to the driver, in short sets first; the exact test follows there.
    rows = mined.where(F.col("bad") >= F.lit(max(min_confidence, share)) * F.col("n")).collect()
    bounds = {frozenset(r["items"]): lower_bound(r["n"], r["bad"]) for r in rows}
    bounds = {k: v for k, v in bounds.items() if v >= min_confidence and v > share}
    by_item: dict[str, list[frozenset]] = {}
    kept: list[frozenset] = []
    for own in sorted(bounds, key=lambda k: (len(k), sorted(k))):
        if any(part < own and bounds[part] >= bounds[own] for item in own for part in by_item.get(item, ())):
            continue
        kept.append(own)
        by_item.setdefault(min(own), []).append(own)
    used = sorted({i for own in kept for i in own})
    spark = items.sparkSession
    named = spark.createDataFrame([(i,) for i in used], "item string")
    members = {r["item"]: tuple(r["members"]) for r in items.join(F.broadcast(named), "item").collect()}
    counts = {frozenset(r["items"]): (r["n"], r["bad"]) for r in rows}
    out = [Rule(tuple(members[i] for i in sorted(own)), counts[own][1] / counts[own][0], counts[own][1] / total) for own in kept]
    return sorted(out, key=lambda r: (len(r.items), -r.confidence, r.items))


def inverted_index(rules: Sequence[Rule]) -> tuple[dict[str, int], dict[int, list[tuple[frozenset, float]]]]:
    """``(item of each token, rules by their rarest item)`` (the one that the fewest rules hold, ties by name)."""
    place = {item: k for k, item in enumerate(sorted({i for r in rules for i in r.items}))}
    often = Counter(place[i] for r in rules for i in r.items)
    index: dict[int, list[tuple[frozenset, float]]] = {}
    for r in rules:
        own = frozenset(place[i] for i in r.items)
        index.setdefault(min(own, key=lambda k: (often[k], k)), []).append((own, r.confidence))
    return {t: k for item, k in place.items() for t in item}, index


def url_verdicts(pages: DataFrame, mined: Sequence[Rule],
                 rules: Sequence[tuple[str, str]] = URL_RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, confidence)`` of every row: the longest explicit rule's verdict, else
    "block" with the confidence of the best mined rule that matches, else "allow" (confidence null).

    Null URLs and URLs without ``://`` have empty host and path, no rule, and are allowed.  Repeated rows and null ids stay;
    other columns are not read; an empty table gives an empty table.
    """
    index = pages.sparkSession.sparkContext.broadcast(inverted_index(mined))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_of, by_item = index.value
        for batch in batches:
            rows = []
            for u in batch.column(1).to_pylist():
                host, path = host_and_path(u)
                fit = fitting_rule(host, path, rules) if host else None
                if fit:
                    rows.append((host, path, fit[0], fit[1], None))
                    continue
                own = {item_of[t] for t in tokens_of(u) if t in item_of} if by_item else set()
                best = max((c for k in own for need, c in by_item.get(k, ()) if need <= own), default=None)
                rows.append((host, path, None, "allow" if best is None else "block", best))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                                             ["page_id", "host", "path", "rule", "verdict", "confidence"])

    return (pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"))
            .mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, confidence double"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(url, blocked)``: a page whose path names a labelled document is blocked if that text is junk or toxic.

    The document's id is the first run of digits that makes a path part of its own, up to a dot.  A document with
    several labels is blocked if one of them says so."""
    number = F.regexp_extract("url", r"://[^/?#]*[^?#]*?/([0-9]{1,18})(?:[./?#]|$)", 1)
    bad = (labels.groupBy("doc_id")
           .agg(F.max((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("blocked")))
    return (pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id"))
            .join(bad, "doc_id").select("url", "blocked"))


@query("op4_url_filters")
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; the mined rules learn from the labels of the documents that pages show."""
    pages = table(spark, sf_dir, "pages")
    return url_verdicts(pages, mine_rules(labelled_urls(pages, table(spark, sf_dir, "labels"))))
