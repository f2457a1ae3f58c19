"""Operator 10, mixing sources to target weights by hierarchical budgeting.

The tree has domains, languages below them, sources below those.  A budget of tokens is shared top down: at each level
siblings share their parent's budget by weight, none gets more than its subtree can give (all its tokens times
``max_epochs``), and what one cannot use goes to its siblings first.  A parent's own share was bounded the same way by
its subtree, so only what all siblings together cannot use goes to the parent's siblings, and so on up.
The share of siblings is the water-filling solution, found in closed form over the siblings sorted by capacity per weight.

A leaf with budget b over t tokens gives ``floor(b / t)`` whole epochs and, from the next epoch, the longest prefix in
that epoch's seeded order with at most the remaining tokens.  The order is a hash of (id, epoch, seed); the prefix is found from
token sums over 4,096 equal ranges of the hash, and only the range where the budget ends is sorted, so no leaf is
gathered in one task.

Everything is DataFrame expressions; texts are read once, for their token counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..session import scratch_path
from ..sinks.tables import write_table
from ..sources.tables import table
from .jaccard_join import unused
from .registry import query

DOMAINS = 4
DOMAIN_WEIGHTS = {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}
LANG_WEIGHTS = {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}
SOURCE_WEIGHTS: dict[str, float] = {}
DEFAULT_WEIGHT = 1.0
BUDGET_SHARE = 0.6       # of the corpus' tokens
MAX_EPOCHS = 2
SEED = 17
MAX_LEAVES = 100_000     # rows of a leaf table that is broadcast; a larger one is joined by shuffling
RANGES = 4096            # hash ranges; 12 of the 60 hash bits
NONE = "none"            # of a null language or source
LEAF = ["domain", "lang", "source"]


def token_count(text: Column) -> Column:
    """Words between space, \\t, \\n, \\v, \\f, \\r; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """Sources are dealt to domains by the number that ends their name; names without one make a domain of their own."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.cast("long") % DOMAINS).cast("string"))).otherwise(F.lit("d_other"))


def _weight(name: Column, weights: Mapping[str, float]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for k, v in weights.items():
        out = F.when(name == k, F.lit(float(v))).otherwise(out)
    return out


def _share(level: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Water-filling: rows ``(*parent, name, w, cap, budget)`` with ``budget`` that of the parent; ``got`` is the row's own.

    In order of cap / w, a row is full if the level that fills it does not exceed what is left for it and the rest."""
    order = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = order.orderBy(F.col("cap") / F.col("w"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    w = (level.withColumn("_used", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("_left_w", F.sum("w").over(rest)))
    w = w.withColumn("_fair", F.col("w") * (F.col("budget") - F.col("_used")) / F.col("_left_w"))
    # The first row that is not full sets the level; all rows from it on get their weight times that level.
    first = F.min(F.when(F.col("_fair") < F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col(name), F.col("_fair") / F.col("w")))
                  ).over(Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0)))
    level_of = first.getField("col3")
    return (w.withColumn("_level", level_of)
            .withColumn("got", F.when(F.col("_level").isNull(), F.col("cap"))
                        .otherwise(F.least(F.col("cap"), F.col("w") * F.col("_level"))))
            .drop("_used", "_left_w", "_fair", "_level", "budget"))


def leaf_budgets(leaves: DataFrame, budget: float, max_epochs: int = MAX_EPOCHS,
                 domain_weights: Mapping[str, float] = DOMAIN_WEIGHTS, lang_weights: Mapping[str, float] = LANG_WEIGHTS,
                 source_weights: Mapping[str, float] = SOURCE_WEIGHTS) -> DataFrame:
    """``(domain, lang, source, tokens, budget)`` for leaves ``(domain, lang, source, tokens)``; budgets are whole tokens."""
    cap = F.sum("tokens").cast("double") * F.lit(float(max_epochs))
    domains = (leaves.groupBy("domain").agg(cap.alias("cap")).where(F.col("cap") > 0)
               .withColumn("w", _weight(F.col("domain"), domain_weights)).withColumn("budget", F.lit(float(budget))))
    domains = _share(domains, [], "domain").select("domain", F.col("got").alias("budget"))
    langs = (leaves.groupBy("domain", "lang").agg(cap.alias("cap")).where(F.col("cap") > 0)
             .withColumn("w", _weight(F.col("lang"), lang_weights)).join(domains, "domain"))
    langs = _share(langs, ["domain"], "lang").select("domain", "lang", F.col("got").alias("budget"))
    own = (leaves.where(F.col("tokens") > 0).withColumn("cap", F.col("tokens").cast("double") * F.lit(float(max_epochs)))
           .withColumn("w", _weight(F.col("source"), source_weights)).join(langs, ["domain", "lang"]))
    return (_share(own, ["domain", "lang"], "source")
            .select(*LEAF, "tokens", F.floor(F.col("got") + F.lit(1e-6)).cast("long").alias("budget")))


def order_hash(doc_id: Column, epoch: Column, seed: int) -> Column:
    """60 bits of md5 of ``id:epoch:seed``."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), epoch.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
        domain_weights: Mapping[str, float] = DOMAIN_WEIGHTS, lang_weights: Mapping[str, float] = LANG_WEIGHTS,
        source_weights: Mapping[str, float] = SOURCE_WEIGHTS) -> DataFrame:
    """``(doc_id, domain, lang, source, epoch, n_tokens)``: a row for each epoch in which a row of ``docs`` is selected.

    Null texts have no tokens and rows without tokens are never selected; null languages and sources are ``none``.
    Rows with the same id are ordered next to each other, by their token count and then alike (a tie is kept or
    left together, so the prefix may end before it).  Other columns are not read; an empty table selects nothing.
    """
    spark = docs.sparkSession
    src = F.coalesce(F.col(source).cast("string"), F.lit(NONE))
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), domain_of(src).alias("domain"),
                         F.coalesce(F.col(lang).cast("string"), F.lit(NONE)).alias("lang"), src.alias("source"),
                         token_count(F.col(text)).alias("n_tokens"))
    path = scratch_path(spark, "mix-tokens")
    narrow.where(F.col("n_tokens") > 0).write.parquet(path)
    rows = spark.read.schema("doc_id long, domain string, lang string, source string, n_tokens long").parquet(path)
    leaves = rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    plan = (leaf_budgets(leaves, budget_share * total, max_epochs, domain_weights, lang_weights, source_weights)
            .select(*LEAF, F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("whole"),
                    (F.col("budget") % F.col("tokens")).alias("rest")))
    # A row for each leaf: written once, and broadcast if they are few, so that the rows of a large leaf stay where they are.
    plan = broadcast_if_small(write_table(plan, "mix-plan"), MAX_LEAVES)
    placed = (rows.join(plan, LEAF).withColumn("h", order_hash(F.col("doc_id"), F.col("whole"), seed))
              .withColumn("range", F.shiftright(F.col("h"), 48).cast("int")))
    # Where the budget ends: one row for each leaf and hash range, at most RANGES a leaf.
    sums = placed.groupBy(*LEAF, "range").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"))
    in_leaf = Window.partitionBy(*LEAF).orderBy("range")
    ends = (sums.withColumn("upto", F.sum("n").over(in_leaf)).where(F.col("upto") > F.col("rest"))
            .groupBy(*LEAF).agg(F.min_by(F.struct(F.col("range").alias("end_range"), (F.col("upto") - F.col("n")).alias("used")), "range").alias("e"))
            .select(*LEAF, "e.end_range", "e.used"))
    placed = placed.join(broadcast_if_small(write_table(ends, "mix-ends"), MAX_LEAVES), LEAF)
    inside = placed.where(F.col("range") < F.col("end_range"))
    edge = placed.where(F.col("range") == F.col("end_range"))
    run = Window.partitionBy(*LEAF).orderBy("h", "doc_id", "n_tokens").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("upto", F.col("used") + F.sum("n_tokens").over(run)).where(F.col("upto") <= F.col("rest"))
    out = [*[F.col(c) for c in ("doc_id", *LEAF)]]
    partial = inside.unionByName(edge.drop("upto")).select(*out, F.col("whole").alias("epoch"), "n_tokens")
    full = (rows.join(plan.where(F.col("whole") > 0), LEAF)
            .select(*out, F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"), "n_tokens"))
    return full.unionByName(partial)


def select_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", **settings) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the mix selects in one epoch at most.

    A row is found again by id (null like any other), token count, language and source.  So of rows that share an id only
    the selected ones stay; rows alike in all four are selected or left together, within the budget, as in ``mix``."""
    chosen = mix(docs, max_epochs=1, doc_id=doc_id, text=text, lang=lang, source=source, **settings)
    keys = {"doc_id": F.col(doc_id).cast("long"), "lang": F.coalesce(F.col(lang).cast("string"), F.lit(NONE)),
            "source": F.coalesce(F.col(source).cast("string"), F.lit(NONE)), "n_tokens": token_count(F.col(text))}
    names = {k: unused(docs, f"_chosen_{k}") for k in keys}
    chosen = chosen.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
    same = F.lit(True)
    for k, own in keys.items():
        same = same & own.eqNullSafe(F.col(names[k]))
    return docs.join(chosen, same, "left_semi")


def _case(column: str, weights: Mapping[str, float]) -> str:
    whens = " ".join(f"WHEN {column} = '{k}' THEN {float(v)!r}" for k, v in weights.items())
    return f"(CASE {whens} ELSE {DEFAULT_WEIGHT!r} END)" if whens else repr(DEFAULT_WEIGHT)


def _sql_level(name: str, parent: list[str], rows: str) -> str:
    """Water-filling by trying each sibling as the first that is not full."""
    by = f"PARTITION BY {', '.join(parent)} " if parent else ""
    same = " AND ".join(f"a.{p} = b.{p}" for p in parent) or "true"
    keys = ", ".join([*parent, name])
    return f"""{name}_rows AS ({rows}),
{name}_fair AS (SELECT *, (budget - coalesce(sum(cap) OVER ({by}ORDER BY cap / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER ({by}ORDER BY cap / w, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM {name}_rows),
{name}_got AS (SELECT {keys}, least(cap, w * coalesce((SELECT min(lvl) FROM {name}_fair b WHERE {same} AND b.lvl < b.cap / b.w
    AND NOT EXISTS (SELECT 1 FROM {name}_fair c WHERE {same.replace('a.', 'c.')} AND c.lvl < c.cap / c.w
        AND (c.cap / c.w < b.cap / b.w OR (c.cap / c.w = b.cap / b.w AND c.{name} < b.{name})))), cap / w)) AS budget FROM {name}_fair a)"""


def mix_sql(budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for ``mix`` over ``documents``."""
    cap = f"sum(n_tokens) * {float(max_epochs)!r}"
    dw, lw, sw = _case("domain", DOMAIN_WEIGHTS), _case("lang", LANG_WEIGHTS), _case("source", SOURCE_WEIGHTS)
    return f"""
WITH s AS (SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
r AS (SELECT doc_id, CASE WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1) <> ''
    THEN 'd' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) % {DOMAINS} AS VARCHAR) ELSE 'd_other' END AS domain,
    lang, source, n_tokens FROM s WHERE n_tokens > 0),
{_sql_level("domain", [], f"SELECT domain, {cap} AS cap, {dw} AS w, (SELECT sum(n_tokens) * {budget_share!r} FROM r) AS budget FROM r GROUP BY domain")},
{_sql_level("lang", ["domain"], f"SELECT g.*, d.budget FROM (SELECT domain, lang, {cap} AS cap, {lw} AS w FROM r GROUP BY domain, lang) g JOIN domain_got d USING (domain)")},
{_sql_level("source", ["domain", "lang"], f"SELECT g.*, d.budget FROM (SELECT domain, lang, source, {cap} AS cap, {sw} AS w FROM r GROUP BY domain, lang, source) g JOIN lang_got d USING (domain, lang)")},
p AS (SELECT domain, lang, source, CAST(floor(CAST(floor(g.budget + 1e-6) AS BIGINT) / t.tokens) AS INTEGER) AS whole,
    CAST(floor(g.budget + 1e-6) AS BIGINT) % t.tokens AS rest
    FROM source_got g JOIN (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM r GROUP BY ALL) t USING (domain, lang, source)),
h AS (SELECT r.*, p.whole, p.rest, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(whole AS VARCHAR) || ':{seed}'), 1, 15) AS BIGINT) AS h
    FROM r JOIN p USING (domain, lang, source)),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id, n_tokens RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM h)
SELECT doc_id, domain, lang, source, whole AS epoch, n_tokens FROM c WHERE upto <= rest
UNION ALL
SELECT doc_id, domain, lang, source, CAST(unnest(range(0, whole)) AS INTEGER) AS epoch, n_tokens FROM h WHERE whole > 0"""


@query("op10_source_mix", mix_sql())
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents selected for the target mix, with the epoch of each selection."""
    return mix(table(spark, sf_dir, "documents"))
