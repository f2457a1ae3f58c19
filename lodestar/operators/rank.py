"""Iterative link ranking over a directed edge table.

Semantics (kept exactly, they differ from textbook PageRank):

1. every node with an out-link starts at 1.0 (ranks are not divided by N);
2. each round only nodes present in the current ranks pass rank on;
3. a node is in the new ranks only if it received something, so after k
   rounds a node is present only if a walk of length k ends there;
4. nodes without out-links keep their rank but pass nothing on;
5. always ``rounds`` rounds, new rank = ``sum(contrib) * damping + (1 - damping)``.

Plan shape (per round, no shuffle of the edge table):

* ``links``  = distinct edges ``(src_salt, src, salt, dst, dst_degree, dst_salts)``
  written once as a table bucketed on ``src_salt``, the bucket that an edge is placed in;
* ``ranks``  = ``(id, rank, out_degree, n_salts)``: each node's rank travels
  with its own degree and salt count;
* a round turns every rank into ``n_salts`` share rows ``rank / out_degree``
  (node-sized, the only exchange besides the sums), joins them to the
  bucketed links on ``(src_salt, src, salt)`` without moving the links, and sums
  per ``dst`` with a partial + final aggregate that also hands on the target's
  degree and salt count, so a hub with huge in-degree is combined map-side.

Placement: the edges of a narrow source lie in one bucket per salt, so each bucket
sends one partial sum per target.  A wide source, with ``WIDE_TIMES`` edges or more
for each bucket, sends its share to every bucket, and its edges lie in the bucket of
their *target*: there the sums of a target over all wide sources are one row.  Sources
of a size class (power of two of the out-degree) are wide if that makes fewer rows.  A
round so shuffles at most one row per edge, and far fewer where either side of the edges
has high degrees.

Hot sources: a source with more than ``hot_split`` out-links has its edges
spread over ``ceil(out_degree / hot_split)`` salt buckets by a hash of the
target, so no single task holds a hot source's whole adjacency.  The table of
hot sources is broadcast only after its size is bounded: ``hot_split`` is raised
until at most ``max_hot_sources`` sources qualify (their count is at most
``E / hot_split``).
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, shuffles_end_with_queries
from .joins import HOT_ROWS, broadcast_if_small, heavy_hitters, join_spread
from ..sinks.tables import drop_table, write_bucketed, write_table

# Fixed values of the rank recurrence (reference defaults).
DEFAULT_ROUNDS = 10
DEFAULT_DAMPING = 0.85

DEFAULT_HOT_SPLIT = 200_000        # edges per salt bucket of one source
MAX_HOT_SOURCES = 100_000          # rows allowed in the broadcast hot table
MAX_LIST = 1_000_000               # targets in a row of an adjacency export, about
DEFAULT_CHECKPOINT_EVERY = 1
ENCODE_MIN_NAME_LENGTH = 16        # mean name length from which ids are encoded
LINKS_PER_BUCKET = 4_000_000       # target links per bucket of the links table
WIDE_TIMES = 2                     # edges for each bucket from which a source is wide
MAX_WIDE_SOURCES = 500_000         # sources that may be wide, at most: their table is broadcast
SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def dedupe_edges(edges: DataFrame, src: str = "src", dst: str = "dst", partitions: int | None = None) -> DataFrame:
    """AGG-1 / SET-2: duplicate edges count once (partial + final aggregate).

    ``partitions`` deals the edges out to so many tasks, so that each holds a bounded number of them."""
    e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    return (e.repartition(partitions, "src", "dst") if partitions else e).dropDuplicates(["src", "dst"])


def out_degree(edges: DataFrame) -> DataFrame:
    """AGG-3: number of distinct targets per source (``edges`` already distinct)."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def adjacency(edges: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """AGG-2: sorted target list per source, for export.

    A source with more than ``max_list`` targets is emitted as ``ceil(out_degree / max_list)`` rows
    (``part``, targets spread by a hash), whatever the rest of the graph holds, so that no single row or
    task has to hold an unbounded list.  The table of these sources is broadcast if its rows are few, else joined.
    """
    parts = F.ceil(F.col("out_degree") / F.lit(max_list)).cast("int")
    long = out_degree(edges).where(F.col("out_degree") > max_list).select("src", parts.alias("n_parts"))
    tagged = (edges.join(broadcast_if_small(long, MAX_HOT_SOURCES), "src", "left")
              .withColumn("n_parts", F.coalesce("n_parts", F.lit(1)))
              .withColumn("part", part_of("dst", F.col("n_parts"))))
    return (tagged.groupBy("src", "part")
            .agg(F.sort_array(F.collect_list("dst")).alias("targets"),
                 F.max("n_parts").alias("n_parts")))


def part_of(name: str, parts) -> Column:
    """Part of a target in a long list: 60 bits of the name's md5, modulo the parts (DuckDB computes the same)."""
    digest = F.md5(F.col(name).cast("string").cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), parts).cast("int")


def bucket_labels(spark, n: int) -> list[int]:
    """For each of ``n`` buckets, the least int that Spark's bucketing puts into it."""
    ids = spark.range(max(64, 40 * n)).select(F.col("id").cast("int").alias("label"))
    rows = ids.groupBy(F.pmod(F.hash("label"), F.lit(n)).alias("b")).agg(F.min("label").alias("label")).collect()
    known = {r["b"]: r["label"] for r in rows}
    return [known.get(b, b) for b in range(n)]      # a bucket without a label stays empty


def _size_class(degree: Column) -> Column:
    return F.floor(F.log2(degree)).cast("int")


def _is_wide(wide: tuple[int, list[int]]) -> Column:
    degree = F.coalesce(F.col("out_degree"), F.lit(0))
    return (degree >= wide[0]) & _size_class(degree).isin(wide[1]) if wide[1] else F.lit(False)


def choose_wide(e: DataFrame, deg: DataFrame, n: int) -> tuple[int, list[int]]:
    """``(least out-degree, size classes)`` of the sources that are wide, for ``n`` buckets.

    Narrow, a class sends a row per source and one per bucket and target (at most one per edge); wide, one per
    source and bucket and one per target.  The targets are counted approximately, which steers the plan only."""
    least = WIDE_TIMES * n
    while (few := deg.where(F.col("out_degree") >= least)).count() > MAX_WIDE_SOURCES:
        least *= 2
    sources = {r["c"]: r["n"] for r in few.groupBy(_size_class(F.col("out_degree")).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sources or n < 2:
        return least, []
    found = (e.join(F.broadcast(few), "src").groupBy(_size_class(F.col("out_degree")).alias("c"))
             .agg(F.count(F.lit(1)).alias("edges"), F.approx_count_distinct("dst").alias("targets")).collect())
    return least, sorted(r["c"] for r in found
                         if sources[r["c"]] * n + r["targets"] < sources[r["c"]] + min(r["edges"], r["targets"] * n))


def _placed(labels: list[int], wide: tuple[int, list[int]], src: str = "src") -> Column:
    """The ``src_salt`` of an edge or share (see module doc) from its source, degree and salt."""
    n = len(labels)
    part = F.when(_is_wide(wide), F.pmod(F.col("salt"), F.lit(n))).otherwise(
        F.pmod(F.xxhash64(src, "salt"), F.lit(n)).cast("int"))
    return F.element_at(F.lit(labels), part + 1)


@dataclass
class Links:
    """Prepared graph: salted edges plus the starting rank rows."""

    links: DataFrame    # src_salt, src, salt, dst, and dst_degree, dst_salts if carried
    start: DataFrame    # id, rank = 1.0, out_degree, n_salts (every source)
    hot_split: int
    table: str | None = None
    names: DataFrame | None = None     # node dictionary when ids are encoded
    path: str | None = None
    labels: list[int] | None = None    # src_salt of each bucket
    wide: tuple = (0, [])              # of choose_wide
    targets: DataFrame | None = None   # dst, dst_degree, dst_salts if not carried
    subset_keys: str | None = None     # the session's own setting of SUBSET_KEYS

    def release(self) -> None:
        """Drop the links table and delete its files (call once the ranks that
        used it are materialised)."""
        if self.subset_keys:
            self.links.sparkSession.conf.set(SUBSET_KEYS, self.subset_keys)
            self.subset_keys = None
        if self.table:
            drop_table(self.links.sparkSession, self.table, self.path)
            self.table = None


def _graph_stats(deg: DataFrame) -> tuple[int, float]:
    """Edge count and mean source-name length, one small aggregate."""
    r = deg.agg(F.sum("out_degree").alias("e"), F.avg(F.length("src")).alias("l")).first()
    return int(r["e"] or 0), float(r["l"] or 0.0)


def choose_hot_split(deg: DataFrame, hot_split: int = DEFAULT_HOT_SPLIT,
                     max_hot: int = MAX_HOT_SOURCES, total: int | None = None) -> int:
    """Raise ``hot_split`` until at most ``max_hot`` sources exceed it.

    The total edge count bounds the number of hot sources by ``E / hot_split``.
    """
    if total is None:
        total = _graph_stats(deg)[0]
    return max(int(hot_split), -(-int(total) // int(max_hot)), 1)


def bucket_count(spark, edges_total: int, per_bucket: int | None = None) -> int:
    """Buckets for the links: about ``LINKS_PER_BUCKET`` links each, at least
    the cluster's default parallelism (every core gets a bucket).  Shares of a bucket
    are no more than its links, which bounds the hash table that a round builds of them."""
    per = per_bucket or LINKS_PER_BUCKET
    return max(1, spark.sparkContext.defaultParallelism, -(-int(edges_total) // per))


def node_dictionary(e: DataFrame, meta: DataFrame) -> DataFrame:
    """``(name, nid, out_degree, n_salts)`` for every node, ids unique longs.

    ``monotonically_increasing_id`` needs no sort or global numbering; the
    dictionary is materialised by a reliable checkpoint so the ids never
    change when a task is recomputed.
    """
    targets_only = (e.select(F.col("dst").alias("name")).distinct()
                    .join(meta.select(F.col("src").alias("name")), "name", "left_anti")
                    .select("name", F.lit(None).cast("long").alias("out_degree"),
                            F.lit(None).cast("int").alias("n_salts")))
    nodes = meta.select(F.col("src").alias("name"), "out_degree", "n_salts").unionByName(targets_only)
    return nodes.withColumn("nid", F.monotonically_increasing_id()).checkpoint(eager=True)


def prepare_links(edges: DataFrame, partitions: int | None = None, cache: bool = True,
                  dedupe: bool = True, hot_split: int = DEFAULT_HOT_SPLIT,
                  max_hot: int = MAX_HOT_SOURCES, encode_ids: bool | None = None, hot_rows: int = HOT_ROWS,
                  carry: bool = True) -> Links:
    """Distinct edges with salt buckets and target metadata, placed for repeated joins.

    Each link row carries its target's out-degree and salt count, so the
    per-round aggregate hands them on with the new rank (``max`` in the same
    partial/final aggregate) and no per-round join with a node table is needed.

    ``cache=True`` writes the links once as a table bucketed on ``src_salt``
    in the shared checkpoint folder: every round then shuffles only the
    node-sized share side, and a lost executor re-reads files instead
    of recomputing the edge lineage.  ``partitions`` sets the bucket / hash
    partition count (GR-3).  The join of a round has more keys than the bucketing,
    which Spark keeps in place while ``SUBSET_KEYS`` is false (until ``release``).

    Targets (and, with ids, names) that hold many edges are found by a sketch and
    get their metadata by a broadcast of their few rows; the rest is shuffled.

    ``carry=False`` joins the metadata to the sums of each round instead (without ids,
    whose dictionary brings it along): links that are derived anew in every round then
    move once a round, not twice, and only node-sized rows meet the metadata.

    ``encode_ids`` replaces node names by long ids from a node dictionary
    before the rounds (names come back in one node-sized join at the end);
    ``None`` decides by the mean name length (long names: URLs, titles).
    """
    spark = edges.sparkSession
    e = dedupe_edges(edges) if dedupe else edges.select("src", "dst")
    if cache:
        e = e.persist(StorageLevel.MEMORY_AND_DISK)  # read by the degree and the links
    deg = out_degree(e).persist(StorageLevel.MEMORY_AND_DISK)
    total, mean_len = _graph_stats(deg)
    split = choose_hot_split(deg, hot_split, max_hot, total)
    if encode_ids is None:
        encode_ids = mean_len >= ENCODE_MIN_NAME_LENGTH
    n = partitions or bucket_count(spark, total)
    labels, wide = bucket_labels(spark, n), choose_wide(e, deg, n)
    n_salts = F.ceil(F.col("out_degree") / F.lit(split)).cast("int")
    # A multiple of the buckets, so that a target's salts of all wide sources name the same bucket.
    wide_salts = (F.ceil(n_salts / F.lit(n)) * n).cast("int")
    meta = deg.select("src", "out_degree", F.when(_is_wide(wide), wide_salts).otherwise(n_salts).alias("n_salts"))
    carry = carry or encode_ids
    hot_targets = heavy_hitters(e, "dst", total, hot_rows) if carry else []
    names = targets = None
    if encode_ids:
        names = node_dictionary(e, meta)
        src_side = names.select(F.col("name").alias("src"), F.col("nid").alias("sid"), "out_degree", "n_salts")
        dst_side = names.select(F.col("name").alias("dst"), F.col("nid").alias("did"),
                                F.col("out_degree").alias("dst_degree"), F.col("n_salts").alias("dst_salts"))
        links = (join_spread(join_spread(e, src_side, "src", "inner", heavy_hitters(e, "src", total, hot_rows)),
                             dst_side, "dst", "inner", hot_targets)
                 .select(F.col("sid").alias("src"), "out_degree",
                         F.pmod(F.xxhash64("did"), F.col("n_salts")).cast("int").alias("salt"),
                         F.col("did").alias("dst"), "dst_degree", "dst_salts"))
        start = names.where(F.col("out_degree").isNotNull()).select(
            F.col("nid").alias("id"), F.lit(1.0).alias("rank"), "out_degree", "n_salts")
    else:
        hot = meta.where((F.col("n_salts") > 1) | _is_wide(wide))      # at most max_hot and MAX_WIDE_SOURCES
        links = e.join(F.broadcast(hot), "src", "left")
        target = meta.select(F.col("src").alias("dst"), F.col("out_degree").alias("dst_degree"),
                             F.col("n_salts").alias("dst_salts"))
        if carry:
            links = join_spread(links, target, "dst", "left", hot_targets)
        else:
            targets = target
        links = links.select("src", "out_degree",
                             F.pmod(F.xxhash64("dst"), F.coalesce("n_salts", F.lit(1))).cast("int").alias("salt"),
                             "dst", *(["dst_degree", "dst_salts"] if carry else []))
        start = meta.select(F.col("src").alias("id"), F.lit(1.0).alias("rank"), "out_degree", "n_salts")
    links = links.select(_placed(labels, wide).alias("src_salt"), *(c for c in links.columns if c != "out_degree"))
    table = path = None
    subset_keys = spark.conf.get(SUBSET_KEYS)
    spark.conf.set(SUBSET_KEYS, "false")
    if cache:
        links, table, path = write_bucketed(links, n, ["src_salt"], "links", total, "dst")
        start = start.checkpoint(eager=True)
    else:
        links = links.repartition(n, "src_salt")
    if cache:
        e.unpersist()
    deg.unpersist()
    return Links(links=links, start=start, hot_split=split, table=table, names=names, path=path,
                 labels=labels, wide=wide, targets=targets, subset_keys=subset_keys)


def decode_ids(prep: Links, ranks: DataFrame) -> DataFrame:
    """Node names back for encoded ranks (one node-sized join)."""
    if prep.names is None:
        return ranks
    d = prep.names.select(F.col("nid").alias("id"), F.col("name"))
    return ranks.join(d, "id").select(F.col("name").alias("id"), "rank")


def initial_ranks(prep: Links) -> DataFrame:
    """PRJ-5: 1.0 for every node with an out-link (plus its carried metadata)."""
    return prep.start


def rank_round(prep: Links, ranks: DataFrame, damping: float = DEFAULT_DAMPING) -> DataFrame:
    """One round: spread (GR-1) → join (JN-1) → sum (AGG-4) → damp (PRJ-6).

    ``ranks`` rows are ``(id, rank, out_degree, n_salts)``; nodes without
    out-links (null degree) pass nothing on.
    """
    share = (ranks.where(F.col("out_degree").isNotNull())
             .select(F.col("id").alias("src"), "out_degree",
                     (F.col("rank") / F.col("out_degree")).alias("share"),
                     F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1)).alias("salt"))
             .select(_placed(prep.labels, prep.wide).alias("src_salt"), "src", "salt", "share"))
    # Build the hash table on the node-sized share side and stream the links
    # (no sort of the edge table each round); AQE may still pick a broadcast
    # when the measured share side is small.
    contrib = share.hint("shuffle_hash").join(prep.links, ["src_salt", "src", "salt"], "inner")
    if prep.targets is None:
        sums = contrib.groupBy("dst").agg(F.sum("share").alias("total"),
                                          F.max("dst_degree").alias("out_degree"),
                                          F.max("dst_salts").alias("n_salts"))
    else:
        sums = (contrib.groupBy("dst").agg(F.sum("share").alias("total")).join(prep.targets, "dst", "left")
                .withColumnsRenamed({"dst_degree": "out_degree", "dst_salts": "n_salts"}))
    return sums.select(F.col("dst").alias("id"),
                       (F.col("total") * F.lit(damping) + F.lit(round(1.0 - damping, 12))).alias("rank"),
                       "out_degree", "n_salts")


def rank(edges: DataFrame, rounds: int = DEFAULT_ROUNDS, damping: float = DEFAULT_DAMPING,
         partitions: int | None = None, cache: bool = True, dedupe: bool = True,
         checkpoint_every: int | None = DEFAULT_CHECKPOINT_EVERY,
         hot_split: int = DEFAULT_HOT_SPLIT, max_hot: int = MAX_HOT_SOURCES,
         as_table: bool = False, encode_ids: bool | None = None) -> DataFrame:
    """GR-2/3/4: ``rounds`` rounds of link ranking; returns ``(id, rank)``.

    ``partitions`` fixes the hash partitioning of the prepared links (GR-3,
    PRT-1); ``cache`` materialises them once as a bucketed table (GR-4,
    PRT-3).  Every ``checkpoint_every`` rounds the ranks are written with a
    reliable checkpoint to the shared ``spark.checkpoint.dir`` so the plan
    stays short and a lost executor only costs the rounds since then.
    """
    if rounds < 0:
        raise ValueError("rounds must be >= 0")
    checkpoint_dir(edges.sparkSession)
    # Without the cache each round shuffles all links: on disk are those of one query at a time.
    with nullcontext() if cache else shuffles_end_with_queries(edges.sparkSession):
        prep = prepare_links(edges, partitions=partitions, cache=cache, dedupe=dedupe,
                             hot_split=hot_split, max_hot=max_hot, encode_ids=encode_ids, carry=cache)
        ranks = initial_ranks(prep)
        for i in range(1, rounds + 1):
            ranks = rank_round(prep, ranks, damping)
            if checkpoint_every and (i % checkpoint_every == 0 or i == rounds):
                ranks = write_table(ranks, "ranks") if as_table else ranks.checkpoint(eager=True)
    if checkpoint_every and rounds:
        prep.release()          # final ranks are materialised; forget the links table
    return decode_ids(prep, ranks.select("id", "rank"))


def top_ranks(ranks: DataFrame, k: int = 5) -> DataFrame:
    """SNK-3 / SRT-2: the ``k`` highest ranks with a position and a report line.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k, the driver merges ``k × tasks`` rows; nothing else is
    collected.
    """
    top = ranks.orderBy(F.desc("rank"), F.asc("id")).limit(k)
    return top.select(
        "id", F.round("rank", 6).alias("rank"),
        F.format_string("%s has rank: %.6f", F.col("id"), F.round("rank", 6)).alias("line"))


def rank_text_lines(ranks: DataFrame, decimals: int = 6) -> DataFrame:
    """SNK-2 text form: Python tuple text ``('id', rank)`` per node, the rank
    with a fixed number of decimals (stable across engines)."""
    return ranks.select(F.format_string(f"('%s', %.{decimals}f)", F.col("id"),
                                        F.round("rank", decimals)).alias("value"))


def round_rank(ranks: DataFrame, places: int = 6) -> DataFrame:
    return ranks.select("id", F.round("rank", places).alias("rank"))
