"""Operator 7, exact n-gram Jaccard join by universe partition and the pigeonhole principle.

A document's set holds the 64-bit hashes of its distinct word n-grams.  Sets of similarity ``t`` differ in at most
``h = floor((1 - t) / (1 + t) * (|r| + |s|))`` elements.  The universe of hashes is cut into ``m`` equal segments, ``m`` by the
size band of the smaller set.  If the segments that ``s`` looks up, each exactly (one unit) or up to one added or missing
element (two units), make ``h + 1`` units, then a partner ``r`` agrees with ``s`` in one of them.

* Index: for each set, the hash of its elements in every segment of its band, and for the first few segments of the band
  also the hashes with one element left out (the one-deletion neighbourhood).
* Lookup: a set looks into its own band and the bands below that can hold partners, with as many units as its size there
  asks for.  Units are allocated by cost: the number of sets expected to hold the same elements in a segment, from the number
  of sets in the band and the shares of the elements (measured for elements of many sets, assumed for the others).  Empty segments
  and segments of passages that many sets share are dear; one-deletion lookups come in when they are cheaper.
* Rows meet by their hash; only hashes with a lookup and two different sets are kept (``groups``).
* Candidates are verified exactly on the sets.  To spare work on groups of copies, equal sets are one class from the start;
  round one verifies each class against one leader (the one that it shares most hashes with) and joins them to components; round
  two verifies, in each group that still has several components, two members of each against two of the largest, one the same in all
  groups and one that changes with the group; round three verifies all pairs of a group that are still in different components.  In every round, pairs whose sizes or parity sketches already rule a link out are left (the parities of
  two sets' 1,024-bit sketches differ in no more bits than the sets do in elements).  Pairs inside a component need no test, so
  no group is expanded into all its pairs, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import free_shuffles, scratch_path
from ..sources.tables import table
from .arrow_text import distinct, slices, texts_of, words
from .components import connected_components, contracted
from .registry import query

SLICE = 4 << 20          # bytes of text that a task works on at once
WORDS = 5
PERCENT = 80             # similarity, in percent
SHARED = 0.01            # assumed share of the sets that hold an element, for the costs, where it is not measured
OFTEN_IN_SLICE = 2       # sets of a slice that hold an element which is then counted
OFTEN_SHARE = 0.0005     # share of all sets above which an element's share is kept
OFTEN_MOST = 200_000     # elements whose shares are kept
SEEN = 500_000           # sets that a task remembers, so that copies in its part are indexed once
INDEX, PROBE = 1, 2
NO_ID = 1 << 62          # ids from here on stand for null ids

_U = np.uint64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = x + _U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """``(elements, elements per text)``: each text's sorted distinct hashes of its word ``size``-grams (A-Z lower-cased), or of
    all its words if it has fewer; one text after another."""
    import pandas as pd
    n, flat = words(texts, lower=True)
    kinds, index = distinct(flat)
    hashed = pd.util.hash_array(kinds.to_numpy(zero_copy_only=False), categorize=False) if len(kinds) else np.zeros(0, np.uint64)
    w = hashed[index]
    factors = [_U(int(_FACTORS[j % 5]) + 2 * (j // 5)) for j in range(size)]
    grams = np.zeros(max(0, len(w) - size + 1), np.uint64)
    for j, f in enumerate(factors):
        grams += w[j:len(w) - size + 1 + j] * f
    grams = _mix(grams, 1)
    at, out = 0, []
    for k in n.tolist():
        if k >= size:
            own = np.sort(grams[at:at + k - size + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif k:
            whole = sum(int(v) * int(f) for v, f in zip(w[at:at + k], factors)) + k * 0x632BE59BD9B4E019
            out.append(_mix(np.array([whole & 0xFFFFFFFFFFFFFFFF], np.uint64), 2))
        else:
            out.append(grams[:0])
        at += k
    return (np.concatenate(out) if out else grams[:0]), np.fromiter(map(len, out), np.int64, len(out))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each consecutive group of values; integers wrap around."""
    ends = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    at = np.concatenate([[0], np.cumsum(counts)])
    return ends[at[1:]] - ends[at[:-1]]


def set_keys(elements: np.ndarray, counts: np.ndarray, which: int = 0) -> np.ndarray:
    """One of two independent 64-bit hashes of each set, signed."""
    return (_sums(_mix(elements, 3 + which), counts) + counts.astype(np.uint64) * _FACTORS[which]).view(np.int64)


def sketches(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1,024 parities of each set, as signed integers: bit i tells whether an odd number of elements fall on it."""
    row = np.repeat(np.arange(len(counts)), counts)
    bits = np.bincount(row * 1024 + (_mix(elements, 7) >> _U(54)).astype(np.int64), minlength=1024 * len(counts)) & 1
    return np.packbits(bits.astype(np.uint8)).view("<i8").reshape(-1, 16)


@lru_cache(maxsize=64)
def _bands(percent: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first sizes, segments, one-deletion segments)`` of the size bands up to ``most``."""
    first = [1]
    while first[-1] <= most:
        first.append(first[-1] * 100 // percent + 1)
    segments, doubles = [], []
    for lo, nxt in zip(first, first[1:]):
        high = nxt - 1
        m = difference(high * 100 // percent, high, percent) + 1
        m += m // 16
        segments.append(m)
        doubles.append(max(1, m // 50))
    return np.array(first[:-1]), np.array(segments), np.array(doubles)


def difference(a: int, b: int, percent: int) -> int:
    """Most elements in which sets of these sizes may differ at the similarity."""
    return (100 - percent) * (a + b) // (100 + percent)


def band_of(size, percent: int = PERCENT, most: int = 1 << 40):
    return np.searchsorted(_bands(percent, most)[0], size, side="right") - 1


class Shares:
    """Logarithms of the shares of sets that hold an element, and the number of sets in each size band."""

    def __init__(self, per_band: np.ndarray, often: np.ndarray, shares: np.ndarray):
        order = np.argsort(often)
        self.per_band, self.often, self.logs = per_band, often[order], np.log(np.maximum(shares[order], SHARED))

    def of(self, elements: np.ndarray) -> np.ndarray:
        out = np.full(len(elements), np.log(SHARED))
        if len(self.often):
            at = np.minimum(np.searchsorted(self.often, elements), len(self.often) - 1)
            known = self.often[at] == elements
            out[known] = self.logs[at[known]]
        return out


def signatures(elements: np.ndarray, counts: np.ndarray, shares: Shares, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, roles, position of the set)`` of non-empty sets: their index rows and their lookups."""
    firsts, segments, doubles = _bands(percent, 1 << 40)
    home = band_of(counts, percent)
    low = band_of(-(-counts * percent // 100), percent)
    mixed, logs = _mix(elements, 5), shares.of(elements)
    begin = np.cumsum(counts) - counts
    out, roles, sets = [], [], []

    def add(hashes: np.ndarray, role, position: np.ndarray) -> None:
        out.append(hashes)
        roles.append(np.broadcast_to(np.asarray(role, np.int32), hashes.shape))
        sets.append(position)

    for down in range(int((home - low).max()) + 1 if len(counts) else 0):
        who = np.flatnonzero(home - down >= low)
        n = counts[who]
        at = np.repeat(begin[who] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        own, mix, log = elements[at], mixed[at], logs[at]
        band = home[who] - down
        m, d = segments[band], doubles[band]
        first_seg = np.cumsum(m) - m
        # The hashes of a set are sorted and a segment is a range of them, so segments ascend over the slice.
        of_own = np.repeat(np.arange(len(who)), n)
        local_own = (((own >> _U(32)) * m[of_own].astype(np.uint64)) >> _U(32)).astype(np.int64)
        seg = first_seg[of_own] + local_own
        total = int(m.sum())
        k = np.bincount(seg, minlength=total)
        part = _sums(mix, k)
        of_seg = np.repeat(np.arange(len(who)), m)
        local = np.arange(total) - first_seg[of_seg]
        where = local.astype(np.uint64) + (band[of_seg].astype(np.uint64) << _U(40))
        exact_salt, near_salt = _mix(where, 9), _mix(where, 11)
        exact = _mix(part + exact_salt, 10)
        # Units: exact lookups of all segments and second units of the first ones, the cheapest for each set.
        expected = shares.per_band[np.minimum(band, len(shares.per_band) - 1)][of_seg]
        log_share = _sums(log, k)
        cost = 1 + expected * np.exp(log_share)
        double = np.flatnonzero(local < d[of_seg])
        dk = k[double]
        more = np.maximum(cost[double], dk + 2 + expected[double] * np.maximum(dk, 1) * np.exp(np.minimum(0, log_share[double] - np.log(SHARED))))
        high = firsts[np.minimum(band + 1, len(firsts) - 1)] - 1
        units = (100 - percent) * (n + np.minimum(n, high)) // (100 + percent) + 1
        unit_set = np.concatenate([of_seg, of_seg[double]])
        order = np.lexsort((np.concatenate([cost, more]), unit_set))
        per_set = m + np.bincount(of_seg[double], minlength=len(who))
        rank = np.arange(len(order)) - np.repeat(np.cumsum(per_set) - per_set, per_set)
        chosen = np.zeros(len(order), bool)
        chosen[order] = rank < units[unit_set[order]]
        probe, near = chosen[:total], double[chosen[total:]]
        if down == 0:
            add(exact, np.where(probe, INDEX | PROBE, INDEX), who[of_seg])
            # Index of one-deletion neighbourhoods: each element of the band's first segments left out in turn.
            e = np.flatnonzero(local_own < d[of_own])
            add(_mix(part[seg[e]] - mix[e] + near_salt[seg[e]], 12), INDEX, who[of_own[e]])
        else:
            add(exact[probe], PROBE, who[of_seg[probe]])
        if len(near):
            # A partner with one element more has this segment among its deletions; one with an element less is a deletion of it.
            add(_mix(part[near] + near_salt[near], 12), PROBE, who[of_seg[near]])
            mark = np.zeros(total, bool)
            mark[near] = True
            e = np.flatnonzero(mark[seg])
            add(_mix(part[seg[e]] - mix[e] + exact_salt[seg[e]], 10), PROBE, who[of_own[e]])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(roles), np.concatenate(sets)


MARKS = [f"s{i}" for i in range(16)]
SETS = "doc_id long, n long, key long, key2 long, " + ", ".join(f"{s} long" for s in MARKS) + ", often array<long>, often_n array<long>"


def _sets_table(docs: DataFrame, size: int, path: str) -> DataFrame:
    """A row ``SETS`` for every row, written and read again; the first row of a slice also counts the slice's frequent elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(texts_of(batch.column(1)), SLICE):
                elements, n = shingle_sets(texts, size)
                marks = sketches(elements, n)
                kinds, times = np.unique(elements, return_counts=True)
                again = times >= OFTEN_IN_SLICE
                lists = [pa.array([x[again].tolist(), *[[]] * (len(n) - 1)], pa.list_(pa.int64())) for x in (kinds.view(np.int64), times)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(n), pa.array(set_keys(elements, n)), pa.array(set_keys(elements, n, 1)),
                     *[pa.array(marks[:, i].copy()) for i in range(len(MARKS))], *lists],
                    ["doc_id", "n", "key", "key2", *MARKS, "often", "often_n"])

    docs.mapInArrow(run, SETS).write.parquet(path)
    return docs.sparkSession.read.schema(SETS).parquet(path)


def _shares(sets: DataFrame, classes: DataFrame, percent: int) -> Shares:
    """Sets in each band, and the shares of elements that many sets hold: at most ``OFTEN_MOST`` rows reach the driver.

    They steer costs only; whatever they are, the lookups of a set make enough units."""
    firsts = _bands(percent, 1 << 40)[0]
    per_band = np.ones(len(firsts))
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(1.05))))   # some hundred values
    for r in classes.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("sets"), F.min("n").alias("n")).collect():
        per_band[int(band_of(r["n"], percent))] += r["sets"]
    total = per_band.sum()
    often = (sets.where(F.size("often") > 0).select(F.explode(F.arrays_zip("often", "often_n")).alias("e"))
             .groupBy(F.col("e.often").alias("element")).agg(F.sum("e.often_n").alias("n"))
             .where(F.col("n") >= OFTEN_SHARE * total).orderBy(F.desc("n"), "element").limit(OFTEN_MOST).toArrow())
    return Shares(per_band, often.column("element").to_numpy().view(np.uint64), often.column("n").to_numpy() / total)


def _signature_rows(docs: DataFrame, shares: Shares, size: int, percent: int) -> DataFrame:
    """``(sig, role, key)`` of every set; copies of a set in the same part are indexed once."""
    known = docs.sparkSession.sparkContext.broadcast(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, texts in slices(texts_of(batch.column(0)), SLICE):
                elements, n = shingle_sets(texts, size)
                keys = set_keys(elements, n)
                new = []
                for i, key in enumerate(keys.tolist()):
                    if n[i] and key not in seen:
                        new.append(i)
                        if len(seen) < SEEN:
                            seen.add(key)
                if not new:
                    continue
                fresh = np.zeros(len(n), bool)
                fresh[new] = True
                sigs, roles, position = signatures(elements[np.repeat(fresh, n)], n[fresh], known.value, percent)
                sigs, own = sigs.view(np.int64), keys[fresh][position]
                for at in range(0, len(sigs), 1 << 18):
                    to = at + (1 << 18)
                    yield pa.RecordBatch.from_arrays([pa.array(sigs[at:to]), pa.array(roles[at:to]), pa.array(own[at:to])], ["sig", "role", "key"])

    return docs.select("text").mapInArrow(run, "sig long, role int, key long")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, lookups first): those whose sig has a lookup and two different sets.

    Memory is one batch and one row: a group whose first row is no lookup is dropped, one that has two sets is passed on."""
    held: tuple | None = None      # the only row so far of the open group
    open_sig, state = None, ""     # "one": held waits for another set; "pass" or "drop": what happens to the group's rows
    for batch in batches:
        sig, role, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(sig):
            continue
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        end = np.concatenate([start[1:], [len(sig)]])
        size = end - start
        group = np.repeat(np.arange(len(start)), size)
        many = np.add.reduceat(key != key[start][group], start) > 0
        good = many & ((role[start] & PROBE) > 0)
        if state and open_sig == sig[0]:     # the first group goes on from the batch before
            if state == "drop":
                good[0] = False
            elif state == "pass":
                good[0] = True
            else:
                good[0] = bool(many[0] or key[0] != held[2])
                if good[0]:
                    yield pa.RecordBatch.from_arrays([pa.array([held[i]], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64()))],
                                                     ["sig", "role", "key"])
            first_probe = state != "drop"
        else:
            first_probe = bool(role[0] & PROBE)
        take = good[group]
        last = len(start) - 1
        was_open = last == 0 and state and open_sig == sig[0]
        probe = first_probe if last == 0 else bool(role[start[last]] & PROBE)
        open_sig = sig[-1]
        if good[last]:
            state, held = "pass", None
        elif not probe:
            state, held = "drop", None
        else:
            held = held if was_open and held else (int(sig[start[last]]), int(role[start[last]]), int(key[start[last]]))
            state = "one"
        if take.any():
            yield pa.RecordBatch.from_arrays([pa.array(sig[take]), pa.array(role[take]), pa.array(key[take])], ["sig", "role", "key"])


def _stand_in():
    """The id of a row without one: above all real ids, the same for equal sets."""
    return F.lit(NO_ID) + F.col("key").bitwiseAND(F.lit((1 << 61) - 1))


def _verified(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges ``(a, b)`` between class ids, of the pairs ``(x, a, y, b)`` of keys and class ids whose sets reach the similarity."""
    wanted = pairs.select(F.inline(F.array(F.struct(F.col("x").alias("key"), F.col("a").alias("id")),
                                           F.struct(F.col("y").alias("key"), F.col("b").alias("id"))))).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(texts_of(batch.column(1)), SLICE):
                elements, n = shingle_sets(texts, size)
                full = pa.array(n > 0)
                data, ends = elements.astype("<u8").tobytes(), (8 * np.cumsum(n)).tolist()
                items = [data[e - 8 * k:e] for e, k in zip(ends, n.tolist()) if k]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)).filter(full), pa.array(set_keys(elements, n)).filter(full),
                     pa.array(items, pa.binary())], ["doc_id", "key", "items"])

    # The set of each class comes from the document that names it, once.
    items = (_with_perhaps(docs, wanted.select("id"), "doc_id", "_perhaps")
             .where(F.col("doc_id").isNull() | F.col("_perhaps")).select("doc_id", "text")
             .mapInArrow(sets, "doc_id long, key long, items binary")
             .select("key", F.coalesce("doc_id", _stand_in()).alias("id"), "items")
             .join(wanted, ["key", "id"], "left_semi").groupBy("key", "id").agg(F.first("items").alias("items")))
    left = pairs.join(items.select(F.col("key").alias("x"), F.col("id").alias("a"), F.col("items").alias("xs")), ["x", "a"])
    both = left.join(items.select(F.col("key").alias("y"), F.col("id").alias("b"), F.col("items").alias("ys")), ["y", "b"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column("xs"), batch.column("ys")):
                a, b = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                at = np.searchsorted(a, b)
                same = int((a[np.minimum(at, len(a) - 1)] == b).sum())
                good.append(100 * same >= percent * (len(a) + len(b) - same))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return both.select("a", "b", "xs", "ys").mapInArrow(check, "a long, b long")


BLOOM_WORDS = 1 << 18    # of 64 bits: 16 million bits in at most so many rows, whatever the input


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have (nor one that differs in case only)."""
    have = {c.lower() for c in docs.columns}
    while name.lower() in have:
        name += "_"
    return name


def _with_perhaps(docs: DataFrame, ids: DataFrame, column: str, flag: str) -> DataFrame:
    """``docs`` with ``flag``: true for every row whose id is in the only column of ``ids``, and, the more ids, for more of the others.

    The bits are a table of bounded size, so it is broadcast."""
    spot, word, bits = (unused(docs, n) for n in ("_spot", "_word", "_bits"))

    def place(c: str):
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(BLOOM_WORDS * 64))

    known = (ids.select(place(ids.columns[0]).alias("p")).groupBy(F.shiftright("p", 6).alias(word))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias(bits)))
    own = F.coalesce(F.expr(f"shiftright(`{bits}`, cast(`{spot}` & 63 AS int))").bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return (docs.withColumn(spot, place(column)).join(F.broadcast(known), F.shiftright(spot, 6) == F.col(word), "left")
            .withColumn(flag, own).drop(spot, word, bits))


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS,
                      percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row.

    The component is the least id reachable over links of the given similarity.  Null, empty and blank texts have no
    shingles and are linked with nothing: their component is their own id.  Rows that share an id are one document.  Rows
    with a null id count as documents, but never name a component unless it has no other ids; then it is null (ids must be
    below 2^62).  Other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = _sets_table(read, size, scratch_path(spark, "shingle-sets"))
    full = sets.where(F.col("n") > 0)
    class_path = scratch_path(spark, "shingle-classes")
    (full.groupBy("key", "key2", "n").agg(F.min(F.coalesce("doc_id", _stand_in())).alias("id"),
                                          *[F.first(m).alias(m) for m in MARKS])
     .write.parquet(class_path))
    classes = spark.read.parquet(class_path)

    group_path = scratch_path(spark, "shingle-groups")
    rows = _signature_rows(read, _shares(sets, classes, percent), size, percent)
    (rows.repartition("sig").sortWithinPartitions("sig", F.desc(F.col("role").bitwiseAND(PROBE)), "key")
     .mapInArrow(_shared, "sig long, role int, key long").dropDuplicates(["sig", "role", "key"])
     .write.parquet(group_path))
    groups = spark.read.schema("sig long, role int, key long").parquet(group_path)
    del rows
    free_shuffles(spark)

    # Round one: each class against the leader that it shares most hashes with.
    is_probe, is_index = F.col("role").bitwiseAND(PROBE) > 0, F.col("role").bitwiseAND(INDEX) > 0
    both_roles = F.min(F.when(is_probe & is_index, F.col("key")))
    leaders = groups.groupBy("sig").agg(F.coalesce(both_roles, F.min(F.when(is_index, F.col("key")))).alias("of_probe"),
                                        F.coalesce(both_roles, F.min(F.when(is_probe, F.col("key")))).alias("of_index"))
    leader = F.when(is_probe, F.col("of_probe")).otherwise(F.col("of_index"))
    chosen = (groups.join(leaders, "sig").select(F.col("key").alias("x"), leader.alias("y")).where(F.col("x") != F.col("y"))
              .groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))
              .groupBy("x").agg(F.max_by("y", F.struct("c", "y")).alias("y")))
    step_path = scratch_path(spark, "shingle-rounds")
    tested, parts = None, None

    def link(pairs: DataFrame, name: str) -> None:
        """Verify the pairs that were not tested before, and join what they link to the components so far."""
        nonlocal tested, parts
        one, other = F.struct("x", "a"), F.struct(F.col("y").alias("x"), F.col("b").alias("a"))
        pairs = (pairs.select(F.least(one, other).alias("l"), F.greatest(one, other).alias("g"))
                 .select(F.col("l.x").alias("x"), F.col("l.a").alias("a"), F.col("g.x").alias("y"), F.col("g.a").alias("b")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["x", "a", "y", "b"], "left_anti")
        pairs.write.parquet(f"{step_path}/pairs-{name}")
        pairs = spark.read.schema("x long, a long, y long, b long").parquet(f"{step_path}/pairs-{name}")
        tested = pairs if tested is None else tested.unionByName(pairs)
        _verified(read, pairs, size, percent).write.parquet(f"{step_path}/links-{name}")
        links = spark.read.schema("a long, b long").parquet(f"{step_path}/links-{name}")
        free_shuffles(spark)
        if parts is None:
            parts = connected_components(contracted(links))
        elif not links.isEmpty():
            parts = connected_components(contracted(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)))

    def members(rows: DataFrame, name: str) -> DataFrame:
        """Rows ``(sig, role, key, id)`` of the groups that still have several components, with their component, the group's main
        (largest) one and its first member in each of two orders."""
        placed = (rows.select("sig", "role", "key", "id").join(parts.withColumnRenamed("node", "id"), "id", "left")
                  .withColumn("component", F.coalesce("component", "id")))
        # Groups of the same rows would give the same pairs: one of them is enough.
        per_part = placed.groupBy("sig", "component").agg(
            F.count(F.lit(1)).alias("c"), F.min("key").alias("pick"), F.min_by("key", other).alias("pick2"),
            *[F.bit_xor(F.xxhash64("key", "role", F.lit(i))).alias(f"f{i}") for i in range(2)])
        apart = (per_part.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("c").alias("c"),
                                             F.max_by(F.struct("component", "pick", "pick2"), F.struct("c", "component")).alias("m"),
                                             *[F.bit_xor(f"f{i}").alias(f"f{i}") for i in range(2)])
                 .where(F.col("lo") != F.col("hi")).groupBy("c", "f0", "f1")
                 .agg(F.min_by(F.struct("sig", "m"), "sig").alias("g"))
                 .select("g.sig", F.col("g.m.component").alias("main"), F.col("g.m.pick").alias("leader"),
                         F.col("g.m.pick2").alias("leader2")))
        placed.join(apart, "sig").write.parquet(f"{step_path}/apart-{name}")
        free_shuffles(spark)
        return spark.read.parquet(f"{step_path}/apart-{name}")

    link(_possible(chosen, classes, percent), "1")
    # Round two: of each other component of a group, two members against two of the main component.  One is the same in all groups
    # of a set, so that few pairs are made, the other changes with the group, so that a set meets several others.
    other = F.xxhash64("key", "sig")
    apart = members(groups.join(classes.select("key", "id"), "key"), "2")
    delegates = (apart.where(F.col("component") != F.col("main")).groupBy("sig", "component")
                 .agg(F.min("key").alias("x"), F.first("leader").alias("y"), F.min_by("key", other).alias("x2"), F.first("leader2").alias("y2"))
                 .select(F.inline(F.array(F.struct("x", "y"), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))))).distinct())
    link(_possible(delegates, classes, percent), "2")
    # Round three: all pairs of a group that are still apart; at least one of them is outside the main component.
    apart = members(apart, "3").join(classes.select("key", "id", "n", *MARKS), ["key", "id"])
    a, b = apart.where(F.col("component") != F.col("main")).alias("a"), apart.alias("b")
    roles = ((F.col("a.role").bitwiseAND(PROBE) > 0) & (F.col("b.role").bitwiseAND(INDEX) > 0)) | \
        ((F.col("a.role").bitwiseAND(INDEX) > 0) & (F.col("b.role").bitwiseAND(PROBE) > 0))
    once = (F.col("b.component") == F.col("b.main")) | (F.col("a.key") < F.col("b.key"))
    link(a.join(b, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.component") != F.col("b.component")) & roles & once
                & _may_link("a", "b", percent))
         .select(F.col("a.key").alias("x"), F.col("a.id").alias("a"), F.col("b.key").alias("y"), F.col("b.id").alias("b")), "3")

    component = F.coalesce("component", "id")
    of_class = (classes.select("key", "key2", "n", "id").join(parts.withColumnRenamed("node", "id"), "id", "left")
                .select("key", "key2", "n", F.when(component < F.lit(NO_ID), component).alias("component")))
    found = full.select("doc_id", "key", "key2", "n").join(of_class, ["key", "key2", "n"])
    return (found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
            .unionByName(sets.where(F.col("n") == 0).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))


def _may_link(a: str, b: str, percent: int):
    """Sizes and sketches that do not rule a link out."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.{m}").bitwiseXOR(F.col(f"{b}.{m}"))) for m in MARKS), F.lit(0))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (differ * (100 + percent) <= (100 - percent) * (na + nb))


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``(x, a, y, b)``: the pairs of keys ``(x, y)`` that may link, with the ids of their classes."""
    marks = classes.select("key", "id", "n", *MARKS)
    return (pairs.alias("p").join(marks.alias("a"), F.col("p.x") == F.col("a.key")).join(marks.alias("b"), F.col("p.y") == F.col("b.key"))
            .where(_may_link("a", "b", percent)).select("p.x", F.col("a.id").alias("a"), "p.y", F.col("b.id").alias("b")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those whose component is named by another id.

    Rows with the same id stand or fall together; rows without an id stay.  A filter of fixed size lets most staying rows pass
    without a shuffle; what it cannot tell apart is decided by a join."""
    found = similar_documents(docs, doc_id, text)
    path = scratch_path(docs.sparkSession, "copies")
    (found.where(F.col("doc_id").isNotNull() & (F.col("doc_id") != F.col("component_id"))).select("doc_id").distinct()
     .write.parquet(path))
    gone = docs.sparkSession.read.schema("doc_id long").parquet(path)
    flag, name = unused(docs, "_perhaps"), unused(docs, "_gone")
    marked = _with_perhaps(docs, gone, doc_id, flag)
    perhaps = F.col(doc_id).isNotNull() & F.col(flag)
    decided = marked.where(perhaps).join(gone.withColumnRenamed("doc_id", name), F.col(doc_id) == F.col(name), "left_anti")
    return marked.where(~perhaps).unionByName(decided).select(*docs.columns)


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return similar_documents(table(spark, sf_dir, "documents"))
