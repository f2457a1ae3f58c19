"""Operator 13, cross-tokenizer alignment by interval coalescing.

Tokens of both tokenizers are intervals of bytes.  All of them are sorted by start (``lexsort``), a running maximum of their ends
(``maximum.accumulate``) is kept, and a group ends where the next start reaches that maximum: there a token of each side ends.
Inside a group every token of one side is linked with every token of the other; equal ids of a group are counted first, so a long group
expands to its distinct id pairs.

Both tokenizers end a token before a single space between other characters, so the groups of a text are those of its pieces between such
spaces, and each distinct piece is encoded and coalesced once in a worker.

The count of an id pair is the number of documents that hold it linked.  Pass one writes each document's figures and its distinct pairs
to the shared folder; pass two adds up the pairs of all documents (bounded dictionaries in the tasks, then a shuffle of sums); pass three
looks counts up.  The ``COMMON`` most frequent pairs are broadcast; pairs beyond them, each of which few documents hold, go by a
shuffled join, so neither a large table is broadcast nor a hot pair joined.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import table
from .arrow_text import PieceCache, distinct, has_space_runs, ragged_take, segment_sums, slices, split_spaces, strings, texts_of
from .registry import query
from .sentence_pieces import MARK, load as load_pieces

COMMON = 1_000_000        # id pairs in the broadcast table
HELD_PIECES = 300_000     # distinct pieces that a worker keeps
HELD_PAIRS = 2_000_000    # id pairs that a task counts before it reports them
PIECES_AT_ONCE = 20_000   # distinct pieces that are coalesced together, at most
BYTES_AT_ONCE = 1 << 20

# A space that both tokenizers begin a new token at: not after a space or a literal marker, not before white space or the end.
CUT = re.compile(f"(?<=[^ {MARK}]) (?=[^\\s\\x85\\u180e\\u200b])")

_WHITE = "[\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
JOINED = 500   # pieces that A encodes in one call

# Of each distinct piece: tokens of A and of B, groups, links, whether the bytes agree, its id pairs each with how often, its groups as text.
Aligned = tuple[int, int, int, int, bool, bytes, str]


@lru_cache(maxsize=4)
def load_bytes(path: str):
    """``(tokenizer with special strings as plain text, bytes of each id)``, once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    # The printable stand-ins of the byte-level alphabet: printable bytes stand for themselves, the others from U+0100 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    entries = [b""] * t.get_vocab_size()
    for entry, i in t.get_vocab().items():
        entries[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return t, entries


@lru_cache(maxsize=4)
def piece_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a SentencePiece model."""
    sp, _ = load_pieces(path)
    return [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(sp.get_piece_size())]


@lru_cache(maxsize=4)
def byte_lengths(path: str) -> np.ndarray:
    return np.array([len(x) for x in load_bytes(path)[1]], np.int64)


@lru_cache(maxsize=4)
def piece_lengths(path: str) -> np.ndarray:
    return np.array([len(x) for x in piece_bytes(path)], np.int64)


@lru_cache(maxsize=1)
def id_strings() -> pa.Array:
    return pa.array(np.arange(1 << 16)).cast(pa.string())


@lru_cache(maxsize=4)
def held(a_path: str, b_path: str) -> dict[str, Aligned]:
    """The pieces that this worker has aligned so far."""
    return {}


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, group)`` of intervals: the order by start, and the group of each interval in that order.

    A group ends where the next start reaches the running maximum of the ends."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(fresh) - 1


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(group, id, how often)`` of the distinct ids of each group, by group."""
    kinds, n = np.unique(group.astype(np.int64) << 32 | ids, return_counts=True)
    return kinds >> 32, kinds & 0xFFFFFFFF, n


def links_of(group_a: np.ndarray, ids_a: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """``(group, a id, b id, links)`` for each distinct id pair of each group."""
    ga, a, na = _counted(group_a, ids_a)
    gb, b, nb = _counted(group_b, ids_b)
    size_b = np.bincount(gb, minlength=groups)
    first_b = np.cumsum(size_b) - size_b
    times = size_b[ga]
    at_a = np.repeat(np.arange(len(ga)), times)
    at_b = np.arange(len(at_a)) - np.repeat(np.cumsum(times) - times, times) + first_b[ga][at_a]
    return ga[at_a], a[at_a], b[at_b], na[at_a] * nb[at_b]


def align_pieces(pieces: list[str], a_path: str, b_path: str) -> list[Aligned]:
    """Each piece (a text behind a space) encoded by both tokenizers and coalesced."""
    out: list[Aligned] = []
    at = 0
    while at < len(pieces):
        to, size = at, 0
        while to < len(pieces) and to - at < PIECES_AT_ONCE and size < BYTES_AT_ONCE:
            size += len(pieces[to])
            to += 1
        out += _align_some(pieces[at:to], a_path, b_path)
        at = to
    return out


def _encode_a(pieces: list[str], own: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """``(ids per piece, ids)`` by A.  Pieces whose only white space is the first character stay apart when they are joined, so many are encoded in a call."""
    t, entries = load_bytes(path)
    lens = byte_lengths(path)
    inner = pc.match_substring_regex(pc.utf8_slice_codeunits(pa.array(pieces, pa.large_string()), 1), _WHITE).to_numpy(zero_copy_only=False)
    joint, alone = np.flatnonzero(~inner), np.flatnonzero(inner).tolist()
    n, starts, pool, held_ids = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), [], 0
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    for at in range(0, len(joint), JOINED):
        some = joint[at:at + JOINED]
        ids = np.array(t.encode("".join([pieces[i] for i in some.tolist()]), add_special_tokens=False).ids, np.int64)
        ends, cuts = np.cumsum(lens[ids]), np.cumsum(sizes[some])
        place = np.searchsorted(ends, cuts)
        if len(ids) and place[-1] < len(ends) and (ends[place] == cuts).all():
            n[some] = np.diff(place, prepend=-1)
            starts[some] = held_ids + place + 1 - n[some]
            pool.append(ids)
            held_ids += len(ids)
        else:
            alone += some.tolist()
    for i, got in zip(alone, t.encode_batch_fast([pieces[i] for i in alone], add_special_tokens=False)):
        ids = np.array(got.ids, np.int64)
        n[i], starts[i] = len(ids), held_ids
        pool.append(ids)
        held_ids += len(ids)
    return n, ragged_take(np.concatenate(pool) if pool else np.zeros(0, np.int64), starts, n, np.arange(len(pieces)))


def _drop(n: np.ndarray, ids: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.where(good, n, 0), ids[np.repeat(good, n)]


def _align_some(pieces: list[str], a_path: str, b_path: str) -> list[Aligned]:
    _, bytes_a = load_bytes(a_path)
    sp, _ = load_pieces(b_path)
    bytes_b = piece_bytes(b_path)
    if max(len(bytes_a), len(bytes_b)) > 1 << 16:
        raise ValueError("an id pair takes 16 bits a side")
    own = [p.encode() for p in pieces]
    n_a, flat_a = _encode_a(pieces, own, a_path)
    lists_b = sp.encode([p[1:] for p in pieces], num_threads=1)
    n_b = np.fromiter(map(len, lists_b), np.int64, len(lists_b))
    flat_b = np.fromiter(chain.from_iterable(lists_b), np.int64, int(n_b.sum()))
    # All bytes at once; piece by piece only if some differ.
    whole, sizes = b"".join(own), np.fromiter(map(len, own), np.int64, len(own))
    good = np.ones(len(pieces), bool)
    for n, flat, entries, path, kind in ((n_a, flat_a, bytes_a, a_path, byte_lengths), (n_b, flat_b, bytes_b, b_path, piece_lengths)):
        if (segment_sums(kind(path)[flat], n) == sizes).all() and b"".join([entries[i] for i in flat.tolist()]) == whole:
            continue
        ends = np.cumsum(n).tolist()
        good &= np.array([b"".join([entries[i] for i in flat[e - k:e].tolist()]) == w for w, e, k in zip(own, ends, n.tolist())], bool)
    if not good.all():   # pieces whose bytes differ have no tokens
        (n_a, flat_a), (n_b, flat_b) = _drop(n_a, flat_a, good), _drop(n_b, flat_b, good)
    lens = np.concatenate([byte_lengths(a_path)[flat_a], piece_lengths(b_path)[flat_b]])
    # Pieces stand one after another on one line of bytes; both sides cover it without a gap.
    ends = np.concatenate([np.cumsum(lens[:len(flat_a)]), np.cumsum(lens[len(flat_a):])])
    order, group = coalesce(ends - lens, ends)
    of = np.empty(len(order), np.int64)
    of[order] = group
    of_a, of_b = of[:len(flat_a)], of[len(flat_a):]
    groups = int(of.max(initial=-1)) + 1
    piece_of = np.zeros(groups, np.int64)
    piece_of[of_a] = np.repeat(np.arange(len(pieces)), n_a)
    n_groups = np.bincount(piece_of, minlength=len(pieces))
    g, a, b, times = links_of(of_a, flat_a, of_b, flat_b, groups)
    keys, where = np.unique(piece_of[g] << 32 | pair_key(a, b), return_inverse=True)
    times = np.bincount(where, weights=times, minlength=len(keys)).astype(np.int64)
    cuts = np.searchsorted(keys >> 32, np.arange(len(pieces) + 1))
    pairs = np.stack([keys & 0xFFFFFFFF, times], axis=1).astype("<u4").tobytes()
    n_links = segment_sums(times, np.diff(cuts)).tolist()
    said = _spell(of_a, flat_a, of_b, flat_b, groups, n_groups)
    cuts = (8 * cuts).tolist()
    return list(zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links, good.tolist(), [pairs[lo:hi] for lo, hi in zip(cuts, cuts[1:])], said))


def _joined(of: np.ndarray, parts: pa.Array, groups: int, by: str) -> pa.Array:
    """The strings of each of the ``groups``, in order, joined by ``by``."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=groups))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts), by)


def _spell(of_a: np.ndarray, a: np.ndarray, of_b: np.ndarray, b: np.ndarray, groups: int, n_groups: np.ndarray) -> list[str]:
    """The groups of each piece as text: ``a1,a2|b1;a3|b2``."""
    numbers = id_strings()
    sides = (_joined(of, numbers.take(pa.array(ids)), groups, ",") for of, ids in ((of_a, a), (of_b, b)))
    each = pc.binary_join_element_wise(*sides, "|")
    return _joined(np.repeat(np.arange(len(n_groups)), n_groups), each, len(n_groups), ";").to_pylist()


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An id pair as one number below 2 ** 32 (both vocabularies hold at most 65,536 ids)."""
    return a << 16 | b


def split_pieces(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``(pieces per text, pieces)`` of non-empty texts: a space and the text, cut at every ``CUT``."""
    odd = has_space_runs(texts) | pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False)
    order = np.argsort(odd, kind="stable")
    plain, rest = order[:int((~odd).sum())], order[int((~odd).sum()):]
    offsets, flat = split_spaces(texts.take(pa.array(plain)))
    flat = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), flat, pa.scalar("", pa.large_string()))
    lists = [[f" {p}" for p in CUT.split(t)] for t in texts.take(pa.array(rest)).to_pylist()]
    n = np.concatenate([np.diff(offsets), np.array([len(x) for x in lists], np.int64)]).astype(np.int64)
    flat = pa.concat_arrays([flat, pa.array([p for x in lists for p in x], pa.large_string())])
    counts, starts = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
    counts[order], starts[order] = n, np.cumsum(n) - n
    return counts, flat.take(pa.array(ragged_take(np.arange(len(flat)), starts, counts, np.arange(len(texts)))))


def _align_slice(texts: pa.Array, cache: PieceCache, apart: bool) -> tuple[np.ndarray, list[str], list[bytes], list[bytes]]:
    """Of each text: ``(n_a, n_b, n_groups, n_links)``, its groups as text, its id pairs and how often each."""
    full = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(full)
    some = texts.take(pa.array(at))
    if apart:
        counts, flat = split_pieces(some)
    else:
        counts, flat = np.ones(len(some), np.int64), pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), some, pa.scalar("", pa.large_string()))
    kinds, index = distinct(flat)
    codes = cache.codes(strings(kinds))
    figures = np.array([c[:5] for c in codes], np.int64).reshape(-1, 5)
    # A text has no tokens if one of its pieces has bytes that differ.
    bad = segment_sums(1 - figures[index, 4], counts) > 0
    sums = np.zeros((len(texts), 4), np.int64)
    for k in range(4):
        sums[at, k] = np.where(bad, 0, segment_sums(figures[index, k], counts))
    n_pairs = np.fromiter((len(c[5]) for c in codes), np.int64, len(codes)) // 8
    pool = np.frombuffer(b"".join([c[5] for c in codes]), "<u4").reshape(-1, 2)
    at_pool = ragged_take(np.arange(len(pool)), np.cumsum(n_pairs) - n_pairs, n_pairs, index)
    keys, times = pool[at_pool, 0], pool[at_pool, 1]
    row = np.repeat(at, segment_sums(n_pairs[index], counts))
    kept = ~np.isin(row, at[bad]) if bad.any() else np.ones(len(row), bool)
    own, where = np.unique(row[kept].astype(np.int64) << 32 | keys[kept], return_inverse=True)
    times = np.bincount(where, weights=times[kept], minlength=len(own)).astype("<u4")
    cuts = np.searchsorted(own >> 32, np.arange(len(texts) + 1)).tolist()
    own = (own & 0xFFFFFFFF).astype("<u4")
    said, to = [""] * len(texts), 0
    spelled = [c[6] for c in codes]
    where = index.tolist()
    for i, k, wrong in zip(at.tolist(), counts.tolist(), bad.tolist()):
        if not wrong:
            said[i] = ";".join([spelled[j] for j in where[to:to + k]])
        to += k
    return sums, said, [own[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], [times[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def write_alignments(docs: DataFrame, path: str, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = False) -> str:
    """Pass one: ``(uid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times[, groups])`` of every row below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        uid = TaskContext.get().partitionId() << 40
        cache = PieceCache(lambda xs: align_pieces(xs, a_path, b_path), held(a_path, b_path), cap=HELD_PIECES)
        _, apart = load_pieces(b_path)
        for batch in batches:
            for at, texts in slices(texts_of(batch.column(1))):
                sums, said, pairs, times = _align_slice(texts, cache, apart)
                out = [pa.array(np.arange(uid, uid + len(texts))), batch.column(0).slice(at, len(texts)), *(pa.array(sums[:, k].copy()) for k in range(4)),
                       pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said], pa.string()),
                       pa.array(pairs, pa.binary()), pa.array(times, pa.binary())]
                names = ["uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
                if with_groups:
                    out, names = [*out, pa.array(said, pa.string())], [*names, "groups"]
                uid += len(texts)
                yield pa.RecordBatch.from_arrays(out, names)

    schema = ("uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
              + (", groups string" if with_groups else ""))
    docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema).write.parquet(path)
    return path


def pair_counts(rows: DataFrame, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """``(pair, n, best)``: documents that hold an id pair linked, and whether no pair of the same A id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column(0)
            for at in range(0, len(column), 512):
                new, times = np.unique(np.frombuffer(b"".join(column.slice(at, 512).to_pylist()), "<u4"), return_counts=True)
                both, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
                keys, n = both, np.bincount(where, weights=np.concatenate([n, times]), minlength=len(both)).astype(np.int64)
                if len(keys) >= held_pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["pair", "n"])
                    keys, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["pair", "n"])

    counts = rows.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # At most one row for each id of A's vocabulary.
    most = counts.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("n").alias("most"))
    return (counts.withColumn("a", F.shiftright("pair", 16)).join(F.broadcast(most), "a")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", common: int = COMMON, with_groups: bool = False) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups])`` of every row's whole text.

    A (a byte-level BPE) encodes a space and the text, B (a SentencePiece model that puts a space in front) the text.  Texts that are null or empty, or whose
    tokens do not give the bytes of a space and the text, have no tokens: zeros and ''.  Every row is a document, repeated ones and those without an id
    too; other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    path = write_alignments(docs, scratch_path(spark, "alignments"), a_path, b_path, doc_id, text, with_groups)
    rows = spark.read.parquet(path)
    counted = scratch_path(spark, "pair-counts")
    pair_counts(rows).write.parquet(counted)
    counts = spark.read.parquet(counted)
    frequent = counts.orderBy(F.desc("n"), "pair").limit(common).toArrow()   # bounded by `common`
    order = np.argsort(frequent["pair"].to_numpy())
    known = spark.sparkContext.broadcast(tuple(frequent[c].to_numpy()[order] for c in ("pair", "n", "best")))
    rare = counts.count() > common
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if with_groups else [])]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = known.value
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                lists = some.column("pairs").to_pylist()
                keys = np.frombuffer(b"".join(lists), "<u4").astype(np.int64)
                times = np.frombuffer(b"".join(some.column("times").to_pylist()), "<u4").astype(np.int64)
                lens = np.array([len(x) // 4 for x in lists], np.int64)
                place = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
                hit = pairs[place] == keys if len(pairs) else np.zeros(len(keys), bool)
                count_sum = segment_sums(np.where(hit, times * n[place], 0) if len(pairs) else times * 0, lens)
                n_best = segment_sums(np.where(hit & best[place], times, 0) if len(pairs) else times * 0, lens)
                out = [*(some.column(c) for c in ("uid", *kept)), pa.array(count_sum, pa.int64()), pa.array(n_best, pa.int64())]
                names = ["uid", *kept, "count_sum", "n_best"]
                if rare:
                    offsets = np.concatenate([[0], np.cumsum(segment_sums((~hit).astype(np.int64), lens))])
                    items = pa.StructArray.from_arrays([pa.array(keys[~hit]), pa.array(times[~hit])], ["pair", "times"])
                    out, names = [*out, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)], [*names, "missed"]
                yield pa.RecordBatch.from_arrays(out, names)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"{c} {kinds[c]}" for c in ("uid", *kept)] + ["count_sum long", "n_best long"])
    if rare:
        schema += ", missed array<struct<pair: long, times: long>>"
    found = rows.mapInArrow(look_up, schema)
    if rare:
        more = (found.select("uid", F.inline("missed")).join(counts, "pair")
                .groupBy("uid").agg(F.sum(F.col("times") * F.col("n")).alias("rare_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best")))
        found = (found.drop("missed").join(more, "uid", "left")
                 .withColumn("count_sum", F.col("count_sum") + F.coalesce("rare_sum", F.lit(0)))
                 .withColumn("n_best", F.col("n_best") + F.coalesce("rare_best", F.lit(0))))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else []))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by byte_bpe_50k.json and piece_bpe_32k.model, aligned."""
    import public_tokenizers
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
