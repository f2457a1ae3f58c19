"""Operator 8, document fingerprints from prefix polynomial hashes.

``Prefixes`` holds, for two bases modulo 2^31 - 1, the polynomial hash of every prefix of a text.  The hash of any span is
a difference of two prefixes, brought to position 0; so any two spans compare in constant time, and the longest
common extension of two positions is found by binary search.

A fingerprint keeps the length, the hash of the whole text, and the hashes of the prefixes and suffixes whose
lengths are multiples of a power of two (``GRID`` of each at most); and up to ``SPANS`` places chosen by content, with the
hash of the prefix before each.  A place is where the hash of the next ``WINDOW`` characters, mixed, ends in enough zero bits,
so a passage has its places wherever it stands.  Of two fingerprints, the longest common prefix and
suffix are found by binary search on the lengths both hold, and the spans between neighbouring places compare by their
hashes, wherever they stand.  What prefix, suffix and shared spans cover of either text, over the longer length, is the likeness.

The likeness errs low by what an edit leaves of the span (at the ends: of the stride, at most a 16th) it falls in: a span is a
64th to a 32nd of a long text on average, not below some 16 characters, and the one that an edit hits about twice that.  Spans count in runs of ``WINDOW`` characters or more.  Texts
below that length, and texts of one short repeated piece, have no places, so only prefix and suffix count there.

Each row needs its successor's text.  Rows go once, by the part of their id (``order_parts``), to a task that walks
them in order; a part's first row also goes to the part before it, so no second join is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..sources.tables import table
from .order_parts import LEAST, Parts, order_key, parts_of
from .registry import query

P = np.uint64((1 << 31) - 1)
BITS = np.uint64(31)
BASES = (1_000_003, 998_244_353)   # odd, below the modulus; fixed so that equal texts hash alike everywhere
GRID = 32
WINDOW = 16            # characters whose hash chooses a place
SPANS = 64             # places of a fingerprint, at most
LEAST_ZEROS = 4        # zero bits of a place's hash, at least: a place in 16 characters on average


class _Powers:
    """Powers of a base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, int(P))
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) <= n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, int(P))) % P])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, int(P))) % P])


_POWERS = tuple(_Powers(b) for b in BASES)


class Prefixes:
    """Hashes of all prefixes of a text, for each base."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        self.sums = []
        for p in _POWERS:
            p.reach(self.n)
            terms = points * p.up[:self.n]
            terms = (terms & P) + (terms >> BITS)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)]))

    def prefix(self, at: np.ndarray, which: int = 0) -> np.ndarray:
        return self.sums[which][at] % P

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Hash of ``text[start:end]``, the same wherever the span stands."""
        out = []
        for k, p in enumerate(_POWERS):
            a, b = int(self.sums[k][start]) % int(P), int(self.sums[k][end]) % int(P)
            out.append((b - a) % int(P) * int(p.down[start]) % int(P))
        return out[0], out[1]

    def same(self, start: int, other: Prefixes, other_start: int, length: int) -> bool:
        return self.span(start, start + length) == other.span(other_start, other_start + length)

    def common_extension(self, start: int, other: Prefixes, other_start: int) -> int:
        """Length of the longest common run from the two positions on."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(start, other, other_start, mid):
                low = mid
            else:
                high = mid - 1
        return low


class Spliced:
    """Prefixes of ``first[:keep] + second[:take]``, from the two texts' prefixes alone."""

    def __init__(self, first: Prefixes, keep: int, second: Prefixes, take: int):
        self.first, self.keep, self.second, self.n = first, keep, second, keep + take
        for p in _POWERS:
            p.reach(self.n)

    def prefix(self, at: np.ndarray, which: int = 0) -> np.ndarray:
        inside = self.first.prefix(np.minimum(at, self.keep), which)
        beyond = self.second.prefix(np.maximum(at - self.keep, 0), which)
        return (inside + beyond * _POWERS[which].up[self.keep]) % P


def stride(n: int) -> int:
    """The power of two whose multiples up to ``n`` are at most ``GRID``."""
    return 1 << max(0, (n // GRID).bit_length() if n > GRID else 0)


def _places(text: Prefixes | Spliced) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Zero bits that at most ``SPANS`` places have at least; the places, their zero bits, and the hash of the prefix before each."""
    n = text.n
    prefixes = text.prefix(np.arange(n + 1, dtype=np.int64))
    windows = (prefixes[WINDOW:] + P - prefixes[:-WINDOW]) % P * _POWERS[0].down[:max(0, n + 1 - WINDOW)] % P
    mixed = (windows * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    zeros = LEAST_ZEROS
    at = np.flatnonzero(mixed[1:] & np.uint64((1 << zeros) - 1) == 0) + 1
    while len(at) > SPANS:
        zeros += 1
        at = at[mixed[at] & np.uint64((1 << zeros) - 1) == 0] if zeros <= 32 else at[:0]
    own = [int(x) or 1 << 32 for x in mixed[at]]
    return zeros, at, np.array([(x & -x).bit_length() - 1 for x in own], np.uint8), prefixes[at]


def fingerprint(text: Prefixes | Spliced) -> str:
    """``length:whole:prefix hashes:suffix hashes:zero bits:places:their zero bits:prefix hashes there``, all hexadecimal."""
    n = text.n
    s = stride(n)
    steps = np.arange(1, n // s + 1, dtype=np.int64) * s
    whole = [int(text.prefix(np.array([n]), k)[0]) for k in range(2)]
    front = text.prefix(steps)
    back = (np.uint64(whole[0]) + P - text.prefix(n - steps)) % P * _POWERS[0].down[n - steps] % P
    zeros, at, depth, before = _places(text)
    return (f"{n:x}:{whole[0]:08x}{whole[1]:08x}:{front.astype('>u4').tobytes().hex()}:{back.astype('>u4').tobytes().hex()}"
            f":{zeros:x}:{at.astype('>u4').tobytes().hex()}:{depth.tobytes().hex()}:{before.astype('>u4').tobytes().hex()}")


def _common(a: str, b: str, step_a: int, step_b: int, most: int) -> int:
    """Longest length, in multiples of the wider step and up to ``most``, at which both hashes are equal."""
    wide = max(step_a, step_b)
    low, high = 0, most // wide
    while low < high:
        mid = (low + high + 1) // 2
        i, j = (mid * wide // step_a - 1) * 8, (mid * wide // step_b - 1) * 8
        if a[i:i + 8] == b[j:j + 8]:
            low = mid
        else:
            high = mid - 1
    return low * wide


def _spans(n: int, whole: str, zeros: int, places: str, depth: str, before: str) -> list[tuple[int, int, int]]:
    """``(start, length, hash)`` of the spans between the places with that many zero bits, first to last character."""
    at = np.frombuffer(bytes.fromhex(places), ">u4").astype(np.int64)
    deep = np.frombuffer(bytes.fromhex(depth), np.uint8) >= zeros
    ends = np.concatenate([[0], at[deep], [n]])
    sums = np.concatenate([[0], np.frombuffer(bytes.fromhex(before), ">u4")[deep], [int(whole[:8], 16)]]).astype(np.uint64)
    _POWERS[0].reach(n)
    hashes = (sums[1:] + P - sums[:-1]) % P * _POWERS[0].down[ends[:-1]] % P
    return list(zip(ends[:-1].tolist(), np.diff(ends).tolist(), hashes.tolist()))


def _shared(one: list[tuple[int, int, int]], two: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start in one, start in two, length)`` of the runs of equal spans; each span counts once, next to the last one if it can."""
    where: dict[tuple[int, int], list[int]] = {}
    for j, (_, length, h) in reversed(list(enumerate(two))):
        where.setdefault((length, h), []).append(j)
    used: set[int] = set()
    runs: list[tuple[int, int, int]] = []
    last = -1   # the span of two that the span before matched
    for start, length, h in one:
        free = where.get((length, h), [])
        if last >= 0 and last + 1 < len(two) and last + 1 not in used and two[last + 1][1:] == (length, h):
            last += 1
            a, b, k = runs[-1]
            runs[-1] = (a, b, k + length)
        else:
            while free and free[-1] in used:
                free.pop()
            last = free.pop() if free else -1
            if last >= 0:
                runs.append((start, two[last][0], length))
        if last >= 0:
            used.add(last)
    return [r for r in runs if r[2] >= WINDOW]


def _covered(n: int, head: int, tail: int, runs: list[tuple[int, int]]) -> int:
    """Characters in the first ``head``, the last ``tail``, or a run ``(start, length)``."""
    total = upto = 0
    for start, end in sorted([(0, head), (n - tail, n), *((s, s + k) for s, k in runs)]):
        total += max(0, end - max(start, upto))
        upto = max(upto, end)
    return total


def likeness(one: str, two: str) -> float:
    """1 for equal fingerprints, else what common prefix, suffix and spans cover (less than all), over the longer length."""
    if one == two:
        return 1.0
    n1, whole1, front1, back1, zeros1, *places1 = one.split(":")
    n2, whole2, front2, back2, zeros2, *places2 = two.split(":")
    a, b = int(n1, 16), int(n2, 16)
    most = min(a, b)
    head = _common(front1, front2, stride(a), stride(b), most)
    tail = _common(back1, back2, stride(a), stride(b), most - head)
    zeros = max(int(zeros1, 16), int(zeros2, 16))
    runs = _shared(_spans(a, whole1, zeros, *places1), _spans(b, whole2, zeros, *places2))
    covered = min(_covered(a, head, tail, [(i, k) for i, _, k in runs]), _covered(b, head, tail, [(j, k) for _, j, k in runs]))
    longer = max(a, b, 1)
    return min(covered, longer - 1) / longer


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every row's whole text and of its edited text, and the two likenesses.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many (or all) of the next row's
    text, in ascending (id, text) order, null ids first; after the last row comes the first; a single row follows
    itself.  Null texts are empty.  Other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    parts: Parts = parts_of(docs, doc_id)
    known = spark.sparkContext.broadcast(parts)

    @pandas_udf("array<int>")
    def places(keys):
        """2p for a row of part p, and 2p + 1 for the part p that the row follows, if it is a part's first."""
        p = known.value
        k = keys.to_numpy()
        of = p.of(k)
        first = np.zeros(len(k), bool)
        if len(p.bounds):
            at = np.clip(of - 1, 0, len(p.bounds) - 1)
            first = (of > 0) & (p.bounds[at] == k)
        import pandas as pd
        return pd.Series([[2 * int(o), *([2 * int(o) - 1] if f else []), *([2 * p.count - 1] if x == p.least else [])]
                          for o, f, x in zip(of, first, k)])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None   # (part, is a row of the part, id, text, prefixes, fingerprint)
        rows: list[tuple] = []
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for place, key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                part, own = place // 2, place % 2 == 0
                value = value.as_py() or ""
                prefixes = Prefixes(value)
                mark = fingerprint(prefixes)
                if last and last[1] and last[0] == part:
                    _, _, k, t, ps, print_ = last
                    half = ps.n // 2
                    take = min(half, prefixes.n)
                    edited = fingerprint(Spliced(ps, ps.n - half, prefixes, take))
                    whole = t[:ps.n - half] + value[:take]
                    rows.append((None if k == LEAST else k, ps.n, hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(),
                                 print_, edited, likeness(print_, edited), likeness(print_, mark)))
                    if len(rows) >= 1000:
                        yield batch_of()
                        rows = []
                last = (part, own, key, value, prefixes, mark)
        if rows:
            yield batch_of()

    placed = (docs.select(order_key(doc_id).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
              .withColumn("place", F.explode(places("key")))
              .select(F.col("place"), "key", "text"))
    part = F.shiftright(F.col("place"), 1)   # 2p and 2p + 1 are the rows of part p and the first row behind it
    return (placed.repartition(part)
            .sortWithinPartitions(part, F.col("place") % 2, "key", "text")
            .select("place", "key", "text")
            .mapInArrow(walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                              "edited_fingerprint string, near_edited double, near_next double"))


@query("op8_prefix_hashes")
def op8_prefix_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and likenesses of every document."""
    return document_fingerprints(table(spark, sf_dir, "documents"))
