"""Operator 11, harmonic packing of token ids into sequences of a fixed capacity.

A document of more than ``capacity`` ids gives full sequences first.  What remains, ``r`` ids, belongs to the class
``k = capacity // r``: lengths in ``(capacity / (k + 1), capacity / k]``.  A bin of class ``k`` takes exactly ``k`` documents, so a worker
needs one open bin a class and no search, and workers pack independently of each other.

The gap that a full bin leaves is filled by cutting: gaps wait until a document is no longer than all of them together, and
that document is dealt out to them.  At its end a worker deals out the documents of its unfinished bins in the same way, cuts what is left into
full sequences, and the last ids of all (fewer than ``capacity``) into sequences of a power of two, which need no padding.  So
nothing is padded, most documents stay whole, and a worker makes at most ``log2(capacity)`` short sequences.

A worker holds one open bin for each class (about ``2 * sqrt(capacity)`` of them) and the bins whose gaps wait (their gaps sum up to
less than two sequences); texts are encoded in slices.  Nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .arrow_text import PieceCache, distinct, ragged_take, segment_sums, slices, strings, texts_of, words
from .public_bpe import encode_pieces, held
from .registry import query

CAPACITY = 4096
END_ID = 2
ROWS_AT_ONCE = 4096   # pieces in an output batch, at least


@dataclass(frozen=True)
class Piece:
    """Ids ``start .. start + len(ids)`` of a document of ``total`` ids."""

    doc: int | None
    start: int
    ids: np.ndarray
    total: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


@dataclass
class Packer:
    """The bins of one worker; every method gives the sequences (lists of pieces) that it has closed."""

    capacity: int
    bins: dict[int, list[Piece]] = field(default_factory=dict)
    waiting: deque[tuple[list[Piece], int]] = field(default_factory=deque)   # closed bins and their gaps
    gaps: int = 0

    def _fill(self, piece: Piece) -> Iterator[list[Piece]]:
        """Deal a piece that is no longer than all gaps together out to them."""
        while len(piece.ids):
            held, gap = self.waiting.popleft()
            part, piece = piece.cut(min(gap, len(piece.ids)))
            held.append(part)
            gap -= len(part.ids)
            self.gaps -= len(part.ids)
            if gap:
                self.waiting.appendleft((held, gap))
            else:
                yield held

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.capacity:
            full, piece = piece.cut(self.capacity)
            yield [full]
        n = len(piece.ids)
        if n == 0:
            return
        if n <= self.gaps:
            yield from self._fill(piece)
            return
        k = self.capacity // n
        own = self.bins.setdefault(k, [])
        own.append(piece)
        if len(own) == k:
            del self.bins[k]
            gap = self.capacity - sum(len(p.ids) for p in own)
            if gap:
                self.waiting.append((own, gap))
                self.gaps += gap
            else:
                yield own

    def end(self) -> Iterator[list[Piece]]:
        # Short documents first: they are cut least when they are dealt out to gaps.
        left = deque(p for k in sorted(self.bins, reverse=True) for p in self.bins[k])
        self.bins = {}
        while self.waiting:
            if not left:
                own, gap = self.waiting.pop()
                self.gaps -= gap
                left.extend(own)
                continue
            piece = left.popleft()
            if len(piece.ids) > self.gaps:
                piece, rest = piece.cut(self.gaps)
                left.appendleft(rest)
            yield from self._fill(piece)
        rest, size = sum(len(p.ids) for p in left), 0
        own: list[Piece] = []
        while rest:
            to = self.capacity if rest >= self.capacity else 1 << (rest.bit_length() - 1)
            own, size = [], 0
            while size < to:
                piece = left.popleft()
                if len(piece.ids) > to - size:
                    piece, after = piece.cut(to - size)
                    left.appendleft(after)
                own.append(piece)
                size += len(piece.ids)
            rest -= to
            yield own


def pack_all(pieces: Iterable[Piece], capacity: int = CAPACITY) -> Iterator[list[Piece]]:
    """The sequences of one worker's documents."""
    packer = Packer(capacity)
    for piece in pieces:
        yield from packer.add(piece)
    yield from packer.end()


def ids_of_words(texts: pa.Array, path: str, cache: PieceCache) -> tuple[np.ndarray, np.ndarray]:
    """``(ids per text, ids)`` by a tokenizer that drops white space and joins nothing across it: word by word, each distinct one once."""
    counts, flat = words(texts, lower=False)
    kinds, index = distinct(flat)
    codes = cache.codes(strings(kinds))
    lens = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
    ids = ragged_take(np.frombuffer(b"".join(codes), "<u4"), np.cumsum(lens) - lens, lens, index)
    return segment_sums(lens[index], counts), ids


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
         with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])`` of every piece.

    ``start`` is the piece's place among its document's ids, ``offset`` its place in its sequence.  A null text is empty: its only id is
    ``end_id``.  Repeated rows and rows without an id are documents of their own; other columns are not read; an empty table gives an empty
    table.  ``capacity`` is a power of two.  A sequence id holds the number of the task, so a task that runs again repeats its own sequences as long
    as its rows come in the same order (a table that is read from files).
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 33
        cache = PieceCache(lambda xs: encode_pieces(tokenizer, xs), held(tokenizer, "ids"), cap=400_000)
        end = np.array([end_id], "<u4")

        def documents() -> Iterator[Piece]:
            for batch in batches:
                for at, texts in slices(texts_of(batch.column(1))):
                    n, ids = ids_of_words(texts, tokenizer, cache)
                    ends = np.cumsum(n).tolist()
                    for doc, to, k in zip(batch.column(0).slice(at, len(texts)).to_pylist(), ends, n.tolist()):
                        own = np.concatenate([ids[to - k:to], end])
                        yield Piece(doc, 0, own, k + 1)

        rows: list[tuple] = []
        lists: list[np.ndarray] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 7
            out = [pa.array(c, pa.int64()) for c in columns]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                out, names = [*out, pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))], [*names, "ids"]
            rows.clear()
            lists.clear()
            return pa.RecordBatch.from_arrays(out, names)

        for i, sequence in enumerate(pack_all(documents(), capacity)):
            offset = 0
            for p in sequence:
                rows.append((p.doc, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.total, first + i, offset))
                offset += len(p.ids)
                if with_ids:
                    lists.append(p.ids)
            if len(rows) >= ROWS_AT_ONCE:
                yield batch_of()
        yield batch_of()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(sequence_id, ids, n_tokens, padded_to)`` from pieces with ids; a group is one sequence, so at most ``capacity`` ids.

    A sequence whose length is a power of two stays as it is; any other one is to be padded to the capacity."""
    whole = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    n = F.size("ids")
    return (whole.select("sequence_id", F.flatten("parts.ids").alias("ids"))
            .select("sequence_id", "ids", n.alias("n_tokens"),
                    F.when(F.bit_count(n) == 1, n).otherwise(F.lit(capacity)).alias("padded_to")))


@query("op11_harmonic_packing")
def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by word_bpe_49k.json, packed into sequences of at most 4096 ids."""
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
