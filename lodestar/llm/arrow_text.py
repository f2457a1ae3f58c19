"""Whole texts as Arrow columns inside tasks: bounded slices, words, ragged gathers.

The helpers work on one slice of a few MB at a time (one document at least), so a task's memory
does not depend on the size of its partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
# Characters that are white space to Python or to a tokenizer's \s; a space before one of them, or before the
# end of the text, does not start a word of its own.
_SPACE_RUN = r" (?:[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"


def texts_of(column: pa.Array) -> pa.Array:
    """The column as strings, nulls as empty texts."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """``(first row, rows)`` cut so that each slice holds about ``limit`` bytes, one row at least."""
    if len(texts) == 0:
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, texts.slice(at, to - at)
        at = to
    give_back()


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):   # another C library
        return None


def give_back() -> None:
    """Return freed memory to the system; a worker serves many tasks, and what one of them needed at most would stay with it."""
    pa.default_memory_pool().release_unused()
    if (trim := _trim()) is not None:
        trim(0)


def has_space_runs(texts: pa.Array) -> np.ndarray:
    """Rows where some space is followed by white space or ends the text, or the text starts with one."""
    return pc.or_(pc.match_substring_regex(texts, _SPACE_RUN), pc.starts_with(texts, " ")).to_numpy(zero_copy_only=False)


def split_spaces(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``(offsets, pieces)`` of the texts split at every single space; an empty text has one empty piece."""
    parts = pc.split_pattern(texts, " ")
    return parts.offsets.to_numpy() - parts.offsets[0].as_py(), parts.flatten()


def distinct(pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``(distinct pieces, position of each piece among them)``."""
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def strings(pieces: pa.Array) -> list[str]:
    """The pieces as Python strings (much faster than one Arrow scalar at a time)."""
    return pieces.to_numpy(zero_copy_only=False).tolist()


def words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, pa.Array]:
    """``(words per text, words)``: maximal runs without space, \\t, \\n, \\v, \\f, \\r; A-Z lower-cased if asked."""
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    flat = parts.flatten()
    kept = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(kept)])
    return np.diff(before[offsets]), flat.filter(pa.array(kept))


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each consecutive group of ``counts[i]`` values; 0 for empty groups."""
    ends = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    at = np.concatenate([[0], np.cumsum(counts)])
    return ends[at[1:]] - ends[at[:-1]]


def ragged_take(pool: np.ndarray, starts: np.ndarray, lens: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The pool's rows ``index`` (row i is ``pool[starts[i]:starts[i] + lens[i]]``) one after another."""
    n = lens[index].astype(np.int64)
    total = int(n.sum())
    if not total:
        return pool[:0]
    at = np.repeat(starts[index] - (np.cumsum(n) - n), n)
    at += np.arange(total, dtype=at.dtype)
    return pool[at]


class PieceCache:
    """Codes of distinct pieces: from a fixed table, else from what the worker holds, else encoded.

    ``held`` may outlive a task, as a worker serves many; it takes new pieces until it has ``cap`` of them, so its
    memory is bounded, and the frequent pieces, which come first, stay."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], held: dict[str, bytes] | None = None,
                 cap: int = 1_000_000, longest: int = 64, fixed: dict[str, bytes] | None = None):
        self.encode, self.cap, self.longest, self.fixed = encode, cap, longest, fixed or {}
        self.held: dict[str, bytes] = {} if held is None else held

    def codes(self, pieces: list[str]) -> list[bytes]:
        """One code for each of the (distinct) pieces."""
        fixed, held = self.fixed, self.held
        if fixed:
            out = [fixed.get(x) or held.get(x) for x in pieces]
        else:
            out = list(map(held.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        if missing:
            new = self.encode([pieces[i] for i in missing])
            room = self.cap - len(held)
            for i, code in zip(missing, new):
                out[i] = code
                if room > 0 and len(pieces[i]) <= self.longest:
                    held[pieces[i]] = code
                    room -= 1
        return out
