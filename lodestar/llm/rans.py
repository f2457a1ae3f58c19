"""Range asymmetric numeral system over a static table, interleaved lanes, numpy throughout.

A block's ids are dealt to ``lanes`` coder states round robin (id i to lane ``i % lanes`` in step
``i // lanes``), so one numpy operation advances all lanes by one id.  States are 64-bit, words 32-bit.  Encoding runs
backwards; before every ``every``-th step the decoder's states and its place in the words are kept as a checkpoint,
so the stretches between checkpoints decode independently of each other.

Block layout (little-endian): magic, version, lanes, steps between checkpoints, number of ids, number of words,
number of checkpoints, word place of each checkpoint, states of each checkpoint, words, crc32 of all before it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BITS = 20                       # frequencies add up to 2^BITS
LOW = np.uint64(1 << 31)        # states stay in [2^31, 2^63)
WORD = np.uint64(32)
MASK = np.uint64(0xFFFFFFFF)
HEADER = struct.Struct("<4sHHIQQI")
MAGIC = b"LRAN"
LANES = 2048
EVERY = 128


class Table:
    """Shared frequencies of ids, made from counts; every counted id keeps a frequency of one at least."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids, kind="stable")
        ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.float64)[order]
        if len(ids) > 1 << BITS:
            raise ValueError("more ids than frequency slots")
        size = int(ids[-1]) + 1 if len(ids) else 1
        freq = np.maximum(1, np.floor(counts * ((1 << BITS) / max(1.0, counts.sum())))).astype(np.int64)
        if len(ids):
            spare = (1 << BITS) - int(freq.sum())
            if spare >= 0:
                freq[np.argmax(freq)] += spare
            for i in np.argsort(-freq, kind="stable"):   # too many ones: the largest give way
                if spare >= 0:
                    break
                cut = min(-spare, int(freq[i]) // 2)
                freq[i] -= cut
                spare += cut
        self.freq = np.zeros(size, np.uint64)
        self.freq[ids] = freq.astype(np.uint64)
        start = np.concatenate([[0], np.cumsum(freq)])[:-1] if len(ids) else np.zeros(0)
        self.start = np.zeros(size, np.uint64)
        self.start[ids] = start.astype(np.uint64)
        self.id_at = np.repeat(ids, freq).astype(np.uint32)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    """One block."""
    n = len(ids)
    lanes = max(1, min(lanes, n // 64 or 1))
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    freq, start = table.freq[ids], table.start[ids]
    words: list[np.ndarray] = []
    states: list[np.ndarray] = []
    behind: list[int] = []
    total = 0
    shift = np.uint64(63 - BITS)
    bits = np.uint64(BITS)
    for t in range(steps - 1, -1, -1):
        f, s = freq[t * lanes:(t + 1) * lanes], start[t * lanes:(t + 1) * lanes]
        y = x[:len(f)]
        full = y >= (f << shift)
        if full.any():
            out = (y[full] & MASK).astype("<u4")
            words.append(out)
            total += len(out)
            y[full] >>= WORD
        q = y // f
        x[:len(f)] = (q << bits) + (y - q * f) + s
        if t % every == 0:
            states.append(x.copy())
            behind.append(total)
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    place = [total - b for b in reversed(behind)]
    head = HEADER.pack(MAGIC, 1, lanes, every, n, len(stream), len(place))
    body = b"".join([head, np.array(place, "<u8").tobytes(), *[s.astype("<u8").tobytes() for s in reversed(states)], stream.tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table) -> np.ndarray:
    """Ids of a block; each stretch between checkpoints is decoded from its own checkpoint."""
    body, (crc,) = block[:-4], struct.unpack("<I", block[-4:])
    if zlib.crc32(body) != crc:
        raise ValueError("block checksum does not fit")
    magic, version, lanes, every, n, n_words, n_places = HEADER.unpack_from(body)
    if magic != MAGIC or version != 1:
        raise ValueError("not a block of this format")
    at = HEADER.size
    place = np.frombuffer(body, "<u8", n_places, at)
    at += 8 * n_places
    states = np.frombuffer(body, "<u8", n_places * lanes, at).reshape(n_places, lanes)
    at += 8 * n_places * lanes
    words = np.frombuffer(body, "<u4", n_words, at)
    out = np.empty(n, np.uint32)
    for c in range(n_places):
        _stretch(out, c * every, min((c + 1) * every, -(-n // lanes)), lanes, states[c].astype(np.uint64), words, int(place[c]), table)
    return out


def _stretch(out, first, last, lanes, x, words, at, table) -> None:
    bits, mask = np.uint64(BITS), np.uint64((1 << BITS) - 1)
    n = len(out)
    for t in range(first, last):
        k = min(lanes, n - t * lanes)
        y = x[:k]
        slot = y & mask
        ids = table.id_at[slot]
        out[t * lanes:t * lanes + k] = ids
        y = table.freq[ids] * (y >> bits) + slot - table.start[ids]
        low = y < LOW
        m = int(np.count_nonzero(low))
        if m:
            y[low] = (y[low] << WORD) | words[at:at + m]
            at += m
        x[:k] = y
