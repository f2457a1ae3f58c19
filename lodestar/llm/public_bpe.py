"""Ids of whole texts by a byte-level BPE of the tokenizers library, one distinct pre-token at a time.

The library's pattern never joins across a space that is followed by a character other than white
space: such a space opens a new pre-token.  So a text's ids are those of its pieces between such spaces
(each with its leading space), whatever the piece holds, and special strings, which hold no space and which
the library takes out first, stay whole inside a piece.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .arrow_text import PieceCache, distinct, has_space_runs, ragged_take, segment_sums, split_spaces, strings

# A piece: an optional space, then anything up to a space before a character other than white space.
PIECE = re.compile(r" ?(?:[^ ]+| (?![^\s\x85\u180e\u200b]))+")


@lru_cache(maxsize=4)
def load(path: str):
    """The library's tokenizer, once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=8)
def held(path: str, kind: str) -> dict[str, bytes]:
    """What this worker has encoded so far."""
    return {}


AT_ONCE = 2000   # pieces that are encoded in one call


@lru_cache(maxsize=4)
def _byte_level(path: str) -> bool:
    """Whether the tokenizer is a plain byte-level BPE: texts as they are, the library's ByteLevel pattern, its BPE model."""
    t = load(path)
    if t.normalizer is not None or t.pre_tokenizer is None or type(t.model).__name__ != "BPE" or t.model.dropout:
        return False
    how = json.loads(t.pre_tokenizer.__getstate__())
    return how.get("type") == "ByteLevel" and not how.get("add_prefix_space") and how.get("use_regex", True)


@lru_cache(maxsize=1)
def _pre_tokens() -> re.Pattern:
    """Pre-tokens of a piece by the ByteLevel pattern of the library, over settled characters only; others are left out.

    Settled are the space, the line feed, and letters, numbers and other visible characters of the basic plane that Unicode 3.2 knew
    as such already, so every later version of its tables, the library's among them, agrees."""
    old = unicodedata.ucd_3_2_0
    kinds: dict[str, list[int]] = {"L": [], "N": [], "other": []}
    for c in range(0x21, 0xD800):
        kind = unicodedata.category(chr(c))[0]
        if kind == old.category(chr(c))[0] and kind in "LNMPS":
            kinds[kind if kind in "LN" else "other"].append(c)

    def ranges(chars: list[int]) -> str:
        ends = [i for i in range(len(chars)) if i + 1 == len(chars) or chars[i + 1] > chars[i] + 1]
        return "".join(f"\\u{chars[i]:04x}-\\u{chars[j]:04x}" for i, j in zip([0, *(e + 1 for e in ends)], ends))

    letter, number, other = (ranges(kinds[k]) for k in ("L", "N", "other"))
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[{other}]+|[ \\n]+(?![^ \\n])|[ \\n]+")


@lru_cache(maxsize=1)
def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if visible, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}


HELD_PRE_TOKENS = 300_000   # in a worker


def _by_model(path: str, pieces: list[str]) -> list[bytes | None]:
    """Ids of each piece of settled characters, by the library's model; None for the others."""
    split, tokenize, shown, known = _pre_tokens().findall, load(path).model.tokenize, _byte_characters(), held(path, "pre-tokens")
    out: list[bytes | None] = []
    for piece in pieces:
        codes, size = [], 0
        for w in split(piece):
            size += len(w)
            code = known.get(w)
            if code is None:
                as_bytes = w.replace(" ", shown[32]).replace("\n", shown[10]) if w.isascii() else w.encode().decode("latin-1").translate(shown)
                ids = [x.id for x in tokenize(as_bytes)]
                code = struct.pack(f"<{len(ids)}I", *ids)
                if len(known) < HELD_PRE_TOKENS:
                    known[w] = code
            codes.append(code)
        out.append(None if size != len(piece) else codes[0] if len(codes) == 1 else b"".join(codes))
    return out


def encode_pieces(path: str, pieces: list[str]) -> list[bytes]:
    """Ids of each piece as little-endian unsigned 32-bit integers.

    Pieces of a byte-level BPE that hold common characters only go to the library's model by their pre-tokens.  Of the others many are encoded
    at once, parted by a special string: the library takes that out first, so the pieces stay apart, and its id parts theirs."""
    t = load(path)
    specials = t.get_added_tokens_decoder()
    if _byte_level(path):
        whole = "\n".join(pieces)
        held_specials = [x.content for x in specials.values() if x.content in whole]
        out = _by_model(path, pieces)
        rest = [i for i, x in enumerate(out) if x is None or held_specials and any(s in pieces[i] for s in held_specials)]
        for i, code in zip(rest, _encode_parted(path, [pieces[i] for i in rest])):
            out[i] = code
        return out
    return _encode_parted(path, pieces)


def _encode_parted(path: str, pieces: list[str]) -> list[bytes]:
    t = load(path)
    specials = t.get_added_tokens_decoder()
    parting = next(((i, x.content) for i, x in specials.items()
                    if not (x.lstrip or x.rstrip or x.single_word or x.normalized) and t.encode(x.content, add_special_tokens=False).ids == [i]), None)
    own = [not parting] * len(pieces)
    whole = "\n".join(pieces)
    if parting and any(x.content in whole for x in specials.values()):
        own = [any(x.content in p for x in specials.values()) for p in pieces]
    out = [b""] * len(pieces)
    alone = [i for i, x in enumerate(own) if x]
    for i, got in zip(alone, t.encode_batch_fast([pieces[i] for i in alone], add_special_tokens=False)):
        out[i] = np.array(got.ids, "<u4").tobytes()
    rest = [i for i, x in enumerate(own) if not x]
    for at in range(0, len(rest), AT_ONCE):
        some = rest[at:at + AT_ONCE]
        ids = np.array(t.encode_batch_fast([parting[1].join(pieces[i] for i in some)], add_special_tokens=False)[0].ids, "<u4")
        cut = (4 * np.flatnonzero(ids == parting[0])).tolist()
        data = ids.tobytes()
        for i, start, end in zip(some, [0, *[c + 4 for c in cut]], [*cut, len(data)]):
            out[i] = data[start:end]
    return out


def encode_lengths(path: str, pieces: list[str]) -> list[bytes]:
    """Number of ids of each piece, as 4 bytes."""
    return [(len(x) // 4).to_bytes(4, "little") for x in encode_pieces(path, pieces)]


def _special_strings(path: str) -> list[str]:
    return [t.content for t in load(path).get_added_tokens_decoder().values()]


def _plain_pieces(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Pieces of texts without runs of white space: cut at every space, which stays in front."""
    offsets, flat = split_spaces(texts)
    spaced = np.ones(len(flat), bool)
    spaced[offsets[:-1]] = False
    lead = pc.if_else(pa.array(spaced), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    return np.diff(offsets), pc.binary_join_element_wise(lead, flat, pa.scalar("", pa.large_string()))


def _split(texts: pa.Array, path: str) -> tuple[np.ndarray, pa.Array]:
    """``(pieces per text, pieces)``, each piece with its leading space.

    Texts with runs of white space are cut by ``PIECE``; texts that hold a special string are one piece."""
    whole = np.zeros(len(texts), bool)
    for s in _special_strings(path):
        whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
    odd = has_space_runs(texts) | whole
    if not odd.any():
        return _plain_pieces(texts)
    order = np.argsort(odd, kind="stable")
    plain, rest = order[: int((~odd).sum())], order[int((~odd).sum()):]
    n1, p1 = _plain_pieces(texts.take(pa.array(plain)))
    lists = [[t] if w else PIECE.findall(t) for t, w in zip(texts.take(pa.array(rest)).to_pylist(), whole[rest])]
    n2 = np.array([len(x) for x in lists], np.int64)
    flat = pa.concat_arrays([p1, pa.array([y for x in lists for y in x], pa.large_string())])
    counts, starts, n = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64), np.concatenate([n1, n2])
    counts[order], starts[order] = n, np.cumsum(n) - n
    at = ragged_take(np.arange(len(flat)), starts, counts, np.arange(len(texts)))
    return counts, flat.take(pa.array(at))


def count_ids(texts: pa.Array, path: str, cache: PieceCache) -> np.ndarray:
    """Number of ids of every text; ``cache`` holds lengths (``encode_lengths``)."""
    counts, flat = _split(texts, path)
    table, index = distinct(flat)
    lens = np.frombuffer(b"".join(cache.codes(strings(table))), "<u4").astype(np.int64)
    return segment_sums(lens[index], counts)


def ids_of(texts: pa.Array, path: str, cache: PieceCache) -> tuple[np.ndarray, np.ndarray]:
    """``(ids per text, ids)`` of all texts; ``cache`` holds ids (``encode_pieces``)."""
    counts, flat = _split(texts, path)
    table, index = distinct(flat)
    codes = cache.codes(strings(table))
    lens = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
    pool = np.frombuffer(b"".join(codes), "<u4")
    ids = ragged_take(pool, np.cumsum(lens) - lens, lens, index)
    return segment_sums(lens[index], counts), ids
