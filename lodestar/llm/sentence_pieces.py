"""Operator 3, SentencePiece encoding and decoding over a table of distinct marked words.

In this model no piece holds the white-space marker behind another character, so no merge crosses from
one word into the next word's marker, and a text's ids are the ids of its marked words one after another
(checked when the model is loaded; a model with crossing pieces is encoded text by text).  Each task keeps
distinct words of its texts in a table, segments each of them once, and joins the ids back by position
with one gather per slice of texts.  Words are not shuffled: a table of all words with their positions would
be several times the size of the input.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .arrow_text import PieceCache, distinct, ragged_take, segment_sums, slices, split_spaces, strings, texts_of
from .registry import query

MARK = "▁"
HELD_WORDS = 100_000   # distinct words that a task keeps
SLICE = 1 << 20
# A marked word: its markers and what follows up to the next marker, or markers that end the text.
MARKED_WORD = re.compile(f"{MARK}+[^{MARK}]*")


@lru_cache(maxsize=4)
def load(path: str):
    """``(processor, whether words are independent)``, once per worker."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    apart = not any(re.search(f"[^{MARK}]{MARK}", sp.id_to_piece(i)) for i in range(n))
    # Words stand alone only if spaces become markers one for one and a first marker is added.
    probe = sp.encode("a  b ", out_type=str)
    return sp, apart and "".join(probe) == f"{MARK}a{MARK}{MARK}b{MARK}"


def encode_words(path: str, words: list[str]) -> list[bytes]:
    """Ids (unsigned 32-bit, little-endian) of marked words, each given without its first marker."""
    sp, _ = load(path)
    got = sp.encode(words, num_threads=1)
    alone = [sp.piece_to_id(MARK)]
    return [np.array(ids if w else alone, "<u4").tobytes() for w, ids in zip(words, got)]


def encode_texts(texts: pa.Array, path: str, cache: PieceCache) -> tuple[np.ndarray, np.ndarray]:
    """``(ids per text, ids)`` of all texts, without begin and end ids."""
    sp, apart = load(path)
    if not apart:
        lists = sp.encode(texts.to_pylist(), num_threads=1)
        return (np.array([len(x) for x in lists], np.int64),
                np.array([i for x in lists for i in x], "<u4"))
    # Runs of spaces, spaces at an end and literal markers: cut by the pattern; else at every space.
    odd = pc.or_(pc.match_substring_regex(texts, f"  |^ | $|{MARK}"), pc.equal(pc.binary_length(texts), 0))
    odd = odd.to_numpy(zero_copy_only=False)
    order = np.argsort(odd, kind="stable")
    plain, rest = order[: int((~odd).sum())], order[int((~odd).sum()):]
    offsets, flat = split_spaces(texts.take(pa.array(plain)))
    lists = [[w[1:] for w in MARKED_WORD.findall(MARK + t.replace(" ", MARK))] if t else []
             for t in texts.take(pa.array(rest)).to_pylist()]
    flat = pa.concat_arrays([flat, pa.array([w for x in lists for w in x], pa.large_string())])
    n = np.concatenate([np.diff(offsets), np.array([len(x) for x in lists], np.int64)]).astype(np.int64)
    counts, starts = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
    counts[order], starts[order] = n, np.cumsum(n) - n
    words, index = distinct(flat)
    codes = cache.codes(strings(words))
    lens = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
    pool = np.frombuffer(b"".join(codes), "<u4")
    index = ragged_take(index, starts, counts, np.arange(len(texts)))
    ids = ragged_take(pool, np.cumsum(lens) - lens, lens, index)
    return segment_sums(lens[index], counts), ids


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded])`` of every row's whole text.

    Ids carry the begin and end ids; the decoded text is the library's ``decode`` of them.  A null text is empty:
    two ids, decoded to the empty text.  Repeated rows and null ids stay rows of their own; other columns are
    not read; an empty table gives an empty table.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, _ = load(path)
        begin, end = np.array([sp.bos_id()], "<u4"), np.array([sp.eos_id()], "<u4")
        cache = PieceCache(lambda xs: encode_words(path, xs), cap=HELD_WORDS)   # goes with the task
        for batch in batches:
            for at, texts in slices(texts_of(batch.column(1)), SLICE):
                counts, ids = encode_texts(texts, path, cache)
                ends = np.cumsum(counts)
                digests, decoded, lists, plain = [], [], [], []
                for e, k in zip(ends.tolist(), counts.tolist()):
                    own = np.concatenate([begin, ids[e - k:e], end])
                    digests.append(hashlib.sha256(own.tobytes()).hexdigest())
                    back = sp.decode(own.tolist())
                    decoded.append(hashlib.sha256(back.encode()).hexdigest())
                    if with_ids:
                        lists.append(own)
                        plain.append(back)
                out = [batch.column(0).slice(at, len(texts)), pa.array(counts + 2, pa.int64()), pa.array(digests, pa.string()),
                       pa.array(decoded, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], np.cumsum(counts + 2)]), pa.int32())
                    out += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(lists).astype(np.int32))), pa.array(plain, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(code, schema)


@query("op3_sentence_pieces")
def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through piece_bpe_32k.model and back."""
    import public_tokenizers
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
