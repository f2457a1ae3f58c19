"""Operator 6, quality rules by distribution divergence.

A document is compared with references of its language: the distribution over character classes and the
distribution over common words, each by the Jensen-Shannon distance (base 2, so between 0 and 1).  The references
are counts over all documents.  Common words of a language are those with at least ``SUPPORT`` of all its words,
so there are at most ``1 / SUPPORT`` of them; languages with less than ``LANG_SHARE`` of the corpus' words use the
reference of all documents, so there are at most ``1 / LANG_SHARE`` references.  Both bounds make the broadcast
table small whatever the corpus.

Distances of short texts are mostly noise, falling with the root of the length: the limits are wider for short texts, and
texts under ``MIN_WORDS`` words are not judged by distance at all (they fail the base rules anyway).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.tables import table
from .arrow_text import distinct, segment_sums, slices, strings, texts_of, words
from .registry import query

SLICE = 2 << 20          # bytes of text that a task works on at once; a character takes some ten bytes there
SUPPORT = 0.002
LANG_SHARE = 0.001
MIN_WORDS = 50
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50
MAX_CLASS_DISTANCE = 0.20    # limits for long texts; STRAY / sqrt(words) is added
MAX_WORD_DISTANCE = 0.28
STRAY = 1.0
SYMBOLS = b"#*$%&|<>"
POOLED = ""    # the reference of all documents

# Character classes by first byte in UTF-8; continuation bytes are not counted.
CLASSES = ("lower", "upper", "digit", "space", "sentence", "symbol", "other_ascii", "beyond_ascii")


def _class_table() -> np.ndarray:
    t = np.full(256, CLASSES.index("other_ascii"), np.int64)
    t[ord("a"):ord("z") + 1] = CLASSES.index("lower")
    t[ord("A"):ord("Z") + 1] = CLASSES.index("upper")
    t[ord("0"):ord("9") + 1] = CLASSES.index("digit")
    t[list(b" \t\n\v\f\r")] = CLASSES.index("space")
    t[list(b".,;:!?'\"()-")] = CLASSES.index("sentence")
    t[list(SYMBOLS)] = CLASSES.index("symbol")
    t[0x80:0xC0] = -1
    t[0xC0:] = CLASSES.index("beyond_ascii")
    return t


_CLASS_OF = _class_table().astype(np.int8)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes of all texts, bytes per text)``."""
    n = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b"".join(x.as_buffer() for x in texts) if len(texts) else b""
    return np.frombuffer(joined, np.uint8), n


def class_counts(texts: pa.Array) -> np.ndarray:
    """Characters of each class in each text, one row per text."""
    data, n = _bytes_of(texts)
    kind = _CLASS_OF[data]
    cell = np.repeat(np.arange(len(n), dtype=np.int32) * len(CLASSES), n) + kind
    return np.bincount(cell[kind >= 0], minlength=len(n) * len(CLASSES)).reshape(len(n), -1)


def repeated_words(ids: np.ndarray) -> int:
    """Words covered by three-word windows that occur twice or more (first occurrences included)."""
    if len(ids) < 4:
        return 0
    base = int(ids.max()) + 1
    tri = (ids[:-2] * base + ids[1:-1]) * base + ids[2:] if base < 1 << 20 else \
        np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]]), axis=1, return_inverse=True)[1].ravel()
    _, index, n = np.unique(tri, return_inverse=True, return_counts=True)
    again = n[index] > 1
    cover = np.zeros(len(ids), bool)
    for k in range(3):
        cover[k:len(ids) - 2 + k] |= again
    return int(cover.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return len(lines) - len(set(lines))


def _js(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence, base 2) of each row of counts ``p`` from the row of ``q``;
    rows without counts are at distance 0."""
    sp, sq = p.sum(1, keepdims=True), q.sum(1, keepdims=True)
    p, q = p / np.maximum(sp, 1), q / np.maximum(sq, 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    d = np.sqrt(np.clip((a + b) / 2, 0, 1))
    return np.where((sp[:, 0] > 0) & (sq[:, 0] > 0), d, 0.0)


def references(docs: DataFrame, text: str = "text", lang: str = "lang",
               support: float = SUPPORT, lang_share: float = LANG_SHARE) -> dict[str, tuple[dict[str, int], np.ndarray, np.ndarray]]:
    """``{language: (position of each common word, word counts with the rest last, class counts)}`` over all texts,
    and the pooled reference under the empty name.  At most ``1 / support`` words for each of ``1 / lang_share``
    languages reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pc.fill_null(batch.column(1).cast(pa.string()), POOLED)
            for at, texts in slices(texts_of(batch.column(0)), SLICE):
                names, code = distinct(langs.slice(at, len(texts)))
                n, flat = words(texts, lower=True)
                kinds, index = distinct(flat)
                own = np.repeat(code.astype(np.int64), n)
                pair, times = np.unique(own * max(1, len(kinds)) + index, return_counts=True)
                classes = class_counts(texts)
                out_lang = [names.take(pa.array(pair // max(1, len(kinds)))).cast(pa.string())]
                out_word, out_n = [kinds.take(pa.array(pair % max(1, len(kinds)))).cast(pa.string())], [times]
                for c, name in enumerate(CLASSES):   # a class is a row whose word holds a space, which no word does
                    per = np.bincount(code, weights=classes[:, c], minlength=len(names)).astype(np.int64)
                    out_lang.append(names.cast(pa.string()))
                    out_word.append(pa.array([f" {name}"] * len(names)))
                    out_n.append(per)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(out_lang), pa.concat_arrays(out_word),
                                                  pa.array(np.concatenate(out_n), pa.int64())], ["lang", "word", "n"])

    counts = (docs.select(F.col(text), F.col(lang)).mapInArrow(count, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    checkpoint_dir(docs.sparkSession)
    counts = counts.checkpoint(eager=True)
    is_class = F.startswith("word", F.lit(" "))
    totals = counts.where(~is_class).groupBy("lang").agg(F.sum("n").alias("total"))
    corpus = totals.agg(F.sum("total")).first()[0] or 0
    held = totals.where(F.col("total") >= F.lit(lang_share * corpus)) if corpus else totals.limit(0)
    common = (counts.where(~is_class).join(F.broadcast(held), "lang")
              .where(F.col("n") >= F.lit(support) * F.col("total")).select("lang", "word", "n", "total"))
    pooled = (counts.where(~is_class).groupBy("word").agg(F.sum("n").alias("n"))
              .where(F.col("n") >= F.lit(max(1.0, support * corpus)))
              .select(F.lit(POOLED).alias("lang"), "word", "n", F.lit(corpus).alias("total")))
    of_class = counts.where(is_class)
    classes = (of_class.join(F.broadcast(held), "lang").select("lang", "word", "n", "total")
               .unionByName(of_class.groupBy("word").agg(F.sum("n").alias("n"))
                            .select(F.lit(POOLED).alias("lang"), "word", "n", F.lit(corpus).alias("total"))))
    found: dict[str, dict[str, int]] = {}
    total: dict[str, int] = {}
    kinds: dict[str, np.ndarray] = {}
    for r in common.where(F.col("lang") != POOLED).unionByName(pooled).collect():
        found.setdefault(r["lang"], {})[r["word"]] = r["n"]
        total[r["lang"]] = r["total"]
    for r in classes.where(F.col("lang") != POOLED).unionByName(classes.where(F.col("lang") == POOLED)
                                                               .groupBy("lang", "word").agg(F.max("n").alias("n"), F.max("total").alias("total"))).collect():
        kinds.setdefault(r["lang"], np.zeros(len(CLASSES)))[CLASSES.index(r["word"][1:])] = r["n"]
        total.setdefault(r["lang"], r["total"])
    out = {}
    for name in {POOLED, *kinds}:
        own = found.get(name, {})
        order = sorted(own)
        rest = total.get(name, 0) - sum(own.values())
        out[name] = ({w: i for i, w in enumerate(order)}, np.array([*(own[w] for w in order), rest], float),
                     kinds.get(name, np.zeros(len(CLASSES))))
    return out


def _word_distances(texts: pa.Array, names: list[str], refs: dict) -> np.ndarray:
    """Word distance of each text from the reference of its language."""
    n, flat = words(texts, lower=True)
    kinds, index = distinct(flat)
    own = np.repeat(np.arange(len(texts)), n)
    out, kind_list = np.zeros(len(texts)), strings(kinds)
    which = np.array([x if x in refs else POOLED for x in names], object)
    for name in set(which.tolist()):
        place, ref, _ = refs[name]
        column = np.fromiter((place.get(w, len(place)) for w in kind_list), np.int64, len(kind_list))
        mine = which == name
        row_of = np.cumsum(mine) - 1
        at = mine[own]
        wide = len(ref)
        counts = np.bincount(row_of[own[at]] * wide + column[index[at]], minlength=int(mine.sum()) * wide).reshape(-1, wide)
        out[mine] = _js(counts.astype(float), np.broadcast_to(ref, counts.shape))
    return out


def class_limit(n_words: np.ndarray) -> np.ndarray:
    """Largest class distance of a kept text; short texts stray more."""
    return MAX_CLASS_DISTANCE + STRAY / np.sqrt(np.maximum(n_words, 1))


def word_limit(n_words: np.ndarray) -> np.ndarray:
    """Largest word distance of a kept text."""
    return MAX_WORD_DISTANCE + STRAY / np.sqrt(np.maximum(n_words, 1))


def judged(texts: pa.Array, langs: list[str], refs: dict) -> dict[str, np.ndarray]:
    """Counts, distances and verdict of each text, by column name."""
    n, flat = words(texts, lower=False)
    _, index = distinct(flat)
    ends = np.cumsum(n)
    repeats = np.array([repeated_words(np.unique(index[e - k:e], return_inverse=True)[1].astype(np.int64))
                        for e, k in zip(ends.tolist(), n.tolist())], np.int64)
    classes = class_counts(texts)
    has_lines = pc.match_substring(texts, "\n").to_numpy(zero_copy_only=False)
    lines = np.array([duplicate_lines(t.as_py()) if x else 0 for t, x in zip(texts, has_lines)], np.int64)
    of_lang = np.array([refs[x if x in refs else POOLED][2] for x in langs]).reshape(len(langs), -1)
    by_class = _js(classes.astype(float), of_lang) if len(langs) else np.zeros(0)
    by_word = _word_distances(texts, langs, refs)
    failed = (n < BASE_MIN_WORDS) | (100 * repeats > BASE_MAX_REPEAT_PERCENT * n)
    far = (n >= MIN_WORDS) & ((by_class > class_limit(n)) | (by_word > word_limit(n)))
    return {"n_words": n.astype(np.int64), "word_chars": segment_sums(pc.utf8_length(flat).to_numpy(zero_copy_only=False), n).astype(np.int64),
            "n_symbols": classes[:, CLASSES.index("symbol")].astype(np.int64), "n_dup_lines": lines, "n_repeat_words": repeats,
            "base_failed": failed, "kept": ~failed & ~far, "class_distance": by_class, "word_distance": by_word}


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts, distances and verdict of every row's whole text.

    Null or empty texts have no words and fail the base rules.  A null or rare language uses the reference of all
    documents.  Repeated rows are judged alike, each in a row of its own; other columns are not read; an empty table
    gives an empty table.
    """
    refs = docs.sparkSession.sparkContext.broadcast(references(docs, text, lang))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pc.fill_null(batch.column(2), POOLED)
            for at, texts in slices(texts_of(batch.column(1)), SLICE):
                out = judged(texts, langs.slice(at, len(texts)).to_pylist(), refs.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *[pa.array(out[c]) for c in NAMES[1:]]], NAMES)

    return (docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"), F.col(lang).cast("string"))
            .mapInArrow(judge, SCHEMA))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the rules keep."""
    refs = docs.sparkSession.sparkContext.broadcast(references(docs, text, lang))
    at_text, at_lang = docs.columns.index(text), docs.columns.index(lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pc.fill_null(batch.column(at_lang).cast(pa.string()), POOLED)
            for at, texts in slices(texts_of(batch.column(at_text)), SLICE):
                kept = judged(texts, langs.slice(at, len(texts)).to_pylist(), refs.value)["kept"]
                yield batch.slice(at, len(texts)).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
         "class_distance", "word_distance"]
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, class_distance double, word_distance double")


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"))
