"""Packing, periodic runs and alignment against brute force, on nulls, empty and long texts, repeated rows, missing ids and extra columns."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest

import public_tokenizers
from lodestar.llm import alignment, packing, periodic_runs

WORDS = public_tokenizers.path("word_bpe_49k.json")
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, length int, start string, sequence_id int, ids string, pair long, n int, _gone int"


def _texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["the", "an", "er", "on", "ti", "é", "ß", "X", "'s", "1"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    odd = [None, "", " ", "   ", "  two  spaces ", "tab\tand\nline \n more", "x<|endoftext|> y  <|endoftext|>z <|StartOfText|>", "▁mark ▁▁ end  ", "a ▁b",
           "日本語 テキスト です", "a\x00b \x85 c\x1cd\x0be\x0cf \x1f g", "é ́x Å ﬁ", "<0x41> </s> <s>", "e" * 5000, " " * 999, "\n" * 50, "it's  we'll"]
    runs = ["a b " * 40, "a " * 500, "x a b c a b c a b c a b c a y", ("a b a c " * 5 + "z ") * 6, "q " * 5, "q " * 6, "a b a b a b a b", "b a b a b a b",
            " ".join(rng.choice("ab") for _ in range(700)), " ".join(rng.choice("aab") for _ in range(300)) + " c c c c c c"]
    return [*odd, *runs, *(prose(rng.randint(1, 400)) for _ in range(60)), prose(30_000)]


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7, "s", 1, "i", 3, 4, 2) for i, t in enumerate(TEXTS)] + [(None, "one two one two", None, None, None, None, None, None, None), (None, "one two one two", 1, "", 2, "", 3, 4, 5)]
    rows += [(20, TEXTS[20], 1, "", 2, "", 3, 4, 5)] * 2
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- packing

def _word_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_keeps_every_id_once(docs, empty, capacity):
    got = packing.pack(docs, WORDS, capacity, with_ids=True)
    pieces = got.collect()
    by_sequence: dict = {}
    for r in pieces:
        assert r["length"] == len(r["ids"]) > 0 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own[:-1])]).tolist()
        n = sum(r["length"] for r in own)
        assert n == capacity or n & (n - 1) == 0 and n < capacity   # nothing is padded
    want = Counter((i, *_word_ids(x)) for i, x in _rows(docs))
    # Documents with an id that stands once come back from their pieces.
    parts: dict = {}
    for r in pieces:
        parts.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
    for i in range(len(TEXTS)):
        if i != 20:
            ids = [t for _, own, _ in sorted(parts[i]) for t in own]
            assert want[(i, *ids)] == 1 and all(n == len(ids) for *_, n in parts[i])
    assert sum(r["length"] for r in pieces) == sum((len(k) - 1) * n for k, n in want.items())
    assert Counter((r["doc_id"], t) for r in pieces for t in r["ids"]) == Counter((k[0], t) for k, n in want.items() for t in k[1:] for _ in range(n))
    whole = packing.sequences(got, capacity).collect()
    assert len(whole) == len(by_sequence) and all(r["n_tokens"] == len(r["ids"]) == r["padded_to"] for r in whole)
    assert packing.pack(empty, WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, WORDS, 1000)


def test_classes_hold_a_fixed_number_of_documents():
    piece = lambda i, n: packing.Piece(i, 0, np.zeros(n, "<u4"), n)
    packer = packing.Packer(64)
    assert [len(s) for i in range(9) for s in packer.add(piece(i, 16))] == [4, 4]
    assert list(packer.add(piece(9, 40))) == [] and packer.gaps == 24         # class 1: a bin of one, its gap waits
    assert [[p.doc for p in s] for s in packer.add(piece(10, 24))] == [[9, 10]]
    assert [sum(len(p.ids) for p in s) for s in packer.end()] == [16]


@pytest.mark.parametrize("seed", range(6))
def test_packing_of_many_lengths(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 21, 22, 40, 63, 64, 65, rng.randint(1, 300)]) for _ in range(rng.randint(0, 800))]
    if seed == 0:
        sizes = [22] * 500    # every full bin has a gap
    out = list(packing.pack_all((packing.Piece(i, 0, np.arange(n, dtype="<u4"), n) for i, n in enumerate(sizes)), 64))
    assert all((n := sum(len(p.ids) for p in s)) == 64 or (n & (n - 1)) == 0 for s in out)
    assert sum(sum(len(p.ids) for p in s) < 64 for s in out) <= 6
    back: dict = {}
    for s in out:
        for p in s:
            back.setdefault(p.doc, []).append((p.start, p.ids.tolist()))
    assert [[t for _, own in sorted(back[i]) for t in own] for i in range(len(sizes))] == [list(range(n)) for n in sizes]


# ---------------------------------------------------------------- periodic runs

def _brute_runs(words):
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k > i and k + q - i >= max(6, 4 * q):
                out.setdefault((i, k + q - i), q)
            i = max(k, i) + 1
    return sorted((s, m, q) for (s, m), q in out.items())


def _brute_row(doc, text, planted):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    n = len(words)
    h = zlib.crc32(str(doc).encode())
    if planted and doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _brute_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.mark.parametrize("planted", [False, True])
def test_periodic_runs(docs, empty, planted):
    some = docs.where("text is null or length(text) < 20000")
    got = periodic_runs.periodic_runs(some, rewrite=periodic_runs.seeded_repeats if planted else None).collect()
    want = [_brute_row(i, x, planted) for i, x in _rows(some)]
    assert Counter(map(tuple, got)) == Counter(want) and sum(r["n_runs"] for r in got) > 20
    assert periodic_runs.periodic_runs(empty).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_random_strings(seed):
    rng = random.Random(seed)
    lists = []
    for _ in range(rng.randint(1, 12)):
        kind = rng.randint(0, 3)
        n = rng.choice([0, 1, 5, 6, 40, 200])
        w = [rng.randint(1, [1, 2, 3, 9][kind]) for _ in range(n)]
        if n and rng.random() < 0.6:
            p, a = rng.randint(1, max(1, n // 5)), rng.randrange(n)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        lists += [w] * rng.choice([1, 1, 2])
    flat = np.array([x for w in lists for x in w], np.int64)
    got = periodic_runs.runs_of(flat, np.array([len(w) for w in lists], np.int64)).tolist()
    assert [tuple(r) for r in got] == [(i, *r) for i, w in enumerate(lists) for r in _brute_runs(w)]


@pytest.mark.parametrize("seed", range(8))
def test_extensions_of_the_grammar(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(1, 1 + rng.choice([1, 2, 30]), rng.choice([1, 50, 400])) for _ in range(5)]
    docs += [np.tile(docs[0], 5), docs[1], docs[2]]
    letters = np.concatenate([np.concatenate([[0], d]) for d in docs] + [[0]])
    levels = periodic_runs.grammar(letters)
    x, y = rng.integers(0, len(letters), 500), rng.integers(0, len(letters), 500)
    differ = x != y
    x, y = x[differ], y[differ]
    for forward in (True, False):
        step = 1 if forward else -1
        got = periodic_runs.extensions(levels, x, y, forward)
        for a, b, k in zip(x.tolist(), y.tolist(), got.tolist()):
            n = 0
            while letters[a] == letters[b] != 0:
                a, b, n = a + step, b + step, n + 1
            assert k == n


# ---------------------------------------------------------------- alignment

@lru_cache
def _tables():
    from tokenizers import Tokenizer
    import sentencepiece
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    back, extra = {chr(b): b for b in printable}, 0
    for b in range(256):
        if b not in printable:
            back[chr(256 + extra)] = b
            extra += 1
    return t, back, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def _brute_align(text):
    t, back, sp = _tables()
    if not text:
        return None
    a = [(i, bytes(back[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in sp.encode(text):
        piece = sp.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return None
    ends = lambda side: np.cumsum([len(x) for _, x in side]).tolist()
    cuts = sorted(set(ends(a)) & set(ends(b)))
    groups = [([], []) for _ in cuts]
    for k, side in enumerate((a, b)):
        at = 0
        for (i, _), e in zip(side, ends(side)):
            groups[at][k].append(i)
            at += e == cuts[at]
    return len(a), len(b), groups


def _brute_corpus(rows):
    got = [_brute_align(x) for _, x in rows]
    links = [Counter((a, b) for own in (g[2] if g else []) for a in own[0] for b in own[1]) for g in got]
    count = Counter(p for own in links for p in own)
    most: dict = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (i, _), g, own in zip(rows, got, links):
        if g is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g[2])
        out.append((i, g[0], g[1], len(g[2]), sum(own.values()), sum(n for p, n in own.items() if count[p] == most[p[0]]),
                    sum(n * count[p] for p, n in own.items()), hashlib.sha256(said.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("common", [alignment.COMMON, 50, 0])
def test_alignment(docs, empty, common):
    got = alignment.align(docs, BPE, PIECES, common=common).collect()
    assert Counter(map(tuple, got)) == _brute_corpus(_rows(docs))
    if common == 50:
        none = alignment.align(empty, BPE, PIECES, with_groups=True)
        assert none.count() == 0 and none.columns[-1] == "groups"


def test_coalescing_intervals():
    starts, ends = np.array([0, 3, 5, 0, 2, 5]), np.array([3, 5, 9, 2, 5, 9])
    order, group = alignment.coalesce(starts, ends)
    assert sorted(zip(starts[order].tolist(), group.tolist())) == [(0, 0), (0, 0), (2, 0), (3, 0), (5, 1), (5, 1)]


def test_pair_counts_in_parts(spark):
    keys = [(1, 1), (1, 2), (2, 7), (1, 1)]
    rows = [(bytearray(np.array(sorted(alignment.pair_key(np.array([a]), np.array([b]))[0] for a, b in own), "<u4").tobytes()),) for own in ([keys[0], keys[1]], [keys[3]], [keys[2]])]
    got = {r["pair"]: (r["n"], r["best"]) for r in alignment.pair_counts(spark.createDataFrame(rows, "pairs binary"), held_pairs=1).collect()}
    assert got == {1 << 16 | 1: (2, True), 1 << 16 | 2: (1, False), 2 << 16 | 7: (1, True)}


@pytest.mark.parametrize("text", [t for t in TEXTS if t])
def test_pieces_give_the_texts(text):
    n, flat = alignment.split_pieces(pa.array([text], pa.large_string()))
    assert "".join(flat.to_pylist()) == " " + text and n.tolist() == [len(flat)]
