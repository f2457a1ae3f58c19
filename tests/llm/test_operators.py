"""Each operator against brute force on a small table with nulls, empty and long texts, ties, repeated rows and extra columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import public_tokenizers
from lodestar.llm import (components, jaccard_join, main_text, prefix_hashes, public_bpe, quality_rules, rans, sentence_pieces,
                          source_mix, token_counts, token_files, toxicity, url_filters)
from lodestar.llm.arrow_text import PieceCache

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, part int, key string, _gone int"


def _texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["the", "an", "er", "on", "ti", "é", "ß", "x"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = prose(120).split(" ")
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in (3, 60, 119)]
    far = " ".join(base[:60]) + " " + prose(60)
    odd = [None, "", " ", "  two  spaces ", "tab\tand\nline \n more", "x<|endoftext|> y  <|endoftext|>z", "▁mark ▁▁ end  ",
           "日本語 テキスト です", "a\x00b \x85 c\x1cd", "one two", "ONE two", "a b c d e", "a b c d e f"]
    return [*odd, " ".join(base), " ".join(base), " ".join(base).upper(), *near, far, prose(20_000), "line one two\nline one two\nother\n" * 30,
            "same same same " * 80, prose(300)]


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, ["en", "de", None][i % 3], ["src1", "src2", None, "odd"][i % 4], 7, 0.5, 1, "k", 2) for i, t in enumerate(TEXTS)]
    rows += [rows[9], (None, "one two", "en", "src1", 1, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _all(docs):
    return sorted(((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def _library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BPE)


def test_token_counts(docs, empty):
    t = _library()
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(docs, BPE, table_size=50).collect())
    assert got == sorted((i or -1, len(x.encode()), len(t.encode(x, add_special_tokens=False).ids)) for i, x in _all(docs))
    assert token_counts.token_counts(empty, BPE).count() == 0


@pytest.mark.parametrize("text", [t or "" for t in TEXTS])
def test_pieces_of_both_tokenizers(text):
    t = _library()
    _, ids = public_bpe.ids_of(pa.array([text], pa.large_string()), BPE, PieceCache(lambda xs: public_bpe.encode_pieces(BPE, xs), cap=3))
    assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
    sp, apart = sentence_pieces.load(PIECES)
    assert apart
    _, ids = sentence_pieces.encode_texts(pa.array([text], pa.large_string()), PIECES, PieceCache(lambda xs: sentence_pieces.encode_words(PIECES, xs)))
    assert ids.tolist() == sp.encode(text)


def test_common_pieces_go_to_the_model_and_others_to_the_whole_library():
    t = _library()
    common = ["word", " word", " word,", " don't", " 'tis", "x1y22", " ###", " été", " один2", "日本語", " end.\n\nNext", " \n  two ", "\u0301a", "\uac00!"]
    rare = ["tab\tx", " a\x85", "\u200bz", "\U0001f600!", " \u0870x", "a\x00b", "\u3000w", " \xad", "x\r\ny"]
    special = [" x<|endoftext|>y", "<|endoftext|>"]
    by_model = public_bpe._by_model(BPE, common + rare)
    assert all(x is not None for x in by_model[:len(common)]) and by_model[len(common):] == [None] * len(rare)
    pieces = common + rare + special
    got = [np.frombuffer(x, "<u4").tolist() for x in public_bpe.encode_pieces(BPE, pieces)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in pieces]
    assert public_bpe._by_model(BPE, common) == by_model[:len(common)]   # once more, from what is held
    other = public_tokenizers.path("word_bpe_49k.json")   # normalises, so its pieces stay with the library
    assert not public_bpe._byte_level(other)


def test_sentence_pieces(docs, empty):
    sp, _ = sentence_pieces.load(PIECES)
    want = []
    for i, x in _all(docs):
        ids = sp.encode(x, add_bos=True, add_eos=True)
        want.append((i or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest(), ids, sp.decode(ids)))
    got = sentence_pieces.encode_decode(docs, PIECES, with_ids=True).collect()
    assert sorted((r[0] or -1, *r[1:]) for r in got) == sorted(want)
    assert sentence_pieces.encode_decode(empty, PIECES).count() == 0


def test_token_files(spark, docs, empty, tmp_path):
    t = _library()
    path = token_files.write_token_files(docs, str(tmp_path / "files"), BPE, 2)
    got = token_files.read_token_files(spark, path, with_ids=True).collect()
    place = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == place and r["n_tokens"] == len(r["ids"]) and r["ids"][-1] == 2
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        place += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == [i for i, _ in _all(docs)]
    assert sorted(map(tuple, (r["ids"] for r in got))) == sorted(tuple(t.encode(x, add_special_tokens=False).ids + [2]) for _, x in _all(docs))
    path = token_files.write_token_files(empty, str(tmp_path / "none"), BPE, 2)
    assert token_files.read_token_files(spark, path).count() == 0


def test_token_files_deal_out_an_id_of_many_rows(spark, tmp_path):
    rows = [(None if k % 3 else 7 if k % 2 else k, f"word{k} and {k % 11}") for k in range(1500)]
    hot = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = token_files.write_token_files(hot, str(tmp_path / "hot"), BPE, 2)
    sizes = sorted(r["count"] for r in spark.read.parquet(f"{path}/blocks").selectExpr("part", "size(keys) n").groupBy("part").sum("n").withColumnRenamed("sum(n)", "count").collect())
    assert sizes[-1] < 100                                  # of 1,000 rows without an id
    place, order = 0, []
    for r in sorted(token_files.read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r["start"]):
        assert r["start"] == place
        place += r["n_tokens"]
        order.append((r["doc_id"] is not None, r["doc_id"] or 0))
    assert order == sorted((i is not None, i or 0) for i, _ in rows)


@pytest.mark.parametrize("n", [1, 63, 64, 5000, 40_000])
def test_rans_round_trip_and_checksum(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 50_000
    kinds, times = np.unique(ids, return_counts=True)
    table = rans.Table(kinds, times)
    assert int(table.freq.sum()) == 1 << rans.BITS
    block = rans.encode(ids, table, lanes=64, every=16)
    assert (rans.decode(block, table) == ids).all()
    with pytest.raises(ValueError):
        rans.decode(block[:-5] + bytes([block[-5] ^ 1]) + block[-4:], table)


def test_prefix_hashes(docs, empty):
    rows = _all(docs)
    got = prefix_hashes.document_fingerprints(docs).collect()
    assert len(got) == len(rows)
    want = []
    for k, (i, x) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(x) // 2
        edited = x[:len(x) - half] + nxt[:half]
        a, b, c = (prefix_hashes.fingerprint(prefix_hashes.Prefixes(t)) for t in (x, edited, nxt))
        want.append((i or -1, len(x), hashlib.sha256(edited.encode()).hexdigest(), a, b, prefix_hashes.likeness(a, b), prefix_hashes.likeness(a, c)))
    assert sorted((r[0] or -1, *r[1:]) for r in got) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert prefix_hashes.document_fingerprints(empty).count() == 0


def test_common_extension_and_spans():
    rng = random.Random(2)
    a = "".join(rng.choice("ab") for _ in range(400))
    p = prefix_hashes.Prefixes(a)
    for _ in range(50):
        i, j = rng.randrange(400), rng.randrange(400)
        k = 0
        while max(i, j) + k < 400 and a[i + k] == a[j + k]:
            k += 1
        assert p.common_extension(i, p, j) == k


def test_likeness_finds_interior_and_moved_spans():
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    like = lambda x, y: prefix_hashes.likeness(*(prefix_hashes.fingerprint(prefix_hashes.Prefixes(t)) for t in (x, y)))
    for n in (2_000, 20_000, 60_000):
        x = text(n)
        assert like(x, x[:9] + "#" + x[10:-10] + "#" + x[-9:]) > 0.85            # an edit near either end
        assert like(x, text(n // 7) + x + text(5)) > 0.8                         # moved by an insertion at the front
        assert like(x, x[n // 3:] + x[:n // 3]) > 0.85                           # passages in another order
        assert like(x, text(n)) < 0.05 and like(x, x) == 1.0 and like(x, x[:-1] + "#") < 1.0
        p, q = prefix_hashes.Prefixes(x), prefix_hashes.Prefixes(x[:n - 99] + text(99))
        assert prefix_hashes.fingerprint(prefix_hashes.Spliced(p, n - 99, q, 0)) == prefix_hashes.fingerprint(prefix_hashes.Prefixes(x[:n - 99]))
    assert like("same " * 500, "same " * 400) == pytest.approx(0.8, abs=0.07) and like("", "x") == 0.0 and like("a", "") == 0.0


def test_quality_counts(docs, empty):
    import re
    got = {(r["doc_id"] or -1, r["n_words"]): r for r in quality_rules.quality_rules(docs).collect()}
    for i, x in _all(docs):
        ws = re.findall(r"[^\x20\x09-\x0D]+", x)
        r = got[(i or -1, len(ws))]
        lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
        tri = [tuple(ws[k:k + 3]) for k in range(len(ws) - 2)]
        cover = {k + j for k, w in enumerate(tri) if tri.count(w) > 1 for j in range(3)} if len(tri) < 1000 else None
        assert r["word_chars"] == sum(map(len, ws)) and r["n_symbols"] == sum(c in "#*$%&|<>" for c in x)
        assert r["n_dup_lines"] == sum(y in lines[:k] for k, y in enumerate(lines))
        if cover is not None:
            assert r["n_repeat_words"] == len(cover)
        assert r["base_failed"] == (len(ws) < 50 or 100 * r["n_repeat_words"] > 50 * len(ws))
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.quality_rules(empty).count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns


def _brute_components(rows):
    sets = []
    for _, x in rows:
        ws = x.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
        sets.append(frozenset([tuple(ws)] if 0 < len(ws) < 5 else [tuple(ws[k:k + 5]) for k in range(len(ws) - 4)]))
    par = list(range(len(rows)))

    def find(a):
        while par[a] != a:
            a = par[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if sets[a] and (100 * same >= 80 * len(sets[a] | sets[b]) or (rows[a][0] is not None and rows[a][0] == rows[b][0])):
                par[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i if i is not None else -1, len(sets[k]), (least.get(find(k), -1) if sets[k] else (i if i is not None else -1))) for k, (i, _) in enumerate(rows))


def test_jaccard_join(docs, empty):
    got = sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2]) for r in jaccard_join.similar_documents(docs).collect())
    assert got == _brute_components(_all(docs))
    assert jaccard_join.similar_documents(empty).count() == 0
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_jaccard_join_random_sizes(spark):
    """Sets of many sizes around the threshold, with a shared passage and large groups."""
    rng = random.Random(9)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for g in range(60):
        base = [f"w{g}_{k}" for k in range(rng.randint(4, 90))] + (passage if g % 2 else [])
        for _ in range(rng.randint(1, 12)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"e{rng.random()}"
            rows.append((len(rows), " ".join(own[:len(own) - rng.randint(0, 3)])))
    got = sorted(tuple(r) for r in jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == _brute_components(rows)


def test_signatures_meet_for_every_link():
    rng = np.random.default_rng(3)
    shares = jaccard_join.Shares(np.full(200, 1e6), np.zeros(0, np.uint64), np.zeros(0))
    for n in [*range(1, 40), 77, 150, 333]:
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for _ in range(10):
            gone = int(rng.integers(0, len(a) // 5 + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, len(a) // 4 + 1)), dtype=np.uint64)]))
            same = len(np.intersect1d(a, b))
            if not len(b) or 100 * same < 80 * (len(a) + len(b) - same):
                continue
            s, r, w = jaccard_join.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), shares)
            look = lambda k, role: set(s[(w == k) & (r & role > 0)].tolist())
            assert look(0, 2) & look(1, 1) or look(1, 2) & look(0, 1)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 200), (200, 100), (300, 300), (500, 41)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 100, 200: 100, 500: 41, 41: 41}


def test_source_mix(spark, docs, empty):
    rows = [(i, "w " * (i % 7), ["en", "de", None][i % 3], f"src{i % 5}") for i in range(500)]
    small = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for share, epochs in ((0.3, 1), (1.4, 3), (50.0, 2)):
        got = source_mix.mix(small, share, epochs).collect()
        tokens, total = sum(r["n_tokens"] for r in got), sum(i % 7 for i in range(500))
        assert tokens <= share * total and len(got) == len({(r["doc_id"], r["epoch"]) for r in got})
        if share == 50.0:
            assert tokens == 2 * total
        else:
            assert tokens >= share * total - 7 * 60
    assert source_mix.mix(empty).count() == 0 and source_mix.mix(docs).count() >= 0
    assert source_mix.select_mix(docs).columns == docs.columns


def test_select_mix_keeps_null_and_repeated_ids_as_selected(spark):
    rows = [(None if k % 3 == 0 else k % 7, "w " * (k + 1), "en", "src1") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = sorted((r["doc_id"] or -1, r["n_tokens"]) for r in source_mix.mix(docs, 0.5, max_epochs=1).collect())
    got = sorted((r["doc_id"] or -1, len(r["text"].split())) for r in source_mix.select_mix(docs, budget_share=0.5).collect())
    assert got == want and sum(n for _, n in got) <= 0.5 * 1830
    assert source_mix.select_mix(docs, budget_share=1.0).count() == 60


def test_budgets_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d1", "en", "c", 1000)], "domain string, lang string, source string, tokens long")
    got = {r["source"]: r["budget"] for r in source_mix.leaf_budgets(leaves, 200.0, 1, {}, {}, {}).collect()}
    assert got == {"a": 10, "b": 90, "c": 100}


def test_toxicity(spark, docs, empty):
    rng = random.Random(1)
    words = [f"w{k}x" for k in range(200)]
    rows, labels = [], []
    for i in range(600):
        own = [rng.choice(words) for _ in range(30)]
        bad = i % 5 == 0
        if bad:
            own[rng.randrange(30)] = "scummy"
        if rng.random() < (0.9 if bad else 0.1):   # a group is named mostly in toxic sentences
            own.append("women")
        rows.append((i, " ".join(own)))
        labels.append((i, 1, int(bad)))
    table, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, known)
    got = {r["doc_id"]: r for r in toxicity.score(table, model).collect()}
    held = [r for r in got.values() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held)
    probe = spark.createDataFrame([(1, "neutral words about women"), (2, "neutral words about men"), (3, None)], "doc_id long, text string")
    a, b, c = (r["score"] for r in sorted(toxicity.score(probe, model).collect()))
    assert a < 0.5 and abs(a - b) < 0.1 and 0 <= c <= 1
    assert toxicity.score(docs, model).count() == docs.count() and toxicity.drop_toxic(docs, model).columns == docs.columns
    none = toxicity.fit(table, known.where("doc_id < 0"))
    assert toxicity.score(empty, none).count() == 0 and none.weights == {}


def _weights(rows, pairs, size, **settings):
    x = toxicity.held_matrix((h for h, _ in rows), len(rows), size)
    return toxicity.fit_weights(x, np.array([y for _, y in rows], float), pairs, **settings)


def test_swaps_lower_the_change_of_a_score(monkeypatch):
    rows = [({0, 2} if k % 2 else {0}, k % 2) for k in range(200)] + [({1}, 0)] * 100
    free = _weights(rows, [], 4, counterfactual=0.0)
    tied_rows = [({*h, 3} if y else h, y) for h, y in rows]
    tied = _weights(tied_rows, [([3], [1])] * 20, 4)
    assert abs(tied[3] - tied[1]) < 0.2 < abs(free[2])
    monkeypatch.setattr(toxicity, "ROWS_AT_ONCE", 7)      # blocks change nothing
    np.testing.assert_allclose(_weights(tied_rows, [([3], [1])] * 20, 4), tied, rtol=1e-9)


def test_every_sentence_of_a_long_text_is_penalised(spark, monkeypatch):
    seen = {}
    fit_weights = toxicity.fit_weights
    monkeypatch.setattr(toxicity, "fit_weights", lambda x, y, pairs: seen.update(pairs=pairs) or fit_weights(x, y, pairs))
    text = " ".join(f"Number {k} of the women came." for k in range(50)) + " A muslim came."
    rows = [(k, text if k == 0 else f"plain word{k}" if k % 2 else f"nasty word{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k > 0 and k % 2 == 0)) for k in range(60)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    want = toxicity._swapped(text, frozenset(toxicity.IDENTITY_TERMS), toxicity.IDENTITY_TERMS)
    assert seen["pairs"][-1, -1] == len(want) > 190
    # each swap takes one term away and brings another, so it adds two or more on the diagonal
    assert sum(v for (i, j), v in seen["pairs"].items() if i == j >= 0) >= 2 * len(want)


URLS = [("http://a.b.net/x", "a.b.net", "/x", "net/", "block"), ("https://EXAMPLE.net/en/1?q#f", "example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), ("http://x.org/fr/9", "x.org", "/fr/9", "org/fr/", "allow"),
        ("http://x.org", "x.org", "", None, "allow"), ("http://net", "net", "", None, "allow"), ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("mailto:x", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("a://É.ORG/fr/?x", "É.org", "/fr/", "org/fr/", "allow")]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u[0], "x") for k, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = sorted(url_filters.url_verdicts(pages, []).collect())
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [u[1:] for u in URLS]
    assert url_filters.url_verdicts(pages.limit(0), []).count() == 0


def test_mined_url_rules(spark):
    rows = [(f"http://casino{k % 3}.example.com/{'win' if k % 2 else 'news'}/{k}", k % 2 == 1) for k in range(200)] + [(None, True), ("http://x.com/", None)]
    mined = url_filters.mine_rules(spark.createDataFrame(rows, "url string, blocked boolean"), min_support=0.05, min_confidence=0.9)
    assert ("p:win",) in _expanded(mined) and len(mined) < 10
    pages = spark.createDataFrame([(1, "http://other.com/win/2"), (2, "http://other.com/news/2")], "page_id long, url string")
    assert [r["verdict"] for r in sorted(url_filters.url_verdicts(pages, mined).collect())] == ["block", "allow"]
    assert url_filters.mine_rules(spark.createDataFrame([], "url string, blocked boolean")) == []


def _expanded(mined):
    """Every token set that the rules stand for, with its confidence."""
    return {tuple(sorted(c)): r.confidence for r in mined for c in itertools.product(*r.items)}


def _mined(spark, rows):
    return url_filters.mine_rules(spark.createDataFrame(rows, "url string, blocked boolean").repartition(3))


def test_mined_url_rules_hold_at_every_size(spark):
    """A rare host that is always blocked is a rule however many URLs there are; a few rows by chance never are."""
    plain = [(f"http://{chr(97 + k % 13)}.example.com/{chr(97 + k % 7)}/{k}", k % 4 == 0) for k in range(8000)]
    rare = [(f"http://bad.example.com/a/{k}", True) for k in range(12)]
    assert list(_expanded(_mined(spark, plain + rare))) == [("h:bad",)]
    assert _mined(spark, plain[:80]) == []
    pair = [(f"http://{'x' if k % 2 else 'y'}.example.com/{'u' if k % 4 > 1 else 'v'}/{k}", k % 4 == 3) for k in range(400)]   # x and u together
    mined = _mined(spark, pair)
    assert ("h:x", "p:u") in _expanded(mined) and all(len(r.items) == 2 for r in mined)


def test_mined_url_rules_see_all_tokens_and_keep_independent_rules(spark):
    deep = "/".join(f"part{k}" + "x" * (k % 3) for k in range(20))
    rows = [(f"http://www.example.com/{deep}/{'spam' if k % 2 else 'ham'}?id={k}&{'aff' if k % 2 else 'ref'}=1", k % 2 == 1) for k in range(60)]
    mined = _mined(spark, rows)
    assert set(_expanded(mined)) == {("p:spam",), ("q:aff",)} and len(mined) == 1
    pages = spark.createDataFrame([(1, rows[1][0]), (2, rows[2][0])], "page_id long, url string")
    assert [r["verdict"] for r in sorted(url_filters.url_verdicts(pages, mined, ()).collect())] == ["block", "allow"]
    crowd = [(f"http://h{f}.z{f}.zz{f}/" + "/".join(f"w{f}x{c}" for c in "abcdefgh"), True) for f in range(3) for _ in range(20)]   # 3 sets of 12 tokens
    mixed = [(f"http://example.org/lose/{k}", k % 20 != 0) for k in range(100)] + [(f"http://example.org/keep/{k}", False) for k in range(300)]
    got = _expanded(_mined(spark, crowd + mixed))
    assert got["p:lose",] == 0.95 and got["h:h0",] == 1.0 and all(len(r) == 1 for r in got)


@pytest.mark.parametrize("seed", range(4))
def test_mined_rules_against_brute_force(spark, seed):
    """All token sets of any length, those of URLs with up to seven tokens."""
    rng = random.Random(seed)
    rows = []
    for _ in range(500):
        own = [rng.choice("abc"), *rng.sample("defgh", rng.randint(1, 4))]
        bad = {"a", "d"} <= set(own) or {"b", "e", "f", "g"} <= set(own) or rng.random() < 0.1
        rows.append((f"http://{own[0]}/{'/'.join(own[1:])}" + (f"?{own[0]}x=1" if own[0] == "a" else ""), bad))
    got = _mined(spark, rows)
    baskets = [(frozenset(url_filters.tokens_of(u)), b) for u, b in rows]
    share = sum(b for _, b in baskets) / len(baskets)
    rules = {}
    for c in {c for own, b in baskets if b for k in range(1, len(own) + 1) for c in map(frozenset, itertools.combinations(own, k))}:
        n, bad = sum(c <= own for own, _ in baskets), sum(c <= own and b for own, b in baskets)
        bound = url_filters.lower_bound(n, bad)
        if bad >= url_filters.MIN_COUNT and bound >= url_filters.MIN_CONFIDENCE and bound > share:
            rules[c] = (bound, bad / n)
    want = {tuple(sorted(c)): conf for c, (bound, conf) in rules.items() if not any(p < c and rules[p][0] >= bound for p in rules)}
    assert _expanded(got) == want and want
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    verdicts = {r["page_id"]: (r["verdict"], r["confidence"]) for r in url_filters.url_verdicts(pages, got, ()).collect()}
    for k, (own, _) in enumerate(baskets):
        best = max((conf for c, conf in want.items() if set(c) <= own), default=None)
        assert verdicts[k] == ("allow" if best is None else "block", best)


PROSE = "This is the main text of the page, and it has been written with all of the words that are in a sentence of this length. " * 3


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("<nav>menu</nav>", ""),
    ("<article><h1>Title</h1><p>Short &amp; sweet\n  text<p>Second <b>bold</b><br>line</article><footer>foot</footer>", "Title\nShort & sweet text\nSecond bold line"),
    (f"<body><div class='sidebar'>{PROSE}</div><p>{PROSE}</p><p>Short end.</p><form>{PROSE}</form><!-- {PROSE} --></body>", f"{PROSE.strip()}\nShort end."),
    (f"<article><p>{PROSE}</p><div class='comments'><p>{PROSE}</p></div><aside>{PROSE}</aside></article><p>{PROSE}</p>", PROSE.strip()),
    ('<body><script>var t="</p><article>";</script><style>p{}</style><main><p>x</p></main>', "x"),
    ("<article>unclosed <p>text <b>and more &lt;tag&gt; &#233;", "unclosed\ntext and more <tag> é"),
])
def test_main_text(page, want):
    assert main_text.main_text(page or "") == want


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "layout with-sidebar", "header-fixed wrapper"])
def test_layout_names_do_not_cost_the_text_inside(name):
    text, side = PROSE.strip(), f"<div class='sidebar'>{PROSE}</div>"
    assert main_text.main_text(f"<div class='{name}'><article><p>{PROSE}</p></article></div>") == text
    assert main_text.main_text(f"<div class='{name}'>{side}<div><p>{PROSE}</p></div></div>") == text
    assert main_text.main_text(f"<div class='{name}'><main><p>{PROSE}</p>{side}</main></div>") == text
    assert main_text.main_text(f"<div class='{name}'>{f'<p>{PROSE}</p>' * 9}</div><p>{PROSE}</p>").count(text) == 10


LINKS = "".join(f"<li><a href='/{k}'>More about the topic number {k} and all that is in it, with the words of a long title</a></li>" for k in range(5))
NOISE = "Buy cheap watches online today best prices fast shipping order now limited offer discount coupon " * 3


def test_article_blocks_are_judged_by_the_rules():
    text = PROSE.strip()
    page = f"<article><h1><a href='/'>Title</a></h1><p>{PROSE}</p><p>Short end.</p><p>{PROSE}</p><ul>{LINKS}</ul><div>{NOISE}</div></article>"
    # Few stop words alone drop nothing from an article.
    assert main_text.main_text(page) == f"Title\n{text}\nShort end.\n{text}\n{NOISE.strip()}"
    assert [rule for _, _, rule in main_text.judged(page)] == ["neighbour", "stop words", "neighbour", "stop words", *["links"] * 5, "neighbour"]
    assert main_text.main_text(f"<article><p>{NOISE}</p></article>") == NOISE.strip()   # another language
    # The article is a teaser: the text in plain divs is kept by its own label, its link list is not.
    teaser = f"<article><h2>Other</h2><p>A card.</p></article><div>{PROSE}</div><div>{PROSE}</div><ul>{LINKS}</ul>"
    assert main_text.main_text(teaser).endswith(f"{text}\n{text}")
    assert main_text.main_text(f"<article><p>{PROSE}</p></article>{f'<div>{PROSE}</div>' * 3}") == "\n".join([text] * 4)


def test_main_text_table(spark):
    pages = spark.createDataFrame([(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "<p>plain words", "t")], "page_id long, url string, html string, text string")
    got = sorted(main_text.extract_main_text(pages).collect(), key=lambda r: r["n_chars"])
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in got] == [(1, "", 0), (1, "", 0), (None, "plain words", 11)]
    assert main_text.extract_main_text(pages.limit(0)).count() == 0


def test_repeated_rows_teach_once(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["nasty" if i % 4 == 0 else "fine", *(f"w{rng.randrange(40)}" for _ in range(20))])) for i in range(300)] + [(300, None), (301, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(302)], "doc_id long, toxic int")
    one, three = toxicity.fit(docs, labels), toxicity.fit(docs.union(docs).union(docs), labels.union(labels))
    assert one == three and "nasty" in one.weights and one.weights["nasty"] > 0
    assert toxicity.fit(docs.where("doc_id % 4 = 1"), labels).weights == {}     # labelled texts of one class only


def test_swap_sums_are_the_outer_products():
    rng = np.random.default_rng(3)
    pairs = [(rng.choice(6, 2, replace=False).tolist(), rng.choice(np.arange(6, 12), 2, replace=False).tolist()) for _ in range(40)]
    want = np.zeros((12, 12), int)
    for lost, gained in pairs:
        v = np.zeros(12, int)
        v[lost], v[gained] = -1, 1
        want += np.outer(v, v)
    got = toxicity.swap_sums(pairs)
    assert got.pop((-1, -1)) == 40 and all(want[i, j] == n for (i, j), n in got.items()) and np.count_nonzero(want) <= len(got)


def test_components_free_the_shuffles_of_earlier_rounds(spark, monkeypatch):
    from lodestar.llm import components as C
    freed = []
    monkeypatch.setattr(C, "free_shuffles", lambda s: freed.append(s))
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    got = C.connected_components(chain).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 21 and len(freed) >= 2


def test_components_of_random_edges_are_those_of_a_union_find(spark):
    rng = np.random.default_rng(11)
    edges = [tuple(map(int, e)) for e in rng.integers(-30, 120, (90, 2))] + [(5, 500 + i) for i in range(40)] + [(None, 3), (7, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(map(tuple, got)) == {x: find(x) for x in root} and len(got) == len(root)


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    from lodestar.llm import components as C

    def fail(*_):
        raise AssertionError("a round over stars")

    monkeypatch.setattr(C, "_small_star", fail)
    stars = spark.createDataFrame([(k, 10 * (k // 10)) for k in range(40)] + [(10, 13), (20, 20)], "a long, b long")
    assert dict(map(tuple, C.connected_components(stars).collect())) == {k: 10 * (k // 10) for k in range(40)}
    assert C.connected_components(stars.where("a < 0")).collect() == []


def test_a_round_of_components_broadcasts_nothing_and_leaves_one_table(spark, monkeypatch, tmp_path):
    from lodestar.llm import components as C
    monkeypatch.setattr(C, "scratch_path", lambda *_: str(tmp_path / "rounds"))
    plans, small = [], C._small_star
    monkeypatch.setattr(C, "_small_star", lambda down: plans.append(small(down)) or plans[-1])
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    assert len(C.connected_components(chain).collect()) == 21
    text = plans[0]._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert len(list((tmp_path / "rounds").iterdir())) == 1        # the tables of earlier rounds are deleted


def test_contracted_edges_keep_the_components_and_take_no_round_in_one_block(spark, monkeypatch, tmp_path):
    from lodestar.llm import components as C
    rng = np.random.default_rng(5)
    edges = [tuple(map(int, e)) for e in rng.integers(-40, 200, (150, 2))] + [(i, i + 1) for i in range(300, 400)] + [(None, 3), (7, None), (9, 9)]
    spark.createDataFrame(edges, "a long, b long").write.parquet(str(tmp_path / "edges"))
    written = spark.read.parquet(str(tmp_path / "edges"))
    expected = sorted(map(tuple, C.connected_components(written).collect()))
    several = C.contracted(written, block=20)
    assert sorted(map(tuple, C.connected_components(several).collect())) == expected
    assert C.contracted(written).rdd.getNumPartitions() == 1 and C.contracted(written.where("a > 1000")).collect() == []

    def fail(*_):
        raise AssertionError("a round over one block")

    monkeypatch.setattr(C, "_small_star", fail)
    assert sorted(map(tuple, C.connected_components(C.contracted(written)).collect())) == expected


def test_the_join_verifies_three_times_and_takes_no_round_of_components(spark, monkeypatch):
    """A chain of texts that each link to the next only: its links alone would take rounds."""
    from lodestar.llm import components as C
    names = [f"w{i}" for i in range(260)]
    rows = [(100 + i, " ".join(names[12 * i:12 * i + 120])) for i in range(12)] + [(7, ""), (8, "other text"), (9, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = _brute_components(rows)
    calls, small, verified = [], C._small_star, jaccard_join._verified
    monkeypatch.setattr(C, "_small_star", lambda down: calls.append("round") or small(down))
    monkeypatch.setattr(jaccard_join, "_verified", lambda *a: calls.append("verified") or verified(*a))
    got = sorted(tuple(r) for r in jaccard_join.similar_documents(docs).collect())
    assert got == expected and len({r[2] for r in got}) < len(got)
    assert calls.count("round") == 0 and calls.count("verified") == 3
