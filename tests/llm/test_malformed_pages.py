"""Main text of malformed, deep and foreign pages, and the walk over markup against the standard library's parser."""

from __future__ import annotations

import time
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from lodestar.llm import main_text

PROSE = "This is the first sentence of a text that is long enough to be judged by itself, and it goes on for a while as the writer has much to say in it."


class _Text(HTMLParser):
    """All text outside raw elements, as the standard library reads it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.raw: str | None = None
        self.text: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in main_text.RAW - {"head"}:
            self.raw = self.raw or tag

    def handle_endtag(self, tag):
        self.raw = None if tag == self.raw else self.raw

    def handle_data(self, data):
        if self.raw is None:
            self.text.append(data)


def test_blocks_hold_the_text_that_the_standard_parser_finds():
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        parser = _Text()
        parser.feed(page or "")
        parser.close()
        got = "".join(b[0] for b in main_text.blocks_of(page or ""))
        assert "".join(got.split()) == "".join("".join(parser.text).split())


def test_no_article_block_without_links_or_suspicion_is_dropped():
    dropped = kept = 0
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        for block, (_, keep, _) in zip(main_text.blocks_of(page or ""), main_text.judged(page or "")):
            if block[3] and not block[2] and not block[1] and block[4] == 0:
                kept, dropped = kept + keep, dropped + (not keep)
    assert dropped == 0 and kept > 1000


@pytest.mark.parametrize("page, want", [
    ('<article><p>one</p><img alt="a < b" src="x.png"><p>two</p></article>', "one\ntwo"),
    ("<article><p title='x > y'>one</p><p title=it's>two</p></article>", "one\ntwo"),
    ('<article><p data-x="' + "x>" * 500_000 + '">one</p></article>', "one"),
    ("<article><p>one</p><p class=", "one"),
    ("<article><p>1 < 2 &lt; 3</p></article>", "1 < 2 < 3"),
    ("<article><p data-class='sidebar' data-hidden=1>one</p><p hidden>no</p><p aria-hidden='true'>no</p></article>", "one"),
    (f"<article><p>{PROSE}</p><p>{'Zvi qua ront. ' * 30}</p><p>Ble ont.</p></article>", f"{PROSE}\n{('Zvi qua ront. ' * 30).strip()}\nBle ont."),
    (f"<div>{'Москва город России который стоит на реке. ' * 20}</div>", ("Москва город России который стоит на реке. " * 20).strip()),
    ("", ""), ("plain", "plain"), ("<", "<"), ("<<<>>>", "<<<>>>"),
])
def test_odd_markup(page, want):
    assert main_text.main_text(page) == want


@pytest.mark.parametrize("page", [
    "<p>text</p><a" + ' x="1"' * 40 + " <p>word</p>", "<a" + ' x="1"' * 200_000, "<a " * 300_000, "<!" * 400_000, '<a b="' * 100_000, "<a b='\"" * 100_000,
    "<div>" * 20_000 + "text" + "</div>" * 20_000, "".join(f"<div>t{i}" for i in range(20_000)), "<div><li>x" * 20_000, "<h1><p>x</b>" * 20_000, "</p>" * 100_000])
def test_time_is_linear(page):
    began = time.time()
    main_text.main_text(page)
    assert time.time() - began < 2
