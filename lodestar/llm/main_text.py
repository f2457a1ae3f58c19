"""Operator 9, main text of HTML by two-pass block rules.

Pass one walks the markup, cuts the text into blocks at block-level tags and classifies each block: blocks below
boilerplate elements (menus, headers, footers, asides, forms) or hidden ones are bad; otherwise link
density, length and the density of stop words decide between good, bad and, for short or middling blocks, undecided.
Class, id and role words (sidebar, notice, advert, comments) only make blocks suspicious: a block's suspicion is the number
of such elements around it, counted anew inside the outermost article or main element.  The page's level is the least
suspicion up to which its blocks hold ``MAIN_SHARE`` of its good text; blocks above it are bad, the others as
pass one finds them.  So a layout element named after the sidebar beside it does not cost the text inside it.
A page's article or main element is a prior: inside it a block needs fewer characters or stop words to be good, lack of
stop words makes no block bad, and headings are undecided whatever their links.  A page without any block in a language of the lists is judged by
length and links, as are long blocks in scripts that no list is for.  In pass two an undecided block takes
the label of the nearest decided block, ties going to good, and an article's heading that of the next one; a block of the article without links
is dropped only between two bad ones.  Blocks of the article look for neighbours inside the article
only, and without any decided neighbour a block is kept.  Text outside the article is kept by its own label, unless the
article holds at least as much kept text as all that stands outside.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .registry import query

SHORT = 70            # characters: below, a block is not judged by itself
LONG = 200
STOP_LOW, STOP_HIGH = 0.15, 0.25
LINK_DENSITY = 0.33
MAIN_SHARE = 0.2      # of the good characters: less is not what a page's markup is judged by

# Common words by language, for the density of stop words.
STOP_WORDS = {
    "en": "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which will with you".split(),
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sur un une vous".split(),
    "de": "als am an auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht oder sich sie sind so und von war wie zu zum zur".split(),
    "es": "a al como con de del el ella en es esta este fue ha la las le lo los más me mi no o para pero por que se ser si sin sobre su sus un una y ya".split(),
}
ALL_STOP_WORDS = frozenset(w for ws in STOP_WORDS.values() for w in ws)

RAW = frozenset("script style textarea template noscript iframe svg math object select title head".split())
BOILER_TAGS = frozenset("nav footer aside form button menu dialog label fieldset".split())
ARTICLE_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
# An open element that a new one of these closes.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDS_P = BLOCK - {"html", "body", "tbody", "thead", "tfoot", "tr", "td", "th", "option", "optgroup"}

# One walk over a tag, never back: an attribute is a name and perhaps a value, in quotes or up to white space; a quote that nothing closes is
# part of a name.  What the end of the page cuts off is a tag to its end.
_ATTRIBUTES = r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+"""
_TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+""", re.S)
_MARKING = frozenset("class id role style hidden aria-hidden".split())
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice\w*|gdpr|sidebar|side|menu\w*|nav|navbar|navigation|"
    r"breadcrumb\w*|footer|header|masthead|comment\w*|replies|disqus|social|share|sharing|related|recommend\w*|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|search|toolbar|pagination|pager|widget|alert|complementary|contentinfo|navigation|form)(?:$|[\s_-])", re.I)
_WORD = re.compile(r"[^\W\d_]+")


def _marks(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is boilerplate, and whether its class, id or role hints at it."""
    if name in BOILER_TAGS or (name == "header" and not in_article):
        return True, False
    if not attributes or name in ("body", "html", "article", "main"):
        return False, False
    hint = False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key not in _MARKING:
            continue
        if key in ("class", "id", "role") and _HINT.search(value):
            hint = True
        if key == "hidden" or (key == "aria-hidden" and value == "true") or \
                (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return True, hint
    return False, hint


def blocks_of(page: str) -> list[tuple[str, int, bool, bool, int, bool]]:
    """``(text, characters inside links, below boilerplate, inside an article, suspicion, heading)`` of each block with text, in page order."""
    out: list[tuple[str, int, bool, bool, int, bool]] = []
    open_: list[tuple[str, bool, bool, int, bool]] = []   # (tag, below boilerplate, in article, suspicion, in link)
    places: dict[str, list[int]] = {}   # of the open elements of each tag, so that nothing walks the whole stack
    headings = 0
    piece: list[str] = []
    linked = 0
    state = (False, False, 0, False)

    def flush() -> None:
        nonlocal piece, linked
        if piece:
            text = " ".join("".join(piece).split())
            if text:
                out.append((text, linked, *state[:3], headings > 0))
            piece = []
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = entities.unescape(raw) if "&" in raw else raw
        piece.append(text)
        if state[3]:
            linked += len(text.strip())

    def innermost(names: Iterable[str]) -> int:
        """Place of the innermost open element of these names, or -1."""
        return max((places[t][-1] for t in names if places.get(t)), default=-1)

    def close(names: Iterable[str]) -> None:
        """Close the innermost open element of these names and all inside it."""
        nonlocal state, headings
        i = innermost(names)
        if i < 0:
            return
        gone = [t for t, *_ in open_[i:]]
        if not BLOCK.isdisjoint(gone):
            flush()
        for t in gone:
            places[t].pop()
            headings -= t in HEADINGS
        del open_[i:]
        state = open_[-1][1:] if open_ else (False, False, 0, False)

    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            if at < len(page):
                add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name, ending, attributes = name.lower(), m.group(1), m.group(3)
        if ending:
            if name == "p" and not places.get("p"):
                flush()
            close((name,))
            continue
        if name in RAW and name != "head":
            if not attributes.rstrip().endswith("/"):
                stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                if stop is None and name in ("script", "style", "textarea", "title"):
                    break
                at = stop.end() if stop else at
            continue
        if name == "br":
            piece.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name in ENDS_P:
                close(("p",))
            if name in CLOSES and name != "p" and innermost(CLOSES[name]) > innermost(("ul", "ol", "dl", "table", "select")):
                close(CLOSES[name])
        if name in VOID or attributes.rstrip().endswith("/"):
            continue
        boiler, article, suspicion, link = state
        own, hint = _marks(name, attributes, article)
        enters = name in ARTICLE_TAGS or "articleBody" in attributes
        state = (boiler or own, article or enters, 0 if enters and not article else suspicion + hint, link or name == "a")
        places.setdefault(name, []).append(len(open_))
        headings += name in HEADINGS
        open_.append((name, *state))
    flush()
    return out


def _first_pass(text: str, linked: int, boiler: bool, article: bool, heading: bool, stop_words: frozenset) -> tuple[int, str]:
    """1 good, -1 bad, 0 undecided; and the rule that says so."""
    if boiler:
        return -1, "boilerplate"
    n = len(text)
    if heading and article:
        return 0, "heading"
    if linked > LINK_DENSITY * n:
        return -1, "links"
    if n < SHORT:
        return (-1, "links") if linked and not article else (0, "short")
    found = _WORD.findall(text.lower())
    density = sum(w in stop_words for w in found) / max(1, len(found))
    if density >= STOP_HIGH:
        return (1, "stop words") if article or n > LONG else (0, "middling")
    if density >= STOP_LOW:
        return (1, "stop words") if article and n > LONG else (0, "middling")
    if article or (n > LONG and not linked and _foreign(found)):
        return (1 if not article else 0), "few stop words"   # no stop-word list is for this script; an article's words are its own
    return -1, "few stop words"


def _foreign(found: list[str]) -> bool:
    """Whether most letters are of a script that no stop-word list is in."""
    letters = "".join(found)
    return 2 * sum(c > "\u024f" for c in letters) > len(letters)


def _level(blocks: list[tuple[str, int, bool, bool, int, bool]], labels: list[int]) -> int:
    """The least suspicion up to which blocks hold ``MAIN_SHARE`` of the good characters (without any, of the undecided ones)."""
    size: dict[int, int] = {}
    for wanted in (1, 0):
        for b, label in zip(blocks, labels):
            if label == wanted and not b[2]:
                size[b[4]] = size.get(b[4], 0) + len(b[0])
        if size:
            break
    held, total = 0, sum(size.values())
    for suspicion in sorted(size):
        held += size[suspicion]
        if held >= MAIN_SHARE * total:
            return suspicion
    return 0


def judged(page: str) -> list[tuple[str, bool, str]]:
    """``(text, kept, rule)`` of each block; the rule is that of pass one, "neighbour" or "alone" for pass two, or "outside"."""
    blocks = blocks_of(page)
    first = [_first_pass(*b[:4], b[5], ALL_STOP_WORDS) for b in blocks]
    if not any(label > 0 for label, _ in first):
        # No block of the page is in a language of the stop words: length and links alone decide.
        first = [(1 if len(b[0]) > LONG and not b[1] else 0, rule) if rule == "few stop words" else (label, rule)
                 for b, (label, rule) in zip(blocks, first)]
    level = _level(blocks, [label for label, _ in first])
    first = [(-1, "suspicious") if b[4] > level and label >= 0 else (label, rule) for b, (label, rule) in zip(blocks, first)]
    labels = [label for label, _ in first]
    keep, rules = [label > 0 for label in labels], [rule for _, rule in first]
    for inside in (True, False):
        own = [i for i, b in enumerate(blocks) if b[3] == inside]
        marks = {k: labels[i] for k, i in enumerate(own) if labels[i]}
        # nearest decided block on either side, in one walk each way
        before: list[tuple[int, int] | None] = []
        last = None
        for k in range(len(own)):
            if k in marks:
                last = (k, marks[k])
            before.append(last)
        last = body = None   # body: the next decided block that markup has not ruled out
        for k in range(len(own) - 1, -1, -1):
            i = own[k]
            if k in marks:
                last = (k, marks[k])
                if rules[i] not in ("boilerplate", "suspicious"):
                    body = last
                continue
            if rules[i] == "heading" and body:
                near = [(0, -body[1])]   # a heading belongs to what follows it
            else:
                near = [(abs(k - x[0]), -x[1]) for x in (before[k], last) if x]
            if inside and rules[i] != "heading" and not blocks[i][1]:
                # Text without links inside an article goes only if it stands between two ruled-out blocks.
                keep[i] = len(near) < 2 or any(x[1] < 0 for x in near)
            else:
                keep[i] = not near or min(near)[1] < 0
            rules[i] = "neighbour" if near else "alone"
    inner, outer = (sum(len(b[0]) for b, k in zip(blocks, keep) if k and b[3] == inside) for inside in (True, False))
    if inner >= outer:
        # Where the article holds most of the kept text, what stands outside is not the page's; a teaser rules out nothing.
        rules = ["outside" if k and not b[3] else r for b, k, r in zip(blocks, keep, rules)]
        keep = [k and b[3] for b, k in zip(blocks, keep)]
    return [(b[0], k, r) for b, k, r in zip(blocks, keep, rules)]


def main_text(page: str) -> str:
    """The page's main text; empty if there is none."""
    return "\n".join(text for text, kept, _ in judged(page) if kept)


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row's whole page.

    Null pages have empty text.  Repeated rows and null ids or URLs stay as they are; other columns are not read; an empty
    table gives an empty table.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(html).cast("string"))
            .mapInArrow(extract, "page_id long, url string, text string, n_chars long"))


@query("op9_main_text")
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))
