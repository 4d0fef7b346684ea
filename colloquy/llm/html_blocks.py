"""Main text of web pages by two passes over their blocks.

The first pass cuts a page into blocks of text and classifies each: blocks in menus, headers,
footers, sidebars, notices, adverts, forms and reader comments, and blocks that are mostly links,
are boilerplate; long blocks with enough stop words are text; long blocks of a section that has hardly
any stop words in all its long blocks are boilerplate; the others, mostly short ones, are undecided. A
single sentence without a stop word thus does not leave the text around it. In the second pass an
undecided block inherits the label of the nearest decided neighbours, within the article where the
page marks one: where they differ, the nearer counts, and at equal distance the text. Where nothing
is decided, all that elements and names leave is text, if it has a word or a mark.

A section is the innermost ``div``, ``section`` or the like around a block; one that holds a single block
counts with the section around it. Where a page marks an article (``article``, ``main``), only its blocks
can be text, and there the mark outweighs a section's few stop words. On pages whose long blocks
have hardly any stop words, in a language without a list, length and links decide.

Rows: null html counts as empty; a page without text gives the empty text. Pages are read whole;
unclosed elements, comments, scripts and quotes run to the end of what the page has. The result
depends on the row alone: ties and repeated rows need no rule. An empty table gives no rows. Columns
called like a result are replaced.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.common import append_columns, texts

# Frequent function words of the languages pages come in.
STOP_WORDS = frozenset(
    # English
    "a about after all also an and any are as at be because been but by can could do for from had has have he her his "
    "how i if in into is it its more no not of on one or our out she so some than that the their them then there these "
    "they this to up was we were what when which who will with would you your "
    # French
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour "
    "qu que qui sa se ses son sont sur un une vous y "
    # German
    "als am an auch auf aus bei bin bis das dass dem den der des die doch durch ein eine einem einen einer er es für "
    "haben hat ich ihr im in ist mit nach nicht noch nur oder sein sich sie sind so über um und von vor war was wenn "
    "wie wir wird zu zum zur "
    # Spanish
    "al como con del desde donde el ella en entre era es esta este esto ha han hay la las lo los más me muy no nos o "
    "para pero por que se ser si sin sobre son su sus también un una uno y ya".split()
)

# Elements by what they do to the text around them.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas select textarea button head audio video map".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
ARTICLE = frozenset(("article", "main"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter nobr output q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
SECTIONS = frozenset("article center div main section".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in a class, id or role that name a part around the article.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar skip "
    "social sponsor sponsored subscribe subscription tags teaser teasers toolbar widget widgets".split()
)

# Words that make a name a state of the page (``has-sidebar``, ``comments-open``).
STATES = frozenset("has with no without is not open closed enabled disabled allowed layout active".split())
# Elements whose start ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul".split()
)

STOP_SHARE = 0.20
# Under this share of stop words over the long blocks of a section, it is not running text; over those
# of a page, its language has no list.
RUNNING_SHARE = 0.05
LINK_SHARE = 0.5
SHORT_CHARS = 40

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)                                                        # comment
      | <!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)
      | <[!?][^>]*(?:>|\Z)                                                       # declaration
      | <(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)
      | (?P<text>[^<]+|<)""",
    re.S | re.X,
)
MARKS = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME_PART = re.compile(r"[a-z]+")
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters within links
    outside: bool  # in a part that is not the article's
    article: int  # number of the article the block lies in, 0 for none
    section: int = 0  # number of the section it lies in, 0 for the page
    label: bool | None = None

    @property
    def size(self) -> int:
        return len(self.text) - self.text.count(" ")

    @property
    def mostly_links(self) -> bool:
        return self.linked > LINK_SHARE * self.size

    def stops(self) -> tuple[int, int]:
        """Its stop words and its words."""
        words = WORD.findall(self.text.lower())
        return sum(map(STOP_WORDS.__contains__, words)), len(words)


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, unclassified."""
    found: list[Block] = []
    pieces: list[str] = []
    # Open elements that matter: (name, outside, article, section); links are counted apart. Outside is
    # 1 by a part of a name alone, which an article within takes back, and 2 for good.
    stack: list[tuple[str, int, int, int]] = []
    outside, article, section, articles, links, linked = 0, 0, 0, 0, 0, 0
    around = [0]  # for each section the one around it

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            found.append(Block(text, linked, outside > 0, article, section))
        pieces.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        token = TOKEN.match(page, at)
        at = token.end()
        if (text := token["text"]) is not None:
            text = references.unescape(text)
            pieces.append(text)
            if links:
                linked += len("".join(text.split()))
            continue
        if token["data"] is not None:
            pieces.append(token["data"])
            continue
        if not token["name"]:
            continue
        name, closing = token["name"].lower(), bool(token["end"])
        if name in SKIPPED and not closing:
            if not token["rest"].endswith("/"):
                last = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(page, at)
                at = last.end() if last else end
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name in INLINE and not (token["rest"] and not closing and _hidden(token["rest"])):
            continue
        close_block()
        if name in ENDS_P and not closing and stack and stack[-1][0] == "p":
            stack.pop()
            outside, article, section = stack[-1][1:] if stack else (0, 0, 0)
        if name in VOID:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            outside, article, section = stack[-1][1:] if stack else (0, 0, 0)
        elif name not in ("p", "li", "tr", "td", "th", "dt", "dd", "option", "html", "body") or token["rest"]:
            if name in ("html", "body"):
                continue
            if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and not _named(token["rest"]):
                continue
            own = 2 if name in BOILERPLATE else _named(token["rest"])
            if name in ARTICLE and not article and outside < 2:
                articles += 1
                article = articles
                outside = 0
                own = own if own == 2 else 0
            outside = max(outside, own)
            if name in SECTIONS:
                around.append(section)
                section = len(around) - 1
            stack.append((name, outside, article, section))
    close_block()
    _join_single(found, around)
    return found


def _join_single(blocks: list[Block], around: list[int]) -> None:
    """Sections of a single block count with the section around them, inner ones first."""
    held = Counter(block.section for block in blocks)
    last = {block.section: block for block in blocks}
    for section in range(len(around) - 1, 0, -1):
        if held[section] == 1:
            outer = around[section]
            last[section].section = outer
            held[outer] += 1
            last[outer] = last[section]


def _hidden(marks: str) -> bool:
    return any(
        (key.lower() == "style" and HIDDEN.search(value)) or key.lower() == "hidden" or (key.lower() == "aria-hidden" and "true" in value)
        for key, value in MARKS.findall(marks)
    )


def _named(marks: str) -> int:
    """2 where an element is hidden or its role, id or a class is a hint, 1 where a part of one is."""
    if not marks:
        return 0
    if _hidden(marks):
        return 2
    names = [n for key, value in MARKS.findall(marks) if key.lower() in ("class", "id", "role") for n in value.lower().strip("\"'").split()]
    if not HINTS.isdisjoint(names):
        return 2
    parts = [set(NAME_PART.findall(name)) for name in names]
    return int(any(not HINTS.isdisjoint(p) and STATES.isdisjoint(p) for p in parts))


def classify(blocks: list[Block]) -> list[bool]:
    """For each block whether it is text of the article."""
    marked = any(block.article and not block.outside for block in blocks)
    # Sections matter only on pages without a mark.
    long = [] if marked else [b for b in blocks if not b.outside and b.size >= SHORT_CHARS and not b.mostly_links]
    listed = marked or _running(long)
    sections: dict[int, list[Block]] = {}
    for block in long:
        sections.setdefault(block.section, []).append(block)
    bare = {section for section, held in sections.items() if listed and not _running(held)}
    for block in blocks:
        block.label = _first_pass(block, marked, listed, bare)
    left = [b for b in blocks if not b.outside and (b.article or not marked)]
    _second_pass(left, marked or any(WORD.search(b.text) for b in left))
    return [bool(block.label) for block in blocks]


def _running(blocks: list[Block]) -> bool:
    """Whether the blocks have stop words of a listed language."""
    counts = [block.stops() for block in blocks]
    return sum(stops for stops, _ in counts) >= RUNNING_SHARE * sum(words for _, words in counts)


def _first_pass(block: Block, marked: bool, listed: bool, bare: set[int]) -> bool | None:
    if block.outside or (marked and not block.article) or block.mostly_links:
        return False
    if block.size < SHORT_CHARS:
        return None
    stops, words = block.stops()
    if stops >= STOP_SHARE * max(words, 1) or (words and not listed):
        return True
    return False if block.section in bare else None


def _second_pass(blocks: list[Block], otherwise: bool) -> None:
    """Undecided blocks inherit from the nearest decided ones, as decided by the first pass; without any,
    they are text or not as ``otherwise`` says."""
    before: list[tuple[int, bool] | None] = []
    last = None
    for at, block in enumerate(blocks):
        if block.label is not None:
            last = (at, block.label)
        before.append(last)
    following = None
    for at in range(len(blocks) - 1, -1, -1):
        block = blocks[at]
        if block.label is not None:
            following = (at, block.label)
            continue
        near = [(abs(at - place), not label) for place, label in filter(None, (before[at], following))]
        block.label = not min(near)[1] if near else otherwise


def main_text(page: str) -> str:
    """The text blocks of a page in order, joined by single spaces."""
    blocks = blocks_of(page)
    return " ".join(block.text for block, text in zip(blocks, classify(blocks), strict=True) if text)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without its html, with the main text in ``out``."""

    def compute(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield [[main_text(page) for page in texts(batch, html)]]

    return append_columns(pages, [T.StructField(out, T.StringType())], compute, (html,))
