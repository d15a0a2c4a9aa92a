"""Main text of web pages by two passes of block rules.

A page becomes blocks: runs of text between block-level tags. The first pass decides
blocks by link density, length and stop-word density, and by the containers they stand in
(menus, headers, footers, sidebars, notices, adverts, forms, comments, by tag, role or
class). Short blocks that say too little stay open; the second pass gives them the label of
the nearest neighbour that the rules decided, where sharing a deeper container counts
before distance. Neighbours decided by their container do not count (an advert between two
paragraphs says nothing of them); a block of the article asks only neighbours in the
article. A block without neighbours stays.

Pages are read where they lie, one at a time, whole; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import text_slices

LINKED = 0.5  # share of link characters from which a block is a menu
LONG = 80  # characters from which a block with a few stop words is text
SHORT = 25  # characters from which a block with many stop words is text
FEW, MANY = 0.08, 0.25  # stop words a word

# Frequent words of seven languages.
STOP = frozenset("""
the of and to in is that it for was on with as are be at by this from or an have not but they which you all
der die das und ist nicht ein eine zu den von mit sich des auf dem im auch als wie
le la les des et est une dans que pour qui sur pas plus par au ce il elle avec
el los las y en de por con para una del se su al lo como pero sus
che di non per sono della il nel gli anche
os as um uma não mais foi ao seu dos
het een van niet zijn voor op met aan ook
""".split())
# Elements that end the block before them.
BREAKS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead tr ul
""".split())
# Elements whose content is no page text.
RAW = frozenset("iframe noembed noframes noscript object script select style svg template textarea title xmp".split())
VOID = frozenset("hr".split())
SELF_CLOSING = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "td": "td th", "th": "td th", "tr": "tr td th", "option": "option"}
# Elements, roles and words of class or id that name something beside the article.
OUTER_TAGS = frozenset("aside dialog fieldset footer form header menu nav search button".split())
OUTER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
OUTER_NAMES = frozenset("""
ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner
sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer
cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login
share sharing social comment comments disqus respond reply replies related recommended recommendations copyright hidden
""".split())
INNER_NAMES = frozenset("article content entry main post story".split())
NOT_NAMING = frozenset("has is no with without".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z|[\"'][^>]*+(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_ENDS = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


@dataclass(eq=False)
class Box:
    """An open element that may hold blocks."""

    name: str
    parent: Box | None = None
    depth: int = 0
    outer: bool = False  # a menu, footer, advert, ... by itself
    inner: bool = False  # the article by itself
    named: bool = False  # inner only by its class

    def up(self) -> Iterator[Box]:
        box: Box | None = self
        while box is not None:
            yield box
            box = box.parent


@dataclass
class Block:
    text: str
    box: Box
    links: int = 0  # characters inside links
    heading: bool = False
    outer: bool = False
    good: bool | None = field(default=None)


def _box(name: str, rest: str, parent: Box) -> Box:
    box = Box(name, parent, parent.depth + 1, outer=name in OUTER_TAGS, inner=name in ("article", "main"))
    if rest and name not in ("html", "body"):
        said = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(rest)}
        names: set[str] = set()
        for token in f"{said.get('class', '')} {said.get('id', '')}".split():
            parts = [p.lower() for p in _PARTS.split(token) if p]
            if parts and parts[0] not in NOT_NAMING:
                names.update(parts)
        hidden = "hidden" in said or said.get("aria-hidden") == "true" or "display:none" in said.get("style", "").replace(" ", "").lower()
        box.outer |= hidden or said.get("role", "").lower() in OUTER_ROLES or bool(names & OUTER_NAMES)
        if names & INNER_NAMES and names & OUTER_NAMES <= {"header"}:
            box.outer = hidden
        if not box.inner and names & INNER_NAMES and not box.outer:
            box.inner = box.named = True
        box.inner |= said.get("role", "").lower() == "main"
    if name == "header" and any(b.inner for b in parent.up()):
        box.outer = False  # the head of the article itself
    return box


def page_blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order, with their containers, not yet labelled."""
    page = page or ""
    top = box = Box("")
    blocks: list[Block] = []
    said: list[str] = []
    links = breaks = 0
    link_box: Box | None = None
    heading = False

    def close_block() -> None:
        nonlocal links, breaks, heading
        text = " ".join("".join(said).split())
        if text:
            blocks.append(Block(text, box, links, heading))
        said.clear()
        links = breaks = 0
        heading = False

    def say(text: str) -> None:
        nonlocal links, breaks
        text = html.unescape(text) if "&" in text else text
        if text and not text.isspace():
            breaks = 0
            if link_box is not None:
                links += sum(map(len, text.split()))
        said.append(text)

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            say(page[at:])
            break
        if token.start() > at:
            say(page[at:token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            if token["cdata"]:
                said.append(token["cdata"])
            continue
        name = name.lower()
        if token["end"]:
            if name == "a":
                link_box = None
            elif name in BREAKS or name == "button":
                close_block()
                found = next((b for b in box.up() if b.name == name), None)
                if found is not None:
                    box = found.parent or top
                    if link_box is not None and link_box.depth > box.depth:
                        link_box = None
            continue
        if name in RAW:
            ending = _ENDS[name].search(page, at)
            at = size if ending is None else ending.start()
            said.append(" ")
        elif name == "br":
            said.append(" ")
            breaks += 1
            if breaks > 1:
                was = heading
                close_block()
                heading = was
        elif name == "a":
            link_box = box
        elif name in BREAKS or name == "button":
            close_block()
            if name in SELF_CLOSING:
                shut = SELF_CLOSING[name].split()
                while box.name in shut:
                    box = box.parent or top
            if name not in VOID:
                box = _box(name, token["rest"], box)
                heading = len(name) == 2 and name[0] == "h" and name[1] in "123456"
    close_block()
    return blocks


def _boxes(blocks: list[Block]) -> list[Box]:
    """Every box that holds a block, each once, parents before children."""
    seen: set[Box] = set()
    for block in blocks:
        for box in block.box.up():
            if box in seen:
                break
            seen.add(box)
    return sorted(seen, key=lambda b: b.depth)


def _settle_boxes(blocks: list[Block]) -> dict[Box, tuple[bool, int]]:
    """For each box whether an outer box holds it, and the depth of the article in it (-1:
    not in one). An outer box that holds the only article (an unclosed menu, a form round
    the page) is none."""
    boxes = _boxes(blocks)
    inner = {b for b in boxes if b.inner}
    if any(not b.named for b in inner):
        inner = {b for b in inner if not b.named}

    def held() -> dict[Box, tuple[bool, int]]:
        out: dict[Box | None, tuple[bool, int]] = {None: (False, -1)}
        for b in boxes:
            outer, depth = out[b.parent]
            outer |= b.outer
            out[b] = (outer, b.depth if b in inner and not outer else depth)
        return out

    found = held()
    if inner and all(found[b][0] for b in inner):
        for b in inner:
            for up in b.up():
                up.outer = False
        found = held()
    return found


def _shared(a: Box, b: Box) -> int:
    """Depth of the deepest box that holds both."""
    mine = set(a.up())
    return next((up.depth for up in b.up() if up in mine), 0)


def label_blocks(blocks: list[Block]) -> list[Block]:
    """Both passes; ``good`` says whether a block belongs to the main text."""
    held = _settle_boxes(blocks)
    article = any(depth >= 0 for _, depth in held.values())
    for block in blocks:
        block.outer, home = held[block.box]
        within = not article or home >= 0
        words = block.text.split()
        linked = block.links / max(1, sum(map(len, words)))
        stops = sum(w.strip(".,;:!?\"'()").lower() in STOP for w in words) / len(words)
        if block.outer:
            block.good = False
        elif not within and not block.heading:
            block.good = False
        elif linked > LINKED or (not article and block.text[0] == "\N{COPYRIGHT SIGN}"):
            block.good = None if article and not block.heading and len(block.text) < SHORT else (article and block.heading)
        elif (len(block.text) >= LONG and stops >= FEW) or (len(block.text) >= SHORT and stops >= MANY):
            block.good = True
        elif article and within:
            block.good = True if len(block.text) >= LONG else None
    decided = [i for i, b in enumerate(blocks) if b.good is not None and not b.outer]
    labels = [b.good for b in blocks]
    after = 0
    for i, block in enumerate(blocks):
        while after < len(decided) and decided[after] < i:
            after += 1
        if block.good is None:
            near = [(_shared(block.box, blocks[j].box), -abs(i - j), bool(blocks[j].good), j) for j in decided[max(0, after - 1):after + 1]]
            best = max((n for n in near if n[0] >= held[block.box][1]), default=None)
            labels[i] = True if best is None else best[2]
    for block, good in zip(blocks, labels):
        block.good = good
    return blocks


def main_text(page: str | None) -> str:
    """The text of the good blocks in page order, one a line; empty for a null or empty page."""
    return "\n".join(b.text for b in label_blocks(page_blocks(page)) if b.good)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    A null or empty page has the empty text. Null ids and urls are kept, repeated rows
    give a row each, an empty table none. Other columns are not read."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 64):
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return read.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
