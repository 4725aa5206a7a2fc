"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass labels each
block from its own evidence:

* *boilerplate* if it stands in a menu, header, footer or sidebar element, in
  a container named as one, or most of its text is links;
* *content* if it is long enough and has the stop-word density of running
  text, or stands in the page's ``article`` or ``main`` element;
* *short* (undecided) if it is too short to tell;
* *boilerplate* if it is long and has hardly any stop words.

A name (class, id, role) is one sign among these.  It says nothing about an
element around the page (``settle``), names that articles bear as well
(``WEAK_NAMES``) yield to long running text in ``article`` or ``main`` or
where no other is, and a named inline element stands for itself only.

The second pass gives undecided blocks the label of the nearest decided
neighbours: content if both sides agree on it or the nearer side is content;
headings look at what follows them.

Null html counts as empty.  Every page gives one row; repeated pages are
extracted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: frequent function words of the four languages
STOP_WORDS = frozenset("""
the of and to in a is that for it was on are as with be by at this from or an
have not but they you had we were which their has what all when there can if
de la le les et des en un une du que est pour qui dans par plus pas au sur ne
se ce il elle avec son sa ses aux ou mais sont nous vous leur cette
der die das und den von zu mit sich des auf für ist im dem nicht ein eine als
auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie
el los las y del se con por una su para es al lo como más o pero sus ha me si
sin sobre este ya entre cuando todo esta ser son dos también fue
""".split())

SKIPPED = frozenset("script style noscript template textarea select option "
                    "button svg iframe object title math".split())
BOILER_TAGS = frozenset("nav footer aside menu dialog".split())
MAIN_TAGS = frozenset("article main".split())
BLOCK_TAGS = frozenset("""
address article aside blockquote body dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li
main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source "
                 "track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_NAMES = frozenset("""
ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment
comments consent cookie cookies copyright disclaimer disqus footer gdpr login
masthead menu modal nav navbar navigation newsletter notice notices pager
pagination popup promo promotion related replies reply respond share sharing
sidebar signup social sponsor sponsored subscribe tags toolbar widget widgets
""".split())
#: those of them that containers of running text bear as well
WEAK_NAMES = frozenset("""
banner copyright disclaimer masthead modal notice notices popup promo
promotion related share sharing social sponsor sponsored tags toolbar widget
widgets
""".split())
#: a name with one of these ("has-sidebar") is of what is elsewhere
STATE_WORDS = frozenset("has with without".split())
#: names of the element that holds the article, where there is no such tag
MAIN_NAMES = frozenset("article articlebody entry main post story".split())
#: the class of these says something about the whole page, not about them
PAGE_TAGS = frozenset("html body main".split())

MAX_LINK_DENSITY = 0.5
LENGTH_SHORT = 70           # characters; shorter blocks are undecided
STOP_HIGH, STOP_LOW = 0.30, 0.10

GOOD, BAD, SHORT = "content", "boilerplate", "short"


@dataclass
class Mark:
    """An element whose name or tag is one of boilerplate."""
    parent: int
    weak: bool
    titles: int = 0         # h1 elements inside
    main: bool = False      # is or holds an article or main element
    wrapper: bool = False   # around the page: says nothing


@dataclass
class Block:
    tag: str
    boiler: bool
    main: bool
    mark: int
    # (mark, text, in a link?)
    parts: list[tuple[int, str, bool]] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""
    label: str = SHORT


def _names(attrs: list[tuple[str, str | None]]) -> tuple[set[str], set[str]]:
    """All words of the names, and those of names without a state word."""
    found: set[str] = set()
    roles: set[str] = set()
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            for name in value.lower().split():
                words = set("".join(c if c.isalnum() else " "
                                    for c in name).split())
                found |= words
                if not words & STATE_WORDS:
                    roles |= words
    return found, roles


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    for key, value in attrs:
        v = (value or "").replace(" ", "").lower()
        if key == "hidden" or key == "aria-hidden" and v == "true" or (
                key == "style" and ("display:none" in v
                                    or "visibility:hidden" in v)):
            return True
    return False


class BlockParser(HTMLParser):
    """Collects the blocks of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.marks: list[Mark] = []
        self.titles = 0
        # open elements: (tag, skipped, boilerplate, main, link, mark)
        self._open: list[tuple[str, bool, bool, bool, bool, int]] = []
        self._now = (False, False, False, False, -1)
        self._block: Block | None = None

    def _set(self) -> None:
        self._now = self._open[-1][1:] if self._open else (
            False, False, False, False, -1)

    def _close_implied(self, tag: str) -> None:
        """A block ends an open paragraph, an item the item before it."""
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
                "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}.get(tag, ())
        for i in range(len(self._open) - 1, -1, -1):
            t = self._open[i][0]
            if t == "p" and tag in BLOCK_TAGS or t in ends:
                del self._open[i:]
                self._set()
                return
            if t in BLOCK_TAGS:
                return

    def handle_starttag(self, tag, attrs) -> None:
        if tag == "br":
            if self._block is not None:
                self._block.parts.append((self._now[4], " ", False))
            return
        if tag in BLOCK_TAGS:
            self._block = None
            self._close_implied(tag)
        if tag in VOID:
            return
        skip, boiler, main, link, mark = self._now
        names, roles = _names(attrs)
        if tag in SKIPPED or tag == "head" or _hidden(attrs):
            skip = True
        if tag in BOILER_TAGS or tag == "header" and not main:
            boiler = True
        elif tag == "form" or roles & BOILER_NAMES and tag not in PAGE_TAGS:
            self.marks.append(Mark(mark, tag != "form" and not (
                roles & BOILER_NAMES - WEAK_NAMES)))
            mark = len(self.marks) - 1
        if tag in MAIN_TAGS or (tag in ("div", "section")
                                and names & MAIN_NAMES):
            main = True
            m = mark
            while m >= 0 and not self.marks[m].main:
                self.marks[m].main = True
                m = self.marks[m].parent
        if tag == "h1" and not skip and not boiler:
            self.titles += 1
            m = mark
            while m >= 0:
                self.marks[m].titles += 1
                m = self.marks[m].parent
        if tag == "body":
            skip = False
        self._open.append((tag, skip, boiler, main, link or tag == "a", mark))
        self._set()

    def handle_startendtag(self, tag, attrs) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            if tag not in ("p", "div", "a"):
                self.handle_endtag(tag)

    def handle_endtag(self, tag) -> None:
        if tag in BLOCK_TAGS:
            self._block = None
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                del self._open[i:]
                self._set()
                return

    def handle_data(self, data) -> None:
        skip, boiler, main, link, mark = self._now
        if skip:
            return
        if self._block is None:
            if not data.strip():
                return
            tag, of = next(((t, m) for t, *_, m in reversed(self._open)
                            if t in BLOCK_TAGS), ("body", -1))
            self._block = Block(tag, boiler, main, of)
            self.blocks.append(self._block)
        self._block.parts.append((mark, data, link))


def _stop_density(text: str) -> float:
    words = [w.strip(".,;:!?\"'()[]|#*$%&-").lower() for w in text.split()]
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _running(text: str) -> bool:
    return len(text) >= LENGTH_SHORT and _stop_density(text) >= STOP_HIGH


def _joined(parts: list[tuple[int, str, bool]]) -> tuple[str, int]:
    """Text, and characters in links."""
    return (" ".join("".join(d for _, d, _ in parts).split()),
            sum(len("".join(d.split())) for _, d, link in parts if link))


def _linked(text: str, link_chars: int) -> bool:
    return link_chars > MAX_LINK_DENSITY * max(1, len(text.replace(" ", "")))


def _holder(marks: list[Mark], m: int) -> int:
    while m >= 0 and marks[m].wrapper:
        m = marks[m].parent
    return m


def _yields(marks: list[Mark], m: int) -> bool:
    """Are all marks around weak?"""
    while m >= 0:
        if not (marks[m].wrapper or marks[m].weak):
            return False
        m = marks[m].parent
    return True


def settle(blocks: list[Block], marks: list[Mark], titles: int) -> int:
    """Finds the marked elements that stand around the page: those with more
    running text than is outside of marks that hold the page's title, or,
    with no running text outside, an article or most of the page.  Gives the
    running text outside of marks, in characters."""
    sizes = []
    for b in blocks:
        text, links = _joined([p for p in b.parts if p[0] == b.mark])
        if not b.boiler and text:
            sizes.append((b.mark, len(text), not _linked(text, links)
                          and _running(text)))
    total = sum(n for _, n, _ in sizes)
    while True:
        held: dict[int, int] = {}
        own: dict[int, int] = {}
        runs: dict[int, int] = {}
        for m, n, running in sizes:
            m = _holder(marks, m)
            held[m] = held.get(m, 0) + n
            if running:
                own[m] = own.get(m, 0) + n
                runs[m] = runs.get(m, 0) + 1
        free = own.pop(-1, 0)
        around = [m for m, n in own.items() if n > free and (
            0 < titles == marks[m].titles or not free and (
                marks[m].main or runs[m] >= 3 and 2 * held[m] > total))]
        if not around:
            return free
        marks[max(around, key=lambda m: own[m])].wrapper = True


def _finish(b: Block, marks: list[Mark], free: int) -> bool:
    """Sets the block's text; is there any?  Text of marked inline elements
    goes, unless the whole block is such text."""
    by_mark: dict[int, list] = {}
    for p in b.parts:
        by_mark.setdefault(p[0], []).append(p)
    here = _holder(marks, b.mark)
    kept = {m for m, parts in by_mark.items()
            if _holder(marks, m) == here or _yields(marks, m)
            and (b.main or not free) and _running(_joined(parts)[0])}
    b.text, b.link_chars = _joined([p for p in b.parts if p[0] in kept])
    if not b.text:
        b.text, b.link_chars = _joined(b.parts)
        b.boiler = True
    b.parts = []
    return bool(b.text)


def first_pass(b: Block, marks: list[Mark], free: int) -> str:
    if b.boiler or _linked(b.text, b.link_chars):
        return BAD
    if _holder(marks, b.mark) >= 0 and not (
            _yields(marks, b.mark) and (b.main or not free)
            and _running(b.text)):
        return BAD
    if b.main:
        return GOOD
    if len(b.text) < LENGTH_SHORT:
        return SHORT
    density = _stop_density(b.text)
    if density >= STOP_HIGH:
        return GOOD
    return BAD if density < STOP_LOW else SHORT


def second_pass(blocks: list[Block]) -> None:
    """Undecided blocks take the label of the nearest decided ones."""
    n = len(blocks)
    before: list[tuple[int, str]] = [(n + 1, BAD)] * n
    after: list[tuple[int, str]] = [(n + 1, BAD)] * n
    for order, near, step in ((range(n), before, 1),
                              (range(n - 1, -1, -1), after, -1)):
        last = None
        for i in order:
            if blocks[i].label != SHORT:
                last = i
            elif last is not None:
                near[i] = (step * (i - last), blocks[last].label)
    for i, b in enumerate(blocks):
        if b.label != SHORT:
            continue
        (d1, l1), (d2, l2) = before[i], after[i]
        if l1 == l2 or b.tag in HEADINGS:
            b.label = l2
        else:
            b.label = l1 if d1 < d2 else l2 if d2 < d1 else BAD


def label_blocks(html: str) -> list[Block]:
    parser = BlockParser()
    parser.feed(html)
    parser.close()
    marks = parser.marks
    free = settle(parser.blocks, marks, parser.titles) if marks else 0
    blocks = [b for b in parser.blocks if _finish(b, marks, free)]
    for b in blocks:
        b.label = first_pass(b, marks, free)
    second_pass(blocks)
    return blocks


BLOCK = (T.StructType().add("tag", T.StringType())
         .add("label", T.StringType()).add("text", T.StringType()))
_SLICE = 200


def _pass(html_col: str, with_blocks: bool, like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLICE):
                row = whole.column(0).slice(lo, _SLICE)
                found = [label_blocks(h or "")
                         for h in row.field(html_col).to_pylist()]
                text = ["\n".join(b.text for b in bs if b.label == GOOD)
                        for bs in found]
                cols = [row, pa.array(text),
                        pa.array([len(t) for t in text], pa.int64())]
                if with_blocks:
                    cols.append(pa.array(
                        [[{"tag": b.tag, "label": b.label, "text": b.text}
                          for b in bs] for bs in found], like.field(3).type))
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(cols, like,
                                                    strict=True)],
                    schema=like)

    return run


def extract(pages: DataFrame, html_col: str = "html", carry=None,
            with_blocks: bool = True) -> DataFrame:
    """``row`` (struct of the columns in ``carry``, default all), ``text``,
    ``n_chars`` and, if asked for, the labelled ``blocks`` of every page."""
    from pyspark.sql.pandas.types import to_arrow_schema

    carry = pages.columns if carry is None else list(carry)
    cols = list(dict.fromkeys([*carry, html_col]))
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in cols])
                          .alias("row"))
    schema = T.StructType([packed.schema["row"],
                           T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    if with_blocks:
        schema = schema.add("blocks", T.ArrayType(BLOCK))
    return packed.mapInArrow(_pass(html_col, with_blocks,
                                   to_arrow_schema(schema)), schema)


def op6_html_extract(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    out = extract(documents(spark, sf_dir, "pages"), with_blocks=False)
    return out.select("row.page_id", "row.url", "text", "n_chars")
