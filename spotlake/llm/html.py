"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides the blocks that their
features settle: containers of boilerplate (by tag, role, class or id) and link-heavy blocks
are bad; long blocks with enough stop words are good. The second pass gives each block that
stays ambiguous (short ones, and long ones poor in stop words) the label of its nearest
decided neighbours in the same section. One thing bends that: where the text stands in articles, an ambiguous block
of one is dropped only if all decided blocks next to it in its section are bad, as notices inside an article stand between its paragraphs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks

#: Frequent function words of the four languages (fixed values).
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by for from had has have he her his in is it its not of on or she that the their they this to was we were which who will with you
    à au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou où par pas pour qui que sa se ses son sur un une vous
    aber als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch nur oder sich sie sind so über um und vom von vor war wie wir wird zu zum zur
    al como con de del el ella en entre era es esta este fue ha la las le lo los más me mi muy no o para pero por que se si sin sobre su sus también un una y ya
    """.split()
)
#: Blocks shorter than this (in characters) are ambiguous; longer ones with this share of stop words are good.
SHORT_CHARS, STOP_DENSITY = 70, 0.2
#: Blocks with more than this share of their characters in links are bad.
LINK_DENSITY = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never text of the page.
SKIPPED = frozenset("script style noscript template iframe object canvas svg math audio video textarea select button datalist title head applet map".split())
#: Elements whose content is raw text up to their end tag.
RAW = frozenset("script style textarea title iframe noscript xmp".split())
#: Elements that hold boilerplate.
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
SECTIONS = frozenset("body main article section".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Start tags that end an open paragraph.
CLOSES_P = BLOCKS - frozenset(["td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head", "option", "optgroup", "legend", "summary", "dt", "dd", "li"])
#: Words of a class or id that mark boilerplate (fixed values).
CUES = frozenset(
    """
    ad ads adbox adslot adunit advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner banners
    cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription paywall
    nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager header masthead topbar footer sidebar sidebars aside widget widgets toolbar
    comment comments commentlist disqus reply replies respond discussion share sharing social related recommended recommendations trending
    login signin signup search searchbox form skip copyright legal disclaimer
    """.split()
)
#: Cues that say what an element is even where other words follow (fixed values).
LOUD = frozenset(
    """
    adslot adunit advert advertisement cookie cookies gdpr newsletter paywall navbar breadcrumb breadcrumbs pagination footer sidebar comment comments disqus
    share sharing related recommended recommendations
    """.split()
)
#: Cues that also hold for an article element: adverts and reader comments. The others are states of it (fixed values).
OF_ARTICLES = frozenset("ad ads adbox adslot adunit advert adverts advertisement advertising comment comments disqus reply replies".split())
#: Cues that hold wherever an article stands (fixed values).
FIRM = OF_ARTICLES | frozenset("cookie cookies consent gdpr newsletter related recommended recommendations trending commentlist respond discussion".split())
#: Words that say what an element has, lacks or does, not what it is (fixed values).
STATES = frozenset("has no with without not is hide show less free enabled disabled open opened closed on off active visible collapsed".split())
#: Words after a cue that leave its meaning (fixed values).
CONTAINERS = frozenset(
    """
    wrap wrapper container box inner outer area section block item items list group row col column bar panel content body left right top bottom
    main primary secondary links link buttons button icons icon text title message msg info widget slot unit zone region tray tabs
    """.split()
)
#: ARIA roles that mark boilerplate.
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())

_MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_LOOSE = re.compile(r"[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_CUE_WORD = re.compile(r"(?<![0-9])(?:[A-Z]?[a-z]+|[A-Z]+)")
_WORD = re.compile(r"[^\W\d_]+")
_ENDS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}


class _Element:
    __slots__ = ("name", "bad", "section", "link", "skip", "mark")

    def __init__(self, name: str, bad: bool, section: int, link: bool, skip: bool, mark: int):
        self.name, self.bad, self.section, self.link, self.skip, self.mark = name, bad, section, link, skip, mark


def _cue(token: str) -> str | None:
    """The cue that a class name or id means: the whole of it, its last word but for words like ``box``, or
    its first one if that is loud. ``has-sidebar`` and ``legal-news`` mean none."""
    parts = [p.lower() for p in _CUE_WORD.findall(token)]
    if not parts or STATES.intersection(parts):
        return None
    end = len(parts)
    while end > 1 and parts[end - 1] in CONTAINERS:
        end -= 1
    return parts[end - 1] if parts[end - 1] in CUES else parts[0] if parts[0] in LOUD else None


def _marked(name: str, attributes: str, inside: bool) -> tuple[bool, set[str]]:
    """Whether role or a hidden state make the element boilerplate, and the cues by which its class or id calls it so; the
    header of an article is part of it."""
    named: set[str] = set()
    if not attributes or name in ("html", "body", "main"):
        return False, named
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), unescape(value.strip("\"'"))
        if key in ("class", "id"):
            cues = {c for t in value.split() if (c := _cue(t))}
            if name == "article":
                cues &= OF_ARTICLES
            named |= cues - {"header"} if inside else cues
        value = value.lower()
        if key == "role" and value.strip() in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True, named
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True, named
    return False, named


class _Block:
    __slots__ = ("text", "linked", "bad", "section", "inside", "main", "mark")

    def __init__(self, text: str, linked: int, bad: bool, section: int, inside: bool, main: bool, mark: int):
        self.text, self.linked, self.bad, self.section, self.inside, self.main, self.mark = text, linked, bad, section, inside, main, mark


class _Stack(list):
    """The open elements, and where those of a name, blocks, and blocks that no start tag closes beyond stand, so that a tag finds what it ends in one step."""

    def __init__(self, root: _Element):
        super().__init__([root])
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.walls: list[int] = []

    def add(self, e: _Element) -> None:
        k = len(self)
        self.append(e)
        self.places.setdefault(e.name, []).append(k)
        if e.name in BLOCKS:
            self.blocks.append(k)
            if e.name != "p" and not (e.name[0] == "h" and e.name[1:].isdigit()):
                self.walls.append(k)

    def cut(self, k: int) -> None:
        for e in self[k:]:
            self.places[e.name].pop()
        del self[k:]
        for places in (self.blocks, self.walls):
            while places and places[-1] >= k:
                places.pop()

    def last(self, *names: str) -> int:
        """Place of the last open element of these names; 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)


def page_blocks(html: str) -> list[_Block]:
    """Blocks in page order. Tag soup is closed as browsers do it in the common cases.

    An element that its class or id calls boilerplate holds none if the main element stands in it, or
    the first article of a page that has no article or long block elsewhere."""
    blocks: list[_Block] = []
    root = _Element("", False, 0, False, False, -1)
    # Of each element that its name calls boilerplate (its mark): the mark around it, whether no article can change that, and whether that holds for it or one around.
    around: list[int] = []
    firm: list[bool] = []
    held: list[bool] = []
    lifted: set[int] = set()
    walked: set[int] = set()
    in_mark = -1
    free_article = False
    stack = _Stack(root)
    sections = {0: (False, False)}  # whether a section lies in an article or main element, and in a main one
    pieces: list[str] = []
    linked = breaks = 0

    def flush() -> None:
        nonlocal linked, breaks
        if pieces:
            if text := " ".join("".join(pieces).split()):
                top = stack[-1]
                blocks.append(_Block(text, linked, top.bad, top.section, *sections[top.section], top.mark))
            pieces.clear()
        linked = breaks = 0

    def add(raw: str) -> None:
        nonlocal linked, breaks
        top = stack[-1]
        if raw and not top.skip:
            text = unescape(raw)
            pieces.append(text)
            if text.strip():
                breaks = 0
                if top.link:
                    linked += len(" ".join(text.split()))

    def close(k: int) -> None:
        flush()
        stack.cut(k)

    def lift(k: int) -> None:
        """A main element in it and those around it: none of them is boilerplate but for firm ones."""
        while k >= 0 and k not in walked:
            walked.add(k)
            if not firm[k]:
                lifted.add(k)
            k = around[k]

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        if lt > at:
            add(html[at:lt])
        m = _MARKUP.match(html, lt)
        if m is None:
            after = html[lt + 1 : lt + 3]
            if after[:1].isalpha() and after[:1].isascii() or after[:1] == "/" and after[1:].isalpha():
                at = _LOOSE.match(html, lt).end()  # a tag whose quotes don't end
            else:
                add("<")
                at = lt + 1
            continue
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            k = stack.last(name)
            # An inline end tag doesn't reach beyond its block.
            if name not in BLOCKS and name not in SKIPPED and stack.blocks and stack.blocks[-1] > k:
                k = 0
            if k:
                if name in BLOCKS or stack.blocks and stack.blocks[-1] >= k:
                    close(k)
                else:
                    stack.cut(k)
            elif name in BLOCKS:
                flush()
            continue
        if name == "br":
            breaks += 1
            if breaks > 1:
                flush()
            elif not stack[-1].skip:
                pieces.append(" ")
            continue
        if name in CLOSES_P or name == "li" or name in ("dt", "dd"):
            k = stack.last("li") if name == "li" else stack.last("dt", "dd") if name in ("dt", "dd") else stack.last("p")
            if k and (not stack.walls or stack.walls[-1] <= k):
                close(k)
        if name in BLOCKS:
            flush()
        if name in VOID:
            continue
        top = stack[-1]
        inside, in_main = sections[top.section]
        hidden, named = _marked(name, m[3], inside)
        bad = top.bad or name in BOILERPLATE or name == "header" and not inside or hidden
        mark = top.mark
        if named:
            around.append(mark)
            firm.append(not named.isdisjoint(FIRM))
            held.append(firm[-1] or mark >= 0 and held[mark])
            mark = len(firm) - 1
        if name == "main" and not bad:
            lift(mark)
        elif name == "article" and not bad and not (mark >= 0 and held[mark]):
            free_article = free_article or mark < 0
            in_mark = in_mark if in_mark >= 0 else mark
        section = top.section
        if name in SECTIONS:
            section = len(sections)
            sections[section] = inside or name in ("article", "main"), in_main or name == "main"
        if name in RAW:
            end = _ENDS[name].search(html, at)
            at = end.end() if end else n
            continue
        if m[3].endswith("/") and name not in BLOCKS and name not in SKIPPED:
            continue
        if name == "body" and stack[-1].skip:  # a head that was not closed: all in it is skipped too
            k = len(stack) - 1
            while stack[k - 1].skip:
                k -= 1
            stack.cut(k)
        stack.add(_Element(name, bad, section, top.link or name == "a", top.skip or name in SKIPPED, mark))
    flush()
    if not free_article and not any(len(b.text) >= SHORT_CHARS and not b.bad and b.mark < 0 for b in blocks):
        k = in_mark
        while k >= 0:
            lifted.add(k)
            k = around[k]
    stays: list[bool] = []  # whether a mark, or one around it, makes boilerplate
    for k, outer in enumerate(around):
        stays.append(k not in lifted or outer >= 0 and stays[outer])
    for b in blocks:
        b.bad = b.bad or b.mark >= 0 and stays[b.mark]
    return blocks


def _good(b: _Block) -> bool:
    """Whether a long block has enough stop words."""
    words = _WORD.findall(b.text.lower())
    return bool(words) and sum(w in STOP_WORDS for w in words) >= STOP_DENSITY * len(words)


def _articles_rule(blocks: list[_Block], good: list[bool]) -> bool:
    """Whether the page's text stands in its article and main elements alone: in a main element, or where articles hold no
    less text than the good blocks outside them. Teasers beside a text that has no article of its own don't."""
    held = [b for b in blocks if b.inside and not b.bad]
    if not held or any(b.main for b in held):
        return bool(held)
    return sum(len(b.text) for b in held) >= sum(len(b.text) for b, g in zip(blocks, good, strict=True) if g and not b.inside)


def classify(blocks: list[_Block]) -> list[bool]:
    """Whether each block is main text."""
    open_to = [not b.bad and b.linked <= LINK_DENSITY * len(b.text) for b in blocks]
    good = [free and len(b.text) >= SHORT_CHARS and _good(b) for b, free in zip(blocks, open_to, strict=True)]
    anywhere = _articles_rule(blocks, good)
    labels: list[bool | None] = []
    for b, free, is_good in zip(blocks, open_to, good, strict=True):
        labels.append(False if not free or anywhere and not b.inside else True if is_good else None)
    out = [bool(x) for x in labels]
    n, some = len(blocks), any(labels)
    # Distance and label of the nearest decided, not structurally bad block of the same section, from each side.
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, tuple[int, bool]] = {}
        for i in order:
            b = blocks[i]
            if labels[i] is None:
                if b.section in last:
                    k, label = last[b.section]
                    near[i] = (abs(i - k), label)
            elif not b.bad:
                last[b.section] = (i, labels[i])
    for i, b in enumerate(blocks):
        if labels[i] is None:
            near = [x for x in (before[i], after[i]) if x]
            if not near:
                # No decided block in the section: the section itself decides.
                out[i] = anywhere and b.inside or not anywhere and not some
            elif anywhere and b.inside:
                out[i] = len(near) < 2 or any(label or d > 1 for d, label in near)
            else:
                least = min(d for d, _ in near)
                out[i] = any(label for d, label in near if d == least)
    return out


def main_text(html: str | None) -> str:
    """Main text of one page: its good blocks in page order, one line each."""
    if not html:
        return ""
    blocks = page_blocks(html)
    return "\n".join(b.text for b, good in zip(blocks, classify(blocks), strict=True) if good)


def declared_language(html) -> F.Column:
    """The lang attribute of a page's html element; empty without one."""
    return F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]+)""", 1)


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, url, text and the columns ``keep`` of every row, from the whole html.

    Null and empty pages, and pages without main text, give an empty text. Repeated rows give
    repeated results. Other columns are not read. No row moves.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "html"):
            texts = [main_text(h) for h in block.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("page_id"), block.column("url"), pa.array(texts, pa.string()), *(block.column(c) for c in keep)], ["page_id", "url", "text", *keep])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), *keep)
    kept = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(extract, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string{kept}")
