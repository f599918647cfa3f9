"""HTML to leaf blocks: the runs of text between block-level tags, with their ancestors."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

#: Fixed values of HTML: elements that start a new block, that have no content, whose content is no text
#: and, of these, those that only their own end tag ends.
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section"
    " select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
SKIPPED = set("applet audio canvas iframe noembed noframes object script style svg template textarea video".split())
RAW = set("iframe noembed noframes script style textarea".split())
#: Opening one of these ends an open one of its group.
SIBLINGS = {x: g for g in (("li",), ("dt", "dd"), ("td", "th"), ("tr",), ("option",), ("thead", "tbody", "tfoot")) for x in g}

TAG = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|[!?][^>]*+>?|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>?)""", re.S
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORD = re.compile("[a-z]+")
MARK = "data-main"  # on labelled pages, of elements whose text is main text

#: What words in class, id and role tell of an element.
HINTS = {
    "ad": "ad ads adv advert advertisement adsense sponsor sponsored promo promotion promoted banner",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toolbar tabs pager pagination skip sitemap",
    "side": "sidebar side aside widget widgets related recommended recommendations trending popular rail complementary teaser",
    "comment": "comment comments commentlist reply replies respond disqus discussion",
    "foot": "footer foot copyright legal colophon bottom contentinfo",
    "head": "header masthead top logo branding brand",
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay message notification paywall",
    "share": "share sharing social follow",
    "form": "form login signin signup subscribe subscription newsletter search register contact",
    "main": "article content post entry story main body text prose",
    "meta": "meta byline author date time tags category published",
}
HINT_OF = {w: h for h, words in HINTS.items() for w in words.split()}


#: What follows one of these in a name tells of something beside the element or missing in it.
BESIDE = {"has", "no", "not", "with", "without", "hide", "hides", "show", "shows"}
#: Names on the whole page tell of its layout, not of its text.
ROOTS = {"html", "body"}


@dataclass(slots=True, eq=False)
class Element:
    tag: str
    hints: frozenset[str]  # of its own names
    parent: Element | None
    depth: int
    marked: bool
    text: int = 0  # characters of text outside of links, at the end with those of all elements in it
    holds: bool = False  # a headline of the page or a main element


@dataclass(slots=True)
class Block:
    at: Element | None  # its own element
    text: str
    linked: int  # characters within links, of the undecoded text
    size: int

    @property
    def marked(self) -> bool:
        return self.at is not None and self.at.marked

    @property
    def tags(self) -> tuple[str, ...]:
        """From the root to the block's own element."""
        return tuple(e.tag for e in reversed(list(self.way())))

    @property
    def hints(self) -> frozenset[str]:
        """Of all its elements."""
        return frozenset(h for e in self.way() for h in e.hints)

    def way(self) -> Iterator[Element]:
        e = self.at
        while e is not None:
            yield e
            e = e.parent


def hints_of(tag: str, attrs: str) -> frozenset[str]:
    if not attrs or tag in ROOTS:
        return frozenset()
    found = set()
    for _, value in ATTRIBUTE.findall(attrs):
        for name in value.strip("\"'").split():
            for word in WORD.findall(name.lower()):
                if word in BESIDE:
                    break
                if word in HINT_OF:
                    found.add(HINT_OF[word])
    return frozenset(found)


def opens_skipped(tag: str, attrs: str) -> bool:
    return tag in SKIPPED and (not attrs.rstrip().endswith("/") or tag in ("script", "style", "textarea"))


def raw_end(html: str, tag: str, at: int) -> int:
    end = re.compile(f"</{tag}\\b[^>]*>?", re.I).search(html, at)
    return end.end() if end else len(html)


def skipped_ends(html: str, at: int, blocks: list[str]) -> dict[int, int]:
    """Start and end of the skipped elements from ``at`` on, but raw ones, whose end tag comes before that of a block around them.

    ``blocks`` are open at the start. One pass, so many elements without an end cost no more.
    """
    ends: dict[int, int] = {}
    stack = [(b, -1) for b in blocks]
    held = Counter(blocks)
    while m := TAG.search(html, at):
        at = m.end()
        tag = (m["name"] or "").lower()
        if m["close"]:
            if held[tag]:
                name, start = "", 0
                while name != tag:
                    name, start = stack.pop()
                    held[name] -= 1
                if tag in SKIPPED:
                    ends[start] = at
        elif tag in RAW and opens_skipped(tag, m["attrs"]):
            at = raw_end(html, tag, at)
        elif tag in BLOCK and tag not in VOID or opens_skipped(tag, m["attrs"] or ""):
            stack.append((tag, m.start()))
            held[tag] += 1
    return ends


def parse(html: str) -> list[Block]:
    """The blocks of a page in order; character references are decoded, white space is one space.

    A skipped element without an end tag of its own runs to the end of the page if it is raw;
    of others only the tag is skipped.
    """
    blocks: list[Block] = []
    stack: list[Element] = []
    made: list[Element] = []
    buffer: list[str] = []
    linked = 0
    link_at = -1  # depth of the stack where a link opened
    ends: dict[int, int] | None = None  # of skipped elements, from the first one on

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                size = sum(map(len, buffer))
                blocks.append(Block(stack[-1] if stack else None, text, linked, size))
                if stack:
                    stack[-1].text += max(0, size - linked)
            buffer.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal link_at
        del stack[depth:]
        if link_at > depth:
            link_at = -1

    def write(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text) if "&" in text else text
            buffer.append(text)
            if link_at >= 0:
                linked += len(text)

    at = 0
    while True:
        m = TAG.search(html, at)
        write(html[at : m.start() if m else len(html)])
        if not m:
            break
        at = m.end()
        if m["name"] is None:
            continue
        tag = m["name"].lower()
        if tag == "br":
            buffer.append(" ")
        elif m["close"]:
            if tag == "a":
                link_at = -1
            elif tag in BLOCK:
                flush()
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
                if depth is not None:
                    close(depth)
        elif tag in SKIPPED:
            if opens_skipped(tag, m["attrs"]):
                if tag in RAW:
                    at = raw_end(html, tag, at)
                else:
                    if ends is None:
                        ends = skipped_ends(html, m.start(), [e.tag for e in stack])
                    at = ends.get(m.start(), at)
        elif tag == "a":
            link_at = len(stack)
        elif tag in BLOCK:
            flush()
            if stack and stack[-1].tag == "p":
                close(len(stack) - 1)
            if stack and tag in SIBLINGS and stack[-1].tag in SIBLINGS and SIBLINGS[stack[-1].tag] == SIBLINGS[tag]:
                close(len(stack) - 1)
            if tag not in VOID:
                attrs, over = m["attrs"], stack[-1] if stack else None
                marked = (over is not None and over.marked or MARK + '="1"' in attrs) and MARK + '="0"' not in attrs
                stack.append(Element(tag, hints_of(tag, attrs), over, len(stack), marked))
                made.append(stack[-1])
    flush()
    for e in reversed(made):  # what an element holds, its parent holds
        e.holds |= e.tag in ("h1", "main")
        if e.parent is not None:
            e.parent.text += e.text
            e.parent.holds |= e.holds
    return blocks
