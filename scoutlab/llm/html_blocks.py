"""Leaf blocks of an HTML page: text with the tags, classes and ids above it."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label map mark meter nobr output "
    "picture progress q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
# Elements whose content is no text of the page.
RAW = "script|style|noscript|template|iframe|object|svg|math|canvas|audio|video|noembed|noframes"
ENDLESS = frozenset(("script", "style"))  # without an end tag they hold the rest of the page, others only their tag
FOREIGN = frozenset(("svg", "math"))      # closed by />
# An opening tag ends the open elements it is listed with, up to a container.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tbody", "tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
    "tfoot": ("thead", "tbody", "tr", "td", "th"), "body": ("head",),
}
SCOPES = frozenset("table ul ol dl select body html div article section".split())

# Attributes as browsers read them: a name, and after = a value that is quoted or
# runs to the next white space or >; a stray quote is part of a name.
_NAME = r"[^\s/>][^\s/>=]*+"
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++)"
_ATTRS = rf"(?:[\s/]++|{_NAME}(?:\s*+=\s*+{_VALUE})?+)*+"
_TOKEN = re.compile(
    rf"<(?P<raw>(?a:{RAW}))(?=[\s/>])(?P<rest>{_ATTRS})>"
    r"|(?P<comment><!--(?:.*?-->|.*)|<[!?][^>]*>?|</[^a-zA-Z][^>]*>?)"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*>?"
    rf"|<(?P<open>[a-zA-Z][^\s/>]*+)(?P<attrs>{_ATTRS})>"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I | re.A) for name in RAW.split("|")}
_ATTR = re.compile(rf"({_NAME})(?:\s*+=\s*+({_VALUE}))?+")
_MARKED = frozenset(("class", "id", "role", "itemprop"))
_UNENDED = re.compile(r"[a-zA-Z]")
_SPLIT = re.compile(r"[^a-z]+")


@dataclass
class Block:
    text: str
    tags: frozenset[str]     # of the elements that hold the block, inline ones aside
    marks: frozenset[str]    # words of the classes, ids and roles above it
    own: str                 # tag of the block's element
    outer: str               # tag of the element around it
    linked: int              # characters inside links
    parent: int              # number of the element that holds the block's element


@dataclass
class _Open:
    """An open element, with what holds for all that is in it: sets are shared with the
    element around where nothing is new, so depth costs nothing."""
    tag: str
    tags: frozenset[str] = frozenset()
    marks: frozenset[str] = frozenset()
    own: str = ""
    outer: str = ""
    number: int = 0
    parent: int = 0


def _marks(attrs: str) -> list[str]:
    found = []
    for name, value in _ATTR.findall(attrs):
        if name.lower() in _MARKED:
            found += [w for w in _SPLIT.split(value.lower()) if len(w) > 1]
    return found


def _inside(around: _Open, tag: str, attrs: str, number: int) -> _Open:
    marks = frozenset(_marks(attrs)) if attrs.strip() else frozenset()
    marks = around.marks if marks <= around.marks else around.marks | marks
    if tag in INLINE:
        return _Open(tag, around.tags, marks, around.own, around.outer, around.number, around.parent)
    tags = around.tags if tag in around.tags else around.tags | {tag}
    return _Open(tag, tags, marks, tag, around.own, number, around.number)


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order; character references are decoded and
    white space inside a block is one space.  Markup that does not end is read
    as far as it goes: from a tag without its > on, the rest is text.  The time is
    linear in the page."""
    out: list[Block] = []
    stack: list[_Open] = []
    count: Counter[str] = Counter()  # open elements by tag
    parts: list[str] = []
    links: list[str] = []
    depth_a = number = pos = 0
    page = page or ""
    unended: set[str] = set()  # no end tag follows, so each name is searched in vain once

    def end_from(at: int) -> None:
        count.subtract(x.tag for x in stack[at:])
        del stack[at:]

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(links)).split()))
                at = stack[-1] if stack else _Open("")
                out.append(Block(text, at.tags, at.marks, at.own, at.outer, linked, at.parent))
            parts.clear()
            links.clear()

    while m := _TOKEN.match(page, pos):
        pos = m.end()
        text, opened, closed, raw = m["text"], m["open"], m["close"], m["raw"]
        if raw is not None:
            name = raw.lower()
            if name in FOREIGN and m["rest"].endswith("/"):
                continue
            end = None if name in unended else _ENDS[name].search(page, pos)
            if end:
                pos = end.end()
            elif name in ENDLESS:
                pos = len(page)
            else:
                unended.add(name)
        elif text is not None:
            if text == "<" and _UNENDED.match(page, pos):
                text, pos = page[pos - 1:], len(page)
            parts.append(text)
            if depth_a:
                links.append(text)
        elif opened is not None:
            tag = opened.lower()
            if tag == "br":
                parts.append(" ")
                continue
            if tag not in INLINE:
                flush()
                depth_a = 0
                if count["p"] > 0:  # a block ends an open paragraph and what is inline in it
                    at = len(stack) - 1
                    while stack[at].tag in INLINE:
                        at -= 1
                    if stack[at].tag == "p":
                        end_from(at)
                ends = CLOSES.get(tag)
                if ends and any(count[x] > 0 for x in ends):
                    at = len(stack) - 1
                    cut = len(stack)
                    while at >= 0 and (stack[at].tag in ends or stack[at].tag in INLINE or stack[at].tag not in SCOPES):
                        if stack[at].tag in ends:
                            cut = at
                        at -= 1
                    end_from(cut)
            elif tag == "a":
                depth_a = 1
            if tag not in VOID and not m["attrs"].endswith("/"):
                number += 1
                stack.append(_inside(stack[-1] if stack else _Open(""), tag, m["attrs"], number))
                count[tag] += 1
        elif closed is not None:
            tag = closed.lower()
            if tag == "a":
                depth_a = 0
            if tag not in INLINE:
                flush()
            if count[tag] > 0:
                for at in range(len(stack) - 1, -1, -1):
                    if stack[at].tag == tag:
                        end_from(at)
                        break
                    if tag in INLINE and stack[at].tag not in INLINE:
                        break
    flush()
    return out
