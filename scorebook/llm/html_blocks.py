"""Leaf blocks of a web page: runs of text between block-level tags, with the open tags around them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements whose content is no text of the page. Those of RAW hold no tags and run to their end tag or the
#: end of the page, as a template does; the others, left open, lose their own tag only. MathML's annotations are not shown.
RAW = frozenset("script style textarea title iframe noscript".split())
NESTED = frozenset("template svg object select annotation annotation-xml".split())
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW}
_UNSEEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)(script|style|textarea|title|iframe|noscript|template|svg|object|select"
                     r"|annotation-xml|annotation)(?=[\s/>])((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*>|[^>]*(?:>|\Z))", re.S | re.I)
#: Elements that end an svg they begin in, unless they are inside a foreignObject.
_NO_SVG = re.compile(r"<(?:/p|/br|p|div|h[1-6]|ul|ol|dl|li|table|blockquote|pre|span|img|br|body|head)(?=[\s/>])"
                     r"|(<foreignObject)(?=[\s/>])", re.I)
#: A tag with well-formed quotes, any other tag, a declaration, or text.
_TOKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*)>|</?[a-zA-Z][^>]*(?:>|$)|<[!?/][^>]*(?:>|$)"
                    r"|([^<]+|<)", re.S)
_BROKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)")
_NAMES = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Block-level elements.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol "
                  "option p pre section summary table tbody td tfoot th thead tr ul hr".split())
#: Elements without content; a new element of these kinds ends an open one of the same list entry.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tag names, and words of class, id and role as ".word", outermost first
    linked: int  # characters inside links


def _words(attributes: str) -> list[str]:
    out = []
    if "=" in attributes:
        for m in _NAMES.finditer(attributes):
            out += ["." + p.lower() for p in _PART.findall(m[2] or m[3] or m[4] or "")]
    return out


def _seen(page: str) -> str:
    """The page without comments and elements whose content is no text of it."""
    cuts: list[tuple[int, int, bool]] = []  # start, end, svg
    open_: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {t: [] for t in NESTED}  # of the open elements of a kind
    endless: set[str] = set()
    at = 0
    while m := _UNSEEN.search(page, at):
        at = m.end()
        if m[2] is None:
            cuts.append((*m.span(), False))
            continue
        tag, empty = m[2].lower(), m[3].endswith("/>")
        if tag in RAW:
            foreign = bool(open_) and open_[-1][0] == "svg"
            if m[1] or foreign and (empty or tag in endless):
                continue
            end = _RAW_END[tag].search(page, at)
            if end:
                at = end.end()
            elif foreign:
                endless.add(tag)
                continue
            else:
                at = len(page)
            cuts.append((m.start(), at, False))
        elif not m[1]:
            if not empty or tag in ("template", "object", "select"):  # the others are foreign elements
                places[tag].append(len(open_))
                open_.append((tag, m.start()))
        elif places[tag] and places[tag][-1] >= max(places["template"][-1:], default=0):  # a template has a scope of its own
            i = places[tag][-1]
            cuts.append((open_[i][1], at, tag == "svg"))
            while len(open_) > i:
                places[open_.pop()[0]].pop()
    cuts += [(open_[i][1], len(page), False) for i in places["template"][:1]]
    out, at = [], 0
    for start, end, svg in sorted(cuts):
        if start >= at:
            out.append(page[at:start])
            ends = svg and _NO_SVG.search(page, start, end)
            at = ends.start() if ends and not ends[1] else end
    return "".join(out) + page[at:]


def blocks(page: str | None) -> list[Block]:
    """The page's blocks in order. White space in a block is one space; a null page has none."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, list[str]]] = []
    parts: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, tuple(w for tag, names in stack for w in (tag, *names)), min(linked, len(text))))
            parts.clear()
        linked = 0

    for m in _TOKEN.finditer(_seen(page)):
        text = m[4]
        if text is not None:
            parts.append(html.unescape(text))  # by run: a reference does not reach over a tag
            if links:
                linked += len(text)
            continue
        closing, tag, attributes = m[1], m[2], m[3]
        if tag is None:
            m = _BROKEN.match(m[0])
            if m is None:
                continue
            closing, tag, attributes = m.groups()
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in BLOCK:
            flush()
            links = 0
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            elif tag not in VOID:
                if stack and stack[-1][0] == "p":  # a paragraph ends where any block begins
                    stack.pop()
                while stack and stack[-1][0] in CLOSES.get(tag, ()):
                    stack.pop()
                stack.append((tag, _words(attributes)))
    flush()
    return out
