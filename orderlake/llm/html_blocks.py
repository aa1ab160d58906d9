"""Leaf blocks of an HTML page: runs of text between block-level tags, with their ancestors."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Element kinds of HTML.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li link main menu meta nav noscript ol optgroup option p pre search section "
    "select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements whose text is no text of the page.
UNSHOWN = frozenset("script style template iframe noembed noframes xmp".split())
#: An opening tag ends an open element of these.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "body": {"head"},
}
#: ... but not beyond one of these.
SCOPE = frozenset("ul ol dl table select button article section main div body html td th caption".split())
#: A block in a paragraph ends it, except for these that only look so.
KEEPS_P = frozenset("button iframe link meta noscript option optgroup select textarea title".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # ancestor tags, and words of their classes, ids and roles as ".word"
    linked: int  # characters inside links


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = " ".join("".join(m.groups("")) for m in _NAMED.finditer(attributes))
    # words as they stand, and split where case or digits change: "sideBar-2" gives side, bar, sidebar
    words = {w for part in re.split(r"[\s_-]+", found) for w in (*_PART.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", part).lower()), "".join(_PART.findall(part.lower()))) if w}
    return tuple(sorted(f".{w}" for w in words))


def blocks(page: str | None) -> list[Block]:
    """Blocks with text, in page order."""
    html = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[tuple[str, bool]] = []
    links = 0

    def path() -> tuple[str, ...]:
        return tuple(x for tag, names in stack for x in (tag, *names))

    def flush() -> None:
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                out.append(Block(text, path(), sum(len(p.strip()) for p, linked in parts if linked)))
            parts.clear()

    def text(raw: str) -> None:
        if raw and not any(tag in UNSHOWN for tag, _ in stack):
            parts.append((unescape(raw), links > 0))

    def close(to: int) -> None:
        nonlocal links
        if any(tag in BLOCK for tag, _ in stack[to:]):
            flush()
        links = max(0, links - sum(tag == "a" for tag, _ in stack[to:]))
        del stack[to:]

    at = 0
    while m := _TAG.search(html, at):
        text(html[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if tag == "br":
                parts.append((" ", False))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if tag not in BLOCK and stack[k][0] in BLOCK:
                    break  # an inline end tag does not end a block
            continue
        if tag in BLOCK:
            flush()
            ends = ENDS.get(tag, set()) | (set() if tag in KEEPS_P else {"p"})
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    close(k)
                elif stack[k][0] in SCOPE:
                    break
        elif tag == "br":
            parts.append((" ", False))
        if tag in VOID or (m.group(3).endswith("/") and tag not in BLOCK):
            continue
        stack.append((tag, _names(m.group(3))))
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            text(html[at : end.start() if end else len(html)])
            at = end.start() if end else len(html)
    text(html[at:])
    flush()
    return out
