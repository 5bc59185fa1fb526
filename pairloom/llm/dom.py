"""Leaf blocks of web pages: stretches of text between block-level tags, with their open ancestors."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

# Fixed values of HTML: elements that begin a block of their own, those whose content is no markup of the page,
# those without an end tag.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select"
    " summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style template iframe textarea".split())
#: What they hold is shown where the element itself is not: a block of its own, which may stand inside a paragraph.
INSTEAD = frozenset("noscript object canvas audio video".split())
UNSEEN = {"svg": frozenset("title desc metadata defs symbol".split()), "math": frozenset(["annotation", "annotation-xml"])}
REVEALED = frozenset("body main article".split())  # scripts show these once a page is loaded
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the key ends an open element of the value without its end tag, within the stop elements.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
STOPS = frozenset("ul ol dl table select article section div body main aside nav".split())
P_ENDS = BLOCK - {"option", "optgroup", "caption", "legend", "summary"}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
DEEPEST = 512  # open elements; deeper ones begin blocks but are not kept open, as in browsers
CLOSES = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.IGNORECASE) for t in RAW | INSTEAD}
OPENS_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.IGNORECASE)
NO_TEXT = re.compile(r"(?>\s+|<!--.*?-->|<(?![/!])[^>]*>)*+", re.DOTALL)
CLOSED = re.compile(r"</([a-z]+)", re.IGNORECASE)
NAMED = re.compile(r"(?:^|[\s\"'/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
NAME_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]  # open block elements from the outermost to the block's own
    names: frozenset[str]  # words of their classes, ids and roles
    nearest: tuple[str, ...]  # those of the innermost element that has any
    link_chars: int
    hidden: bool = False  # in an element that is not shown at first


def marks(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Begin and end of each tag, comment or declaration, and of tags the slash, the name and the attributes.

    Each character is looked at a bounded number of times. Quotes may hold a ``>``; behind a tag whose quotes never close,
    tags end at their first ``>``. What never ends is text, except for a comment.
    """
    at, last, quotes = 0, page.rfind(">"), True
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            yield start, at, "", "", ""
        elif start > last:
            at = page.find("<!--", start)
            if at < 0:
                return
        elif named := TAG_NAME.match(page, start):
            m = TAG.match(page, start) if quotes else None
            quotes = m is not None
            at = m.end() if m else page.index(">", start) + 1
            yield start, at, named[1], named[2].lower(), m[3] if m else page[named.end() : at - 1]
        elif page[start + 1] in "!?/":
            at = page.index(">", start) + 1
            yield start, at, "", "", ""
        else:
            at = start + 1


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = NAMED.findall(attributes)
    spaced = " ".join(re.sub("([a-z])([A-Z])", r"\1 \2", a or b or c) for a, b, c in found)
    return tuple(NAME_PARTS.findall(spaced.lower()))


def _is_hidden(attributes: str) -> bool:
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" and value.lower() != "until-found" or name == "style" and NO_DISPLAY.search(value):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Blocks with text, in page order. Comments, scripts and styles are left out; character references are decoded;
    white space is one space. Broken markup is read as browsers roughly do: unclosed paragraphs and list items end where
    the next begins, stray end tags are passed over. Of an unclosed script or the like, what comes before the next block
    is left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], frozenset[str], bool]] = []  # tag, names, all names so far, hidden
    is_open: Counter = Counter()
    parts: list[str] = []
    links = link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                _, _, names, hidden = stack[-1] if stack else ("", (), frozenset(), False)
                nearest = next((own for _, own, _, _ in reversed(stack) if own), ())
                out.append(Block(text, tuple(t for t, *_ in stack), names, nearest, link_chars, hidden))
            parts.clear()
        link_chars = 0

    def push(tag: str, attributes: str) -> None:
        if len(stack) == DEEPEST:
            return
        own = _names(attributes)
        names, hidden = (stack[-1][2], stack[-1][3]) if stack else (frozenset(), False)
        hidden = hidden or tag not in REVEALED and _is_hidden(attributes)
        stack.append((tag, own, names.union(own) if own else names, hidden))
        is_open[tag] += 1

    def close(upto: int) -> None:
        flush()
        is_open.subtract(t for t, *_ in stack[upto:])
        del stack[upto:]

    def close_last(tag: str) -> None:
        if is_open[tag]:
            close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))

    drawn = unseen = ""  # the open svg or math, the open element whose text is not shown
    ends: dict[str, re.Match | None] = {}
    no_text = 0, -1  # a stretch of markup without text

    def closed(tag: str, at: int) -> re.Match | None:
        if tag not in ends or ends[tag] and ends[tag].start() < at:
            ends[tag] = CLOSES[tag].search(page, at)
        return ends[tag]

    at = 0
    for start, end, slash, tag, attributes in marks(page):
        if start < at:  # inside a script or the like
            continue
        if start > at and not unseen:
            parts.append(page[at:start])
            if links:
                link_chars += start - at
        at = end
        if not tag:
            continue
        if drawn and tag in UNSEEN[drawn]:
            if slash:
                unseen = "" if tag == unseen else unseen
            elif not attributes.endswith("/"):
                unseen = unseen or tag
        elif tag in UNSEEN:
            drawn, unseen = "" if slash or attributes.endswith("/") else tag, ""
        elif tag in RAW:
            if not slash:
                found = closed(tag, at)
                behind = None if found else OPENS_BLOCK.search(page, at)
                at = found.end() if found else behind.start() if behind else len(page)
        elif tag in INSTEAD:
            if slash:
                close_last(tag)
            elif not closed(tag, at):
                unseen = tag if tag == "noscript" else unseen
            else:
                if not no_text[0] <= at <= no_text[1]:
                    no_text = at, NO_TEXT.match(page, at).end()
                next_end = CLOSED.match(page, no_text[1])
                if not (next_end and next_end[1].lower() == tag):
                    flush()
                    push(tag, attributes)
        elif tag == "a":
            links = 0 if slash else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            drawn = unseen = ""
            flush()
            if slash:
                close_last(tag)
                continue
            if tag in P_ENDS and stack and stack[-1][0] == "p":
                close(len(stack) - 1)
            if wanted := ENDS.get(tag):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in wanted:
                        close(i)
                        break
                    if stack[i][0] in STOPS:
                        break
            if tag not in VOID:
                push(tag, attributes)
    if at < len(page) and not unseen:
        parts.append(page[at:])
    flush()
    return out
