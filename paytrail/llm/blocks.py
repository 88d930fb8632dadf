"""Pages as sequences of text blocks, with what is known of each block's place in the page.

A block is the text between two block-level tags.  Its place is the set of hashed
tokens of the elements around it: tag names, and the words of class, id, role and
itemprop.  The set is shared by blocks of one element and bounded by PATH_BUCKETS,
however deep a page nests.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

# Element names of the HTML standard.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
DROPPED = set("applet audio button canvas datalist head iframe math noembed noframes noscript object option script select style svg template textarea title video xmp".split())
#: Of these, the ones whose content is not markup.
RAW = set("iframe noembed noframes script style textarea title xmp".split())
#: Elements that a start tag ends, and those beyond which it does not look.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"?|'[^']*+'?)?+)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|itemprop|aria-hidden|hidden|style)\s*+(?:=\s*+("[^"]*+"?|'[^']*+'?|[^\s>]*+))?""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PATH_BUCKETS = 4096


@dataclass(slots=True)
class Block:
    tag: str
    words: frozenset[str]  # of class, id, role and itemprop around it, and the names of its elements as <name>
    path: frozenset[int]
    text: str
    linked: int  # characters inside links


class Element:
    __slots__ = ("tag", "words", "path")

    def __init__(self, tag: str, words: frozenset, path: frozenset):
        self.tag, self.words, self.path = tag, words, path


def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % PATH_BUCKETS


def own_words(tag: str, attributes: str) -> set[str]:
    """Words of an element, without digits and plural s."""
    found = {f"<{tag}>"}
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and UNSEEN.search(value):
            found.add("hidden")
        elif name in {"class", "id", "role", "itemprop"}:
            for part in PART.findall(value):
                part = part.lower()
                found.add(part[:-1] if len(part) > 3 and part.endswith("s") and not part.endswith("ss") else part)
    return found


def read_blocks(page: str) -> list[Block]:
    """The blocks of a page in order; white space inside is one space, and there are no empty ones."""
    out: list[Block] = []
    stack = [Element("", frozenset(), frozenset())]
    text: list[str] = []
    links, linked, skip = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                top = next(e for e in reversed(stack) if e.tag not in INLINE)
                out.append(Block(top.tag, top.words, top.path, joined, min(linked, len(joined))))
            text.clear()
        linked = 0

    def pop_to(size: int) -> None:
        nonlocal links
        for e in stack[size:]:
            links -= e.tag == "a"
        del stack[size:]

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            piece = html.unescape(page[at:end])
            text.append(piece)
            if links:
                linked += len(piece.strip())
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if tag in INLINE:
                if place:
                    links -= tag == "a"
                    del stack[place]
                continue
            flush()
            if place:
                pop_to(place)
            continue
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif tag not in VOID:
                links += tag == "a"
                stack.append(Element(tag, stack[-1].words, stack[-1].path))
            continue
        flush()
        if tag in DROPPED:
            at = _after(page, tag, at, found[3])
            continue
        if tag in VOID:
            continue
        ends, stops = ENDS.get(tag, ({"p"}, set()))
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ends:
                pop_to(i)
                break
            if stack[i].tag in stops or "p" in ends and stack[i].tag not in INLINE:
                break
        around = stack[-1]
        words = own_words(tag, found[3])
        held = around.words if words <= around.words else around.words | words
        path = frozenset(map(bucket, held)) if held is not around.words else around.path
        stack.append(Element(tag, held, path))
    flush()
    return out


def _after(page: str, tag: str, at: int, attributes: str) -> int:
    """Where the content of a dropped element ends; nested ones of the same name are counted, but in raw text."""
    if attributes.endswith("/") and tag in {"svg", "math"}:
        return at
    depth = 1
    for found in _limits(tag).finditer(page, at):
        depth += -1 if found[1] else tag not in RAW
        if not depth:
            return found.end()
    # Without an end: raw text goes on to the end of the page, of others only the tag is lost.
    return len(page) if tag in RAW else at


def _limits(tag: str) -> re.Pattern:
    """Start and end tags of that name."""
    if tag not in _compiled:
        _compiled[tag] = re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I)
    return _compiled[tag]


_compiled: dict[str, re.Pattern] = {}
