"""Pages as sequences of leaf blocks: one scan over the tags, open elements on a stack.

A block knows its innermost element and an element its parent, so a page takes time and memory in proportion to its length, however deep it nests.
"""

from __future__ import annotations

import html
import re

# Fixed values of HTML.
BLOCK_TAGS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template iframe object svg textarea noframes".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[^\W\d_]+")


class Element:
    """An open tag: names, the words in its attributes; number, its place in the page, above its parent's; title, whether it is in a title."""

    __slots__ = ("tag", "names", "number", "parent", "title", "block_at")

    def __init__(self, tag: str, names: tuple[str, ...], number: int, parent: Element | None, block_at: int):
        self.tag, self.names, self.number, self.parent = tag, names, number, parent
        self.title = tag == "title" or parent is not None and parent.title
        self.block_at = block_at  # where on the stack the nearest block element is, itself included


class Block:
    """Text of one leaf: element, the innermost open one; linked, characters inside links; raw: no text of the page, as a title."""

    __slots__ = ("element", "text", "linked", "raw")

    def __init__(self, element: Element | None, text: str, linked: int):
        self.element, self.text, self.linked = element, text, linked
        self.raw = element is not None and element.title

    def path(self) -> list[Element]:
        """The open elements from the root on."""
        found, e = [], self.element
        while e is not None:
            found.append(e)
            e = e.parent
        return found[::-1]


def names_of(attrs: str) -> tuple[str, ...]:
    """The words of the attributes that say what an element is for."""
    found: list[str] = []
    for key, *values in _ATTRIBUTE.findall(attrs):
        found += [key.lower()] if key.lower() in ("hidden",) else _NAME.findall("".join(values).lower())
    return tuple(found)


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, white space inside each made one space. Unclosed elements end with the block that holds them."""
    out: list[Block] = []
    stack: list[Element] = []
    places: dict[str, list[int]] = {}  # where on the stack each tag is
    parts: list[str] = []
    linked = opened = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            out.append(Block(stack[-1] if stack else None, text, linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text)
            parts.append(text)
            if places.get("a"):
                linked += len(text)

    def leave(k: int) -> None:
        """Close the elements from place k on."""
        for e in stack[k:]:
            places[e.tag].pop()
        del stack[k:]

    def block_at() -> int:
        return stack[-1].block_at if stack else -1

    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            add(m["cdata"])
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag == "br":
            parts.append(" ")
        elif m["close"]:
            if tag in BLOCK_TAGS:
                flush()
            found = places.get(tag)
            # An inline end tag doesn't close the block around it.
            if found and (tag in BLOCK_TAGS or found[-1] > block_at()):
                leave(found[-1])
        elif tag in RAW_TAGS and not m["attrs"].rstrip().endswith("/"):
            flush()
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag in VOID_TAGS:
            if tag in BLOCK_TAGS:
                flush()
        else:
            if tag in BLOCK_TAGS:
                flush()
                closes = CLOSES.get(tag, ())
                while (k := block_at()) >= 0 and stack[k].tag in closes:
                    leave(k)
            opened += 1
            k = len(stack)
            places.setdefault(tag, []).append(k)
            stack.append(Element(tag, names_of(m["attrs"]), opened, stack[-1] if stack else None, k if tag in BLOCK_TAGS else block_at()))
    flush()
    return out
