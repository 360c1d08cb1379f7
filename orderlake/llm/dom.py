"""A small tolerant HTML reader for template induction: element trees without attributes.

Only what a page's shape and its text need: start and end tags with implied ends, void elements, raw
text (scripts, styles) skipped whole, comments skipped.  A block of inline content becomes one
:class:`Run`; inline elements leave no node.  Every scan is linear in the page, and elements nested
deeper than ``DEPTH`` become children of the element at that depth, so no page can exhaust the stack.
"""

from __future__ import annotations

import html
import re

DEPTH = 60

# Element names of the HTML standard and the words by which pages name their furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video select xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var".split())
FURNITURE = frozenset("nav header footer aside form button menu dialog fieldset".split())
FURNITURE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navigation navbar menu breadcrumb "
                            "breadcrumbs sidebar header footer masthead cookie cookies consent notice notification alert popup modal newsletter "
                            "subscribe signup login share sharing social related recommended comment comments disqus respond replies form "
                            "search pagination pager copyright".split())
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
NOT_A_NAME = frozenset("has no with without is not".split())
WHOLE = frozenset("html body main article".split())
#: An opening tag ends these open elements first, up to the named borders.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
        "option": ({"option"}, {"select", "datalist"})}
BORDERS = frozenset("table td th caption button".split())

TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|[="'])*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}


class Node:
    """An element: its label (name and class), children, whether its name or class says page furniture."""

    __slots__ = ("label", "tag", "kids", "furniture", "link", "slot")

    def __init__(self, tag: str, label: str, furniture: bool, link: bool):
        self.tag, self.label, self.furniture, self.link = tag, label, furniture, link
        self.kids: list = []
        self.slot = None


class Run:
    """A block of inline text with white space made single; ``linked`` counts the characters inside links."""

    __slots__ = ("text", "linked", "slot")
    label, kids, furniture = "#", (), False

    def __init__(self, text: str, linked: int):
        self.text, self.linked = text, linked
        self.slot = None


def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """Label of an element, and whether it is page furniture by its name, class, id or role."""
    label, words = tag, set(tag.split("-")) if "-" in tag else set()
    low = attributes.lower()
    if "class" in low or "id" in low or "role" in low:
        for name, a, b, c in NAMES.findall(attributes):
            value = html.unescape(a or b or c).lower()
            for word in value.split():
                pieces = re.split("[-_]+", word)
                if pieces[0] not in NOT_A_NAME:
                    words.add(pieces[0])
                    words.add(pieces[-1])
            if name.lower() == "class":
                label += "." + re.sub("[0-9]+", "0", " ".join(sorted(value.split())[:4]))[:80]
    if tag in WHOLE:
        return label, False
    return label, tag in FURNITURE or not FURNITURE_WORDS.isdisjoint(words) or bool(HIDDEN.search(attributes))


def parse(page: str) -> Node:
    """The tree below ``html``.  Text outside any element belongs to the root; an empty page is a bare root."""
    root = Node("html", "html", False, False)
    stack = [root]
    pieces: list[str] = []
    linked, in_link, mute = 0, False, []
    too_deep: dict[str, int] = {}                            # open elements that have no node of their own

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                stack[-1].kids.append(Run(text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def pop_to(index: int):
        nonlocal in_link
        flush()
        in_link = stack[index].link
        del stack[index:]

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        start = m.start() if m else end
        if start > at and not mute:
            piece = page[at:start]
            if "&" in piece:
                piece = html.unescape(piece)
            pieces.append(piece)
            if in_link:
                linked += len(piece)
        if m is None:
            break
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag or page[at - 1] != ">":                    # no element, or cut off inside its tag
            continue
        closing, attributes = m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if closing:
            if tag in INLINE or (tag not in WHOLE and "-" in tag):
                if mute and mute[-1] == tag:
                    mute.pop()
                if tag == "a":
                    in_link = False
                continue
            if too_deep.get(tag):
                too_deep[tag] -= 1
                flush()
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    mute.clear()
                    pop_to(k)
                    break
                if stack[k].tag in BORDERS and tag not in ("table", "tr", "body", "html"):
                    break
            continue
        if tag in RAW:
            m = RAW_END[tag].search(page, at) if not attributes.endswith("/") or tag not in ("svg", "math") else None
            at = m.end() if m else (at if attributes.endswith("/") and tag in ("svg", "math") else end)
            pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                pieces.append(" " if tag == "br" else "")
            continue
        if tag in INLINE or "-" in tag:
            furniture = _named(tag, attributes)[1]
            if mute:
                if mute[-1] == tag:
                    mute.append(tag)
            elif furniture:
                mute.append(tag)
            if tag == "a":
                in_link = True
            continue
        if tag in ("html", "head", "body"):
            flush()
            if tag == "body" and len(stack) == 1:
                body = Node("body", "body", False, False)
                root.kids.append(body)
                stack.append(body)
            continue
        mute.clear()
        label, furniture = _named(tag, attributes)
        flush()
        for k in range(len(stack) - 1, 0, -1):               # an open paragraph ends where a block begins
            if stack[k].tag == "p":
                pop_to(k)
                break
            if stack[k].tag in BORDERS:
                break
        if tag in ENDS:
            closes, borders = ENDS[tag]
            cut = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in borders:
                    break
                if stack[k].tag in closes:
                    cut = k
            if cut is not None:
                pop_to(cut)
        if len(stack) < DEPTH:
            node = Node(tag, label, furniture or stack[-1].furniture, in_link)
            stack[-1].kids.append(node)
            stack.append(node)
        else:
            too_deep[tag] = too_deep.get(tag, 0) + 1
    flush()
    return root
