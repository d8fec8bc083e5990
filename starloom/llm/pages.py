"""One HTML page as a small tree of labelled nodes and its blocks of text in order.

Repeated siblings of one label are one node, so a tree has the size of the
page's layout, not of its text. Inline markup belongs to the block around it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*(?:>|\Z)|<[A-Za-z][^>]*\Z""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PART = re.compile(r"[a-z]+")

# Elements of HTML by kind, and names that authors give to parts of a page.
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var".split()
)
FRAME = frozenset("html head body".split())
#: Elements whose neighbours of one kind are items of one list.
ITEMS = frozenset("p li dt dd tr td th h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption option".split())
CLOSED_BY_LIKE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
ASIDE_TAGS = frozenset("nav footer aside form button select option object dialog".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements adsense adbox adslot sponsor sponsored promo promotion promoted banner"
    " nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar sidebar aside widget widgets related recommended"
    " trending popular footer colophon cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe"
    " subscription signup login search share sharing social comment comments commentlist disqus reply replies respond".split()
)
#: Names of parts above the article; inside it they head the article.
HEAD_NAMES = frozenset("header masthead topbar".split())

#: Children of a node beyond which equal labels fall together and, four times as many, all labels of one kind;
#: and the greatest depth (deeper elements belong to the node above). This bounds trees, not texts.
WIDE, DEEP = 64, 200
_PLAIN = {"aside": "aside", "head": "header", "article": "article", "main": "main", "": "div"}


@dataclass
class Page:
    """``parents`` and ``labels`` by node, node 0 is the body; ``blocks`` are (node, text, characters in links)."""

    parents: list[int] = field(default_factory=lambda: [-1])
    labels: list[str] = field(default_factory=lambda: ["body"])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _label(tag: str, attributes: str) -> str:
    """The tag, the letters of its class, id and role, and what it says about itself."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
    names = [" ".join(_NAME_PART.findall(found.get(key, ""))) for key in ("class", "id", "role", "itemprop")]
    return "|".join([tag, *names]).rstrip("|")


def kind(label: str) -> str:
    """"aside" for parts beside the article, "head" for parts above it, "article" or "main" for the article, else ""."""
    tag, *names = label.split("|")
    names += [""] * (4 - len(names))
    words = [w for w, before in zip(names[0].split() + names[1].split(), [""] + (names[0].split() + names[1].split())[:-1]) if before not in ("has", "with", "no")]
    if tag in ASIDE_TAGS or names[2] in ASIDE_ROLES or not ASIDE_NAMES.isdisjoint(words):
        return "aside"
    if tag == "header" or not HEAD_NAMES.isdisjoint(words):
        return "head"
    if tag == "article" or "articlebody" in names[3]:
        return "article"
    return "main" if tag == "main" or names[2] == "main" else ""


def parse(text: str) -> Page:
    """The tree and the blocks. Broken markup is read as browsers do: a block closes an open paragraph, ends match the next open start."""
    page = Page()
    parents, labels, blocks = page.parents, page.labels, page.blocks
    children: list[list[int]] = [[]]
    newest: list[dict[str, int]] = [{}]
    depth, places = [0], [0]
    opened: Counter[str] = Counter()
    stack: list[tuple[str, int]] = [("body", 0)]
    cursor = {0: 0}
    buffer: list[str] = []
    linked = at = 0
    in_link = False

    def flush() -> None:
        nonlocal linked
        if buffer:
            block = " ".join("".join(buffer).split())
            if block:
                blocks.append((stack[-1][1], block, min(linked, len(block))))
            buffer.clear()
        linked = 0

    def enter(tag: str, label: str) -> None:
        above = stack[-1][1]
        opened[tag] += 1
        if depth[above] >= DEEP:
            stack.append((tag, above))
            return
        same = children[above]
        if len(same) >= 4 * WIDE and label not in newest[above]:
            label = _PLAIN[kind(label)]
        if len(same) < WIDE:
            node = next((c for c in same[cursor[above] :] if labels[c] == label), -1)
        else:
            node = newest[above].get(label, -1)
        if node < 0:
            node = len(labels)
            parents.append(above), labels.append(label), children.append([]), newest.append({})
            depth.append(depth[above] + 1), places.append(len(same))
            same.append(node)
            newest[above][label] = node
        cursor[above] = places[node] + (tag not in ITEMS and "|" not in label)
        cursor[node] = 0
        stack.append((tag, node))

    def close(tag: str, limits: tuple[str, ...]) -> None:
        """Leaves the nearest open element of a name, unless one of the limits is nearer."""
        if not opened[tag]:
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                flush()
                opened.subtract(t for t, _ in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in limits:
                return

    while True:
        found = _TOKEN.search(text, at)
        piece = text[at : found.start()] if found else text[at:]
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            buffer.append(piece)
            if in_link:
                linked += len(piece.strip())
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        ends, tag = found[1], found[2].lower()
        if tag in FRAME:
            continue
        if tag in RAW:
            if not ends and not (found[3].endswith("/") and tag in ("svg", "math")):
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(text, at)
                at = stop.end() if stop else len(text)
            continue
        if tag == "br" or tag in VOID:
            if tag in ("br", "hr"):
                buffer.append("\n")
            continue
        if ends:
            if tag == "a":
                in_link = False
            elif tag not in INLINE:
                in_link = False
                close(tag, ())
            else:
                close(tag, ("p", "div", "td", "li"))
            continue
        label = _label(tag, found[3])
        if tag in INLINE and not (label != tag and kind(label) == "aside"):
            in_link = in_link or tag == "a"
            continue
        flush()
        if tag not in INLINE:
            close("p", ("td", "th", "button", "object"))
            if tag in CLOSED_BY_LIKE:
                for like in ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,):
                    close(like, CLOSED_BY_LIKE[tag])
                if tag == "tr":
                    close("tr", ("table",))
        enter(tag, label)
    flush()
    return page
