"""A small tolerant reader of HTML into a tree of blocks."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "noscript", "template", "iframe", "noembed", "noframes", "xmp"))
RCDATA = frozenset(("title", "textarea"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag closes an open element of these names, up to the named limits.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Block tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
TAG = re.compile(
    r"""<!--(?:>|->|.*?(?:-->|--!>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=\s*+[^\s>"']*+|["'])*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)


@dataclass(slots=True)
class Node:
    """An element; ``inside`` holds strings (text) and nodes in order."""

    tag: str
    marks: str = ""  # class, id and role, lower case
    inside: list = field(default_factory=list)


def _marks(attributes: str) -> str:
    if "=" not in attributes:
        return ""
    found = [next((g for g in m[1:] if g), "") for m in ATTRIBUTE.findall(attributes)]
    return " ".join(" ".join(found).lower().split())


def parse(text: str) -> Node:
    """The tree of a page, however deep. Unclosed elements end with their parent, closing
    tags without an open element are passed over, a slash does not close an element that
    has content, comments and raw elements leave nothing."""
    root = Node("#root")
    stack = [root]
    at, n = 0, len(text)
    while at < n:
        m = TAG.search(text, at)
        until = m.start() if m else n
        if until > at:
            stack[-1].inside.append(html.unescape(text[at:until]) if "&" in text[at:until] else text[at:until])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            _close(stack, name)
            continue
        if name in RAW or name in RCDATA:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(text, at)
            if name in RCDATA:
                stack[-1].inside.append(Node(name, _marks(m[3]), [html.unescape(text[at : end.start() if end else n])]))
            at = end.end() if end else n
            continue
        if name in ENDS_P:
            _end_paragraph(stack)
        if name in CLOSES:
            own, limit = CLOSES[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in limit:
                    break
                if stack[i].tag in own:
                    del stack[i:]
                    break
        node = Node(name, _marks(m[3]))
        stack[-1].inside.append(node)
        if name not in VOID:
            stack.append(node)
    return root


def _end_paragraph(stack: list[Node]) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == "p":
            del stack[i:]
            return
        if stack[i].tag not in INLINE:
            return


def _close(stack: list[Node], name: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == name:
            del stack[i:]
            return
        # An inline end tag does not reach beyond its block, nor any beyond a table cell.
        if name in INLINE and stack[i].tag not in INLINE:
            return
