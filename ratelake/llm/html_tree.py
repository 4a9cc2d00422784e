"""A forgiving HTML reader: pages to small trees, with the text of script, style and comments left out."""

from __future__ import annotations

import html
import re

#: Elements without content, elements whose content is no markup, elements that end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes textarea title".split())
BLOCKS = frozenset(
    "html head body address article aside blockquote br canvas center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead "
    "tr ul video".split()
)
#: An open element of the key ends when one of the values begins.
ENDED_BY = {
    "p": BLOCKS - {"br"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option"},
    "head": {"body"},
}
_SCOPES = frozenset("ul ol dl table select article aside section div main nav header footer form body".split())

_DIGITS = re.compile(r"\d+")
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


class Node:
    """An element; ``children`` holds nodes and decoded strings in page order."""

    __slots__ = ("tag", "names", "hidden", "children", "key")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.names, self.hidden = tag, [], "", False
        if attributes.strip(" /\n\t\r"):
            found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
            self.names = " ".join(found.get(k, "") for k in ("class", "id", "role")).lower().strip()
            self.hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower()
        # What a node is matched by: tag and names, numbers left out.
        self.key = (tag, _DIGITS.sub("", self.names) if self.names else "")

    def nodes(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]


def parse(page: str | None) -> Node:
    """The tree of a page; never fails. Raw-text elements stay as nodes without content."""
    root = Node("#page")
    stack, at, page = [root], 0, page or ""
    while at < len(page):
        m = _MARKUP.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            stack[-1].children.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            _close(stack, tag)
            continue
        while len(stack) > 1 and tag in ENDED_BY.get(_enclosing(stack, tag), ()):
            _close(stack, _enclosing(stack, tag))
        node = Node(tag, m[3])
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    return root


def _enclosing(stack: list[Node], tag: str) -> str:
    """The nearest open element that ``tag`` may end, inside its scope."""
    for node in reversed(stack[1:]):
        if tag in ENDED_BY.get(node.tag, ()):
            return node.tag
        if node.tag in _SCOPES:
            return ""
    return ""


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
