"""A small tolerant HTML reader: the text blocks of a page with the path of their block elements."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

# Element names of the HTML standard.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; ``title`` and ``textarea`` hold text that is not part of the page's body.
RAW = frozenset("script style title textarea noscript iframe noembed noframes template xmp svg math object".split())
#: A start tag of the key closes an open element of the values, up to the nearest of the third set.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"thead", "tbody"}, "tfoot": {"tbody"},
}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


class Node:
    """An open block element: its own name, its path, and the names of its block children so far."""

    __slots__ = ("children", "name", "path")

    def __init__(self, name: str, path: str):
        self.name, self.path, self.children = name, path, []


def element_key(name: str, attrs: str) -> str:
    """``div.ad#x``-like name of an element: tag, classes, id and role, with digits as one ``0``."""
    found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)} if "=" in attrs else {}
    key = name
    if found.get("class"):
        key += "." + ".".join(sorted(found["class"].lower().split()))
    if found.get("id"):
        key += "#" + found["id"].lower()
    if found.get("role"):
        key += "@" + found["role"].lower()
    return re.sub(r"\d+", "0", key).replace("/", "_")


def read_page(html: str) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Blocks (path, text) in page order, and (path, children's names) of every closed block element.

    Character references are decoded, white space in a block is one space, empty
    blocks are left out.  Unclosed, crossed and cut-off tags are closed where the
    next block, the enclosing end tag or the end of the page closes them.
    """
    blocks: list[tuple[str, str]] = []
    styles: list[tuple[str, str]] = []
    stack: list[Node] = [Node("", "")]
    text: list[str] = []

    def flush() -> None:
        if text:
            got = " ".join(unescape("".join(text)).split())
            text.clear()
            if got:
                blocks.append((stack[-1].path, got))

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            styles.append((node.path, " ".join(node.children)))

    at = 0
    while True:
        tag = _TAG.search(html, at)
        if tag is None:
            text.append(html[at:])
            break
        if tag.start() > at:
            text.append(html[at : tag.start()])
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if name in RAW:
            if not tag["end"] and not tag["attrs"].endswith("/"):
                end = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(html, at)
                if end is None:
                    break
                stop = html.find(">", end.start())
                at = len(html) if stop < 0 else stop + 1
            continue
        if name == "br":
            text.append("\n")
            continue
        if name not in BLOCK:
            continue
        flush()
        if tag["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    close(depth)
                    break
            continue
        if name in ("html", "body"):
            if any(n.name == name for n in stack):
                continue
        if stack[-1].name == "p":  # any block closes an open paragraph
            close(len(stack) - 1)
        if name in CLOSES:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in CLOSES[name]:
                    close(depth)
                    break
                if stack[depth].name in _SCOPE.get(name, ()):
                    break
        key = element_key(name, tag["attrs"])
        if not stack[-1].children or stack[-1].children[-1] != key:  # a run of like children counts once
            stack[-1].children.append(key)
        if name not in VOID:
            stack.append(Node(name, f"{stack[-1].path}/{key}"))
    flush()
    close(1)
    return blocks, styles


def ancestors(path: str) -> Iterator[str]:
    """The path and all that lie above it, longest first."""
    while path:
        yield path
        path = path.rpartition("/")[0]
