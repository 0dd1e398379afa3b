"""A small element tree over the standard HTML parser, built once per page inside a task.

Elements close as written: an end tag closes up to its opener, a stray one is ignored, void
elements close at once, and an unclosed paragraph stays open.
"""

from __future__ import annotations

from html import escape
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset({"script", "style", "template"})


class Markup(str):
    """Source text that is no page text, such as a document type."""


class Comment(Markup):
    pass


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs=()):
        self.tag = tag
        self.attrs = {k: v or "" for k, v in attrs}
        self.children: list = []

    def elements(self):
        """All elements below this one in document order."""
        stack = [iter(self.children)]
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
            elif isinstance(child, Element):
                yield child
                stack.append(iter(child.children))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [Element("")]
        self.counts: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        element = Element(tag, attrs)
        self.open[-1].children.append(element)
        if tag not in VOID:
            self.open.append(element)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        while self.counts.get(tag):
            closed = self.open.pop()
            self.counts[closed.tag] -= 1
            if closed.tag == tag:
                break

    def handle_data(self, data):
        siblings = self.open[-1].children
        if siblings and type(siblings[-1]) is str:
            siblings[-1] += data
        else:
            siblings.append(data)

    def handle_comment(self, data):
        self.open[-1].children.append(Comment(f"<!--{data}-->"))

    def parse_marked_section(self, i, report=1):
        # A page has no marked sections; what looks like one is a comment up to the next bracket.
        return self.parse_bogus_comment(i)

    def handle_decl(self, decl):
        self.open[-1].children.append(Markup(f"<!{decl}>"))


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.open[0]


def has_class(element: Element, wanted: str) -> bool:
    """One class token, or the whole class attribute when several are given."""
    tokens = element.attrs.get("class", "").split()
    return wanted in tokens or wanted == " ".join(tokens)


def find(root: Element, tag: str | None = None, cls: str | None = None, id: str | None = None):
    """First element in document order that meets all given conditions."""
    for element in root.elements():
        if tag and element.tag != tag:
            continue
        if cls and not has_class(element, cls):
            continue
        if id and element.attrs.get("id") != id:
            continue
        return element
    return None


def text_nodes(root: Element):
    stack = [iter(root.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, Element):
            if child.tag not in RAW:
                stack.append(iter(child.children))
        elif type(child) is str:
            yield child


def stripped_text(root: Element) -> str:
    """All text, each piece stripped, joined without a separator."""
    return "".join(piece.strip() for piece in text_nodes(root))


def serialize(node) -> str:
    out: list[str] = []
    stack: list = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, tuple):
            out.append(item[0])
        elif isinstance(item, Element):
            if item.tag:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in item.attrs.items())
                closing = "/" if item.tag in VOID else ""
                out.append(f"<{item.tag}{attrs}{closing}>")
                if closing:
                    continue
                stack.append((f"</{item.tag}>",))
            verbatim = item.tag in RAW
            for child in reversed(item.children):
                plain = type(child) is str and verbatim
                stack.append((child,) if plain else child)
        else:
            out.append(item if isinstance(item, Markup) else escape(item, quote=False))
    return "".join(out)


def prune(root: Element, drop) -> None:
    """Remove, with their content, the children for which drop is true."""
    stack = [root]
    while stack:
        element = stack.pop()
        element.children = [c for c in element.children if not drop(c)]
        stack.extend(c for c in element.children if isinstance(c, Element))
