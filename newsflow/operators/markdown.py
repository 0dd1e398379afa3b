"""Markdown text of an element tree: headings, paragraphs, emphasis, links, images, lists, quotes,
code and rules. Lines are not wrapped."""

from __future__ import annotations

import re

from newsflow.operators.html_tree import RAW, Element, Markup

_BLOCKS = frozenset(
    "p div section article header footer main aside figure figcaption table dl ul ol".split()
)
# Elements whose white space is no text.
_ROWS = frozenset("table thead tbody tfoot tr dl".split())
_INLINE = {
    "strong": "**", "b": "**", "em": "_", "i": "_", "u": "_", "code": "`",
    "del": "~~", "s": "~~", "strike": "~~",
}
_HEADINGS = {f"h{n}": "#" * n + " " for n in range(1, 7)}


def _opening(element: Element, lists: list, links: bool, images: bool) -> str:
    tag, attrs = element.tag, element.attrs
    if tag in _HEADINGS:
        return "\n\n" + _HEADINGS[tag]
    if tag == "br":
        return "  \n"
    if tag == "hr":
        return "\n\n* * *\n\n"
    if tag == "img":
        return f"![{attrs.get('alt', '')}]({attrs['src']})" if images and attrs.get("src") else ""
    if tag == "a":
        return "[" if links and attrs.get("href") else ""
    if tag == "li":
        ordered = lists and lists[-1][0] == "ol"
        if ordered:
            lists[-1][1] += 1
        mark = f"{lists[-1][1]}. " if ordered else "* "
        return "\n" + "  " * max(len(lists), 1) + mark
    if tag in ("ul", "ol") and len(lists) > 1:
        return ""
    if tag in ("tr", "dt"):
        return "\n"
    if tag == "dd":
        return "\n    "
    return "\n\n" if tag in _BLOCKS else _INLINE.get(tag, "")


def _closing(element: Element, lists: list, links: bool) -> str:
    tag = element.tag
    if tag == "a":
        href, title = element.attrs.get("href"), element.attrs.get("title")
        target = f'{href} "{title}"' if title else href
        return f"]({target})" if links and href else ""
    if tag in ("ul", "ol") and lists:
        return ""
    return "\n\n" if tag in _BLOCKS or tag in _HEADINGS else _INLINE.get(tag, "")


def _tidy(text: str) -> str:
    text = re.sub(r"\n +(?=\n)", "\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n").rstrip()


def _prefixed(text: str, prefix: str) -> str:
    return "\n\n" + "\n".join((prefix + line).rstrip() for line in text.split("\n")) + "\n\n"


def to_markdown_text(root: Element, links: bool = True, images: bool = True) -> str:
    """Walks the tree with an explicit stack, since unclosed tags can nest very deep."""
    pieces: list[list[str]] = [[]]
    lists: list[list] = []
    # The wrapper lets the root element be opened and closed like any other.
    stack: list = [(Element(""), iter([root]))]
    in_pre = 0
    begun: set[int] = set()  # rows of tables that have a cell
    while stack:
        element, children = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if element.tag in ("ul", "ol"):
                lists.pop()
            if element.tag in ("pre", "blockquote"):
                inner = "".join(pieces.pop())
                if element.tag == "pre":
                    in_pre -= 1
                    pieces[-1].append(_prefixed(inner.strip("\n"), "    "))
                else:
                    pieces[-1].append(_prefixed(_tidy(inner), "> "))
            else:
                pieces[-1].append(_closing(element, lists, links))
        elif isinstance(child, Element):
            if child.tag in RAW:
                continue
            if child.tag in ("td", "th"):
                if id(element) in begun:
                    pieces[-1].append(" | ")
                begun.add(id(element))
            if child.tag in ("ul", "ol"):
                lists.append([child.tag, 0])
            if child.tag in ("pre", "blockquote"):
                pieces.append([])
                in_pre += child.tag == "pre"
            else:
                pieces[-1].append(_opening(child, lists, links, images))
            stack.append((child, iter(child.children)))
        elif not isinstance(child, Markup):
            if element.tag in _ROWS and not child.strip():
                continue
            text = child if in_pre else re.sub(r"\s+", " ", child)
            at_line_start = pieces[-1] and pieces[-1][-1].endswith("\n")
            pieces[-1].append(text.lstrip(" ") if at_line_start and not in_pre else text)
    return _tidy("".join(pieces[0]))
