"""Items of feeds that an XML parser refuses or reads in part: damaged, nested, with tags inside a title."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from html.entities import html5

# A `<` that begins none of these is text. Attribute values hold no `<`, so a broken tag ends soon.
_TOKEN = re.compile(
    r"""<!\[CDATA\[(?P<raw>.*?)(?:\]\]>|\Z)|<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)|<![^<>]*>"""
    r"""|<(?P<end>/?)(?P<name>[A-Za-z_][^\s<>/]*)(?:[^<>"'/]|"[^"<]*"|'[^'<]*'|/(?!>))*+(?P<empty>/?)>""",
    re.DOTALL,
)
_REFERENCE = re.compile(r"&(?:#(?P<number>\d{1,7})|#x(?P<hex>[0-9a-fA-F]{1,6})|(?P<name>[A-Za-z][A-Za-z0-9]*));")


def _character(match: re.Match) -> str:
    if match["name"]:
        return html5.get(f"{match['name']};", match[0])
    code = int(match["number"]) if match["number"] else int(match["hex"], 16)
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else match[0]


def scan_items(payload: str, tags: Sequence[str]) -> list[dict[str, list[str]]]:
    """Per ``<item>`` at any depth, in the order they begin, the text of the first element of each tag.

    Text is that of the element and all below it, without comments. Tags and text belong to the innermost
    open item. An end tag closes the nearest open element of its name and what is open in it; without
    one it is passed over. What is open at the end of the payload counts as closed there.
    """
    wanted = set(tags)
    items: list[dict[str, list[str]]] = []
    # Open elements as (name, the tag they are read as, whether they are an item); items with their tags being read.
    stack: list[tuple[str, str | None, bool]] = []
    names: Counter[str] = Counter()
    reading: list[tuple[dict[str, list[str]], set[str]]] = []

    def add(text: str) -> None:
        if text and reading:
            fields, active = reading[-1]
            for tag in active:
                fields[tag].append(text)

    at = 0
    for token in _TOKEN.finditer(payload):
        if reading and reading[-1][1]:
            add(_REFERENCE.sub(_character, payload[at : token.start()]))
            add(token["raw"] or "")
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        if not token["end"]:
            item = name == "item"
            read = None
            if item:
                items.append({})
                reading.append((items[-1], set()))
            elif name in wanted and reading and name not in reading[-1][0]:
                read = name
                reading[-1][0][name] = []
                reading[-1][1].add(name)
            stack.append((name, read, item))
            names[name] += 1
        if (token["end"] or token["empty"]) and names[name]:
            while True:
                closed, read, item = stack.pop()
                names[closed] -= 1
                if item:
                    reading.pop()
                elif read:
                    reading[-1][1].discard(read)
                if closed == name:
                    break
    if reading and reading[-1][1]:
        add(_REFERENCE.sub(_character, payload[at:]))
    return [{tag: ["".join(text)] for tag, text in fields.items()} for fields in items]
