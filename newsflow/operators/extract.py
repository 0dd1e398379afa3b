"""Article fields, main content, Markdown and cleaned HTML from landed pages.

Each operator is one ``mapInArrow`` pass that parses a page once. Filters, top-n and anti-joins
belong before the call, since the optimiser cannot move them below it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.fixed_values import MAIN_CONTENT_SELECTORS, REMOVED_ATTRIBUTES, REMOVED_TAGS
from newsflow.operators.html_tree import (
    Comment,
    Element,
    find,
    has_class,
    parse,
    prune,
    serialize,
    stripped_text,
    text_nodes,
)
from newsflow.operators.markdown import to_markdown_text

# Output rows per Arrow batch; pages are large.
OUTPUT_ROWS = 256

Selector = Mapping[str, str | None]


def _map_pages(
    pages: DataFrame,
    html_col: str,
    outputs: Sequence[str],
    per_page: Callable[..., tuple],
    extra_col: str | None = None,
    on_failure: Callable[[str | None, Exception], tuple] | None = None,
) -> DataFrame:
    """Replace the HTML (and extra) column by string columns computed from each page.

    A page that can't be processed gives the row of on_failure, so it stays a matter of its own.
    """

    def computed(*values) -> tuple:
        try:
            return per_page(*values)
        except Exception as failure:  # noqa: BLE001
            if on_failure is None:
                return (values[0],) * len(outputs)
            return on_failure(values[0], failure)

    used = {html_col, extra_col}
    kept = [f for f in pages.schema.fields if f.name not in used | set(outputs)]
    kept_names = [f.name for f in kept]
    schema = T.StructType([*kept, *[T.StructField(name, T.StringType()) for name in outputs]])
    count = len(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, OUTPUT_ROWS):
                part = batch.slice(start, OUTPUT_ROWS)
                inputs = [part.column(html_col).to_pylist()]
                if extra_col:
                    inputs.append(part.column(extra_col).to_pylist())
                rows = [computed(*values) for values in zip(*inputs)]
                columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(count)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in kept_names] + columns, names=[*kept_names, *outputs]
                )

    needed = [*kept_names, html_col, *([extra_col] if extra_col else [])]
    return pages.select(*needed).mapInArrow(run, schema)


def _select(root: Element, selector: Selector | None) -> Element | None:
    """First match; a selector without a class means an element without a class attribute."""
    if not selector:
        return None
    tag, cls = selector.get("tag"), selector.get("class")
    if cls:
        return find(root, tag, cls)
    return next(
        (e for e in root.elements() if (not tag or e.tag == tag) and "class" not in e.attrs), None
    )


def _field(root: Element, selector: Selector | None) -> str | None:
    element = _select(root, selector)
    return None if element is None else stripped_text(element)


def _article_markdown(root: Element, selector: Selector | None, links: bool, images: bool):
    """(markdown, error) of the content element."""
    if not selector or not selector.get("tag") or not selector.get("class"):
        return None, "missing content selector"
    content = find(root, selector["tag"], selector["class"])
    if content is None:
        return None, "content not found with the given selector"
    return to_markdown_text(content, links, images), None


def extract_articles(
    pages: DataFrame,
    selectors: Mapping[str, Selector | None] | None = None,
    html_col: str = "html",
    selectors_col: str = "selectors",
    with_markdown: bool = True,
) -> DataFrame:
    """Title, summary, time, author and Markdown of each page.

    ``content_error`` says why there is no Markdown; ``error`` is set only where nothing was read.
    Selectors are given once for all pages or, per page, by the column ``attach_selectors`` adds.
    """
    fields = ["title", "short_description", "publish_time", "author"]
    outputs = [*fields, *(["markdown_content", "content_error"] if with_markdown else []), "error"]
    blank = [None] * (len(outputs) - 1)
    names = ["title_selector", "short_desc_selector", "publish_time_selector", "author_selector"]

    def per_page(html, page_selectors=None):
        chosen = selectors if selectors is not None else dict(page_selectors or ())
        if html is None:
            return (*blank, "page has no html")
        if not chosen:
            return (*blank, "no selectors for this page")
        root = parse(html)
        row = [_field(root, chosen.get(name)) for name in names]
        if not with_markdown:
            return (*row, None)
        text, failed = _article_markdown(root, chosen.get("content_selector"), True, True)
        read = any(value is not None for value in (*row, text))
        return (*row, text, failed, None if read else failed)

    extra = None if selectors is not None else selectors_col
    return _map_pages(pages, html_col, outputs, per_page, extra, lambda _, e: (*blank, _unreadable(e)))


def _unreadable(failure: Exception) -> str:
    return f"page not readable: {type(failure).__name__}"


def _main_content(html: str, selectors: Sequence[Selector]) -> str:
    root = parse(html)
    for selector in selectors:
        element = find(root, selector.get("tag"), selector.get("class"), selector.get("id"))
        if element is not None:
            return serialize(element)
    body = find(root, "body")
    return html if body is None else serialize(body)


def extract_main_content(
    pages: DataFrame,
    selectors: Sequence[Selector] | None = None,
    html_col: str = "html",
    out_col: str = "main_content",
) -> DataFrame:
    """First element that matches the ordered selectors, else the body, else the input."""
    wanted = MAIN_CONTENT_SELECTORS if selectors is None else list(selectors)
    return _map_pages(
        pages, html_col, [out_col], lambda html: (_main_content(html, wanted) if html else "",)
    )


def to_markdown(
    pages: DataFrame,
    selector: Selector,
    retain_links: bool = True,
    retain_images: bool = True,
    html_col: str = "html",
) -> DataFrame:
    """Markdown of the content element; a failure goes to ``error``, not into the text."""

    def per_page(html):
        if html is None:
            return None, "page has no html"
        return _article_markdown(parse(html), selector, retain_links, retain_images)

    return _map_pages(
        pages, html_col, ["markdown_content", "error"], per_page,
        on_failure=lambda _, e: (None, _unreadable(e)),
    )


def _clean(html, drop_tags, keep_tags, drop_attrs, keep_attrs, drop_classes, drop_ids) -> str:
    root = parse(html)

    def unwanted(node) -> bool:
        if not isinstance(node, Element):
            return isinstance(node, Comment)
        return (
            node.tag in drop_tags
            or (keep_tags is not None and node.tag not in keep_tags)
            or any(has_class(node, c) for c in drop_classes)
            or node.attrs.get("id") in drop_ids
        )

    def dropped(name: str) -> bool:
        by_rule = any(name.startswith(r) if r.endswith("-") else name == r for r in drop_attrs)
        return by_rule or (keep_attrs is not None and name not in keep_attrs)

    prune(root, unwanted)
    for element in root.elements():
        element.attrs = {k: v for k, v in element.attrs.items() if not dropped(k)}
    return serialize(root)


def clean_html(
    pages: DataFrame,
    remove_tags: Sequence[str] | None = None,
    keep_tags: Sequence[str] | None = None,
    remove_attrs: Sequence[str] | None = None,
    keep_attrs: Sequence[str] | None = None,
    remove_classes: Sequence[str] = (),
    remove_ids: Sequence[str] = (),
    html_col: str = "html",
    out_col: str = "cleaned_html",
) -> DataFrame:
    """HTML without comments and unwanted elements and attributes. Elements go with their content;
    an attribute rule that ends in ``-`` is a prefix."""
    rules = (
        frozenset(REMOVED_TAGS if remove_tags is None else remove_tags),
        frozenset(keep_tags) if keep_tags else None,
        tuple(REMOVED_ATTRIBUTES if remove_attrs is None else remove_attrs),
        frozenset(keep_attrs) if keep_attrs else None,
        tuple(remove_classes),
        frozenset(remove_ids),
    )
    return _map_pages(
        pages, html_col, [out_col], lambda html: (_clean(html, *rules) if html else "",)
    )


@F.arrow_udf(T.StringType())
def _plain_text(values: pa.Array) -> pa.Array:
    return pa.array(
        [None if v is None else "".join(text_nodes(parse(v))) for v in values.to_pylist()],
        pa.string(),
    )


@F.arrow_udf(T.StringType())
def _markdown(values: pa.Array) -> pa.Array:
    return pa.array(
        [None if v is None else to_markdown_text(parse(v)) for v in values.to_pylist()],
        pa.string(),
    )


def rss_description(c: Column, fmt: str = "text") -> Column:
    """Feed description as ``text``, ``markdown`` or ``html``; plain text skips Python."""
    fmt = fmt.lower()
    if fmt not in ("text", "markdown", "html"):
        raise ValueError("description format must be 'text', 'html' or 'markdown'")
    if fmt == "html":
        return c
    has_markup = c.contains("<") | c.contains("&")
    convert = _plain_text if fmt == "text" else _markdown
    return F.coalesce(convert(F.when(has_markup, c)), c)
