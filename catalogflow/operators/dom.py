"""Pages as node tables, for rules that need the tree.

One pass per page turns it into flat rows; selectors are then filters and equi joins on (page, node).
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.codes import portal_price
from ..functions.text import text_only
from ..functions.urls import any_part
from ..functions.values import blank_text

# Elements without an end tag.
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
# An output batch is closed after the page that reaches this many nodes.
_ROWS_PER_BATCH = 20_000
_SCHEMA = "node int, ancestors array<int>, tag string, attrs map<string,string>, inner string"


class _Nodes(HTMLParser):
    """Start tags in document order with their ancestors and the source span of their content."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=False)
        self.rows: list[list] = []
        self.open: list[int] = []
        self.spans: list[list[int]] = []
        # the parser counts \n as the only line end
        self.starts = [0]
        for line in html.split("\n"):
            self.starts.append(self.starts[-1] + len(line) + 1)
        self.feed(html)
        self.close()
        for node in self.open:
            self.spans[node][1] = len(html)

    def _at(self) -> int:
        line, column = self.getpos()
        return self.starts[line - 1] + column

    def handle_starttag(self, tag, attrs):
        node = len(self.rows)
        begin = self._at() + len(self.get_starttag_text())
        self.rows.append([node, list(self.open), tag, list({k: v or "" for k, v in attrs}.items())])
        self.spans.append([begin, begin])
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[depth]][2] == tag:
                for node in self.open[depth:]:
                    self.spans[node][1] = self._at()
                del self.open[depth:]
                return


def dom_nodes(pages: DataFrame, page: str, html: str = "html", inner_of: list[str] | None = None) -> DataFrame:
    """(page, node, ancestors, tag, attrs, inner) in document order.

    inner_of: tags whose inner HTML is kept (None = every tag); text is text_only(inner).
    """
    kept = None if inner_of is None else set(inner_of)
    field = pages.schema[page]
    key_type = to_arrow_type(field.dataType)
    schema = pa.schema(
        [
            (page, key_type), ("node", pa.int32()), ("ancestors", pa.list_(pa.int32())), ("tag", pa.string()),
            ("attrs", pa.map_(pa.string(), pa.string())), ("inner", pa.string()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            for key, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = source or ""
                parser = _Nodes(text)
                for (node, ancestors, tag, attrs), (begin, end) in zip(parser.rows, parser.spans):
                    inner = text[begin:end] if kept is None or tag in kept else None
                    for column, value in zip(rows, (key, node, ancestors, tag, attrs, inner)):
                        column.append(value)
                if len(rows[0]) > _ROWS_PER_BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)
                    rows = [[] for _ in schema]
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    kind = field.dataType.simpleString()
    return pages.select(page, html).mapInArrow(parse, f"{page} {kind}, {_SCHEMA}")


def has_class(name: str) -> Column:
    """Whether the node's class list contains a class."""
    return F.array_contains(F.split(F.coalesce(F.col("attrs")["class"], F.lit("")), r"\s+"), name)


def class_part(text: str) -> Column:
    return F.lower(F.coalesce(F.col("attrs")["class"], F.lit(""))).contains(text)


def node_text() -> Column:
    return text_only(F.col("inner"))


def within(nodes: DataFrame, roots: DataFrame, page: str) -> DataFrame:
    """Nodes below any of the roots, with the root's node number as `root`."""
    tops = roots.select(page, F.col("node").alias("root"))
    exploded = nodes.withColumn("root", F.explode("ancestors"))
    return exploded.join(tops, [page, "root"])


def first_within(nodes: DataFrame, roots: DataFrame, page: str) -> DataFrame:
    """First node below each root."""
    below = within(nodes, roots, page)
    first = below.groupBy(page, "root").agg(F.min("node").alias("node"))
    return nodes.join(first, [page, "node"])


def next_after(nodes: DataFrame, anchors: DataFrame, page: str) -> DataFrame:
    """First of the nodes that starts after each anchor, with the anchor's node number as `anchor`."""
    after = nodes.select(page, "node").join(anchors.select(page, F.col("node").alias("anchor")), page)
    first = after.filter(F.col("node") > F.col("anchor")).groupBy(page, "anchor").agg(F.min("node").alias("node"))
    return nodes.join(first, [page, "node"])


def tab_list(nodes: DataFrame, page: str, label: str) -> DataFrame:
    """List items of the pane a tab button opens: (page, node, text)."""
    button = nodes.filter((F.col("tag") == "button") & (F.lower(node_text()) == label)).select(
        page, F.regexp_extract(F.col("attrs")["data-bs-target"], "^#(.+)$", 1).alias("pane")
    )
    panes = nodes.withColumn("pane", F.col("attrs")["id"]).join(button.filter("pane != ''").distinct(), [page, "pane"])
    lists = first_within(nodes.filter("tag = 'ul'"), panes, page)
    items = within(nodes.filter("tag = 'li'"), lists, page)
    return items.select(page, "node", node_text().alias("text")).filter(~blank_text(F.col("text")))


def tab_section(nodes: DataFrame, page: str, words: list[str], target: str) -> DataFrame:
    """Block of the tab section that names one of the words: (page, html), the last such section wins.

    The block is the section's first target element, without its attributes.
    """
    tabs = nodes.filter((F.col("tag") == "div") & class_part("tab"))
    container = tabs.groupBy(page).agg(F.min("node").alias("node"))
    sections = within(nodes.filter(F.col("tag").isin("div", "section")), container, page).drop("root")
    named = sections.filter(any_part(F.lower(node_text()), words)).select(page, "node")
    blocks = first_within(nodes.filter(F.col("tag") == target), named, page).select(page, "node", "inner").distinct()
    last = blocks.groupBy(page).agg(F.max_by("inner", "node").alias("inner"))
    return last.select(page, F.concat(F.lit(f"<{target}>"), "inner", F.lit(f"</{target}>")).alias("html"))


def priced_element(nodes: DataFrame, page: str, part: str) -> DataFrame:
    """Price of the first element of a class: its data-rate attribute, else its text: (page, price)."""
    spots = nodes.filter(class_part(part)).withColumn("price", portal_price(F.col("attrs")["data-rate"], node_text()))
    return spots.groupBy(page).agg(F.min_by("price", "node").alias("price"))


def accordion_links(nodes: DataFrame, page: str, heading: str) -> DataFrame:
    """Links in the accordion item whose title contains the heading: (page, node, href, text)."""
    accordion = nodes.filter((F.col("tag") == "ul") & class_part("accordion"))
    items = within(nodes.filter((F.col("tag") == "li") & class_part("accordion-item")), accordion, page)
    titles = within(nodes.filter((F.col("tag") == "a") & class_part("accordion-title")), items.select(page, "node"), page)
    chosen = titles.filter(F.lower(node_text()).contains(heading)).select(page, F.col("root").alias("node")).distinct()
    content = first_within(nodes.filter((F.col("tag") == "div") & class_part("accordion-content")), chosen, page)
    links = within(nodes.filter((F.col("tag") == "a") & F.col("attrs")["href"].isNotNull()), content, page)
    return links.select(page, "node", F.col("attrs")["href"].alias("href"), node_text().alias("text"))


def accordion_documents(nodes: DataFrame, page: str, heading: str = "additional materials") -> DataFrame:
    """Documents of the accordion: (page, node, title, url, type); the first link of an address stays."""
    links = accordion_links(nodes, page, heading).filter(F.lower("href").contains("getmedia") | F.lower("href").contains(".pdf"))
    first = links.groupBy(page, "href").agg(F.min("node").alias("node"), F.min_by("text", "node").alias("text"))
    return first.select(
        page,
        "node",
        F.when(blank_text(F.col("text")), F.lit("Document")).otherwise(F.col("text")).alias("title"),
        F.col("href").alias("url"),
        F.when(F.lower("href").contains(".pdf"), "pdf").otherwise("document").alias("type"),
    )


def text_after_heading(nodes: DataFrame, page: str, heading: str, tag: str = "h3", target: str = "p") -> DataFrame:
    """Text of the first target element after the heading that contains a word: (page, text)."""
    anchors = nodes.filter((F.col("tag") == tag) & F.lower(node_text()).contains(heading))
    first = anchors.groupBy(page).agg(F.min("node").alias("node"))
    return next_after(nodes.filter(F.col("tag") == target), first, page).select(page, node_text().alias("text"))


def list_after_heading(nodes: DataFrame, page: str, heading: str) -> DataFrame:
    """Items of the first list after a heading with exactly this text: (page, node, text)."""
    anchors = nodes.filter(F.col("tag").isin("h3", "h4") & (F.lower(node_text()) == heading))
    first = anchors.groupBy(page).agg(F.min("node").alias("node"))
    lists = next_after(nodes.filter(F.col("tag").isin("ul", "ol")), first, page)
    items = within(nodes.filter("tag = 'li'"), lists.select(page, "node"), page)
    return items.select(page, "node", node_text().alias("text")).filter(~blank_text(F.col("text")))


def text_by_id(nodes: DataFrame, page: str, ids: list[str]) -> DataFrame:
    """Text of the first known element id, ids in order of preference: (page, text)."""
    rank = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col("attrs")["id"])
    hits = nodes.filter(F.col("attrs")["id"].isin(ids)).select(page, rank.alias("rank"), node_text().alias("text"))
    return hits.filter(~blank_text(F.col("text"))).groupBy(page).agg(F.min_by("text", "rank").alias("text"))


def swatch_labels_of_page(nodes: DataFrame, page: str) -> DataFrame:
    """Visible style labels: (page, pos, label), first of equals."""
    groups = nodes.filter(has_class("swatch-attribute") & has_class("style"))
    options = within(nodes.filter(has_class("swatch-option")), groups, page)
    label = F.coalesce(F.nullif(F.trim(F.col("attrs")["data-option-label"]), F.lit("")), node_text())
    named = options.select(page, "node", label.alias("label")).filter(~blank_text(F.col("label")))
    return named.groupBy(page, "label").agg(F.min("node").alias("pos"))
