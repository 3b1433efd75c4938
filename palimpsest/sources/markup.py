"""HTML and RSS: visible text, links, label/value tables, listings, feed items."""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = {"p", "div", "li", "tr", "table", "section", "article", "h1", "h2", "h3", "h4", "h5", "h6", "br", "ul", "ol", "dl", "dt", "dd"}
SILENT = {"script", "style", "head", "noscript", "template"}
ATTACHMENTS = (".pdf", ".odt", ".ods", ".doc", ".docx", ".xls", ".xlsx", ".zip", ".jpg", ".png")


class Page(HTMLParser):
    """Visible text, links and table rows of a page, in one pass."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.links: list[dict] = []
        self.tables: list[list[list[str]]] = []
        #: The links of each cell of ``tables``.
        self.cell_links: list[list[list[list[dict]]]] = []
        self._silent = 0
        self._open: list[list[list[tuple[list[str], list[dict]]]]] = []
        self._cells: list[tuple[list[str], list[dict]] | None] = []
        self._anchor: dict | None = None

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self._silent += 1
        if tag in BLOCKS:
            self.text.append("\n")
        if tag == "table":
            self._open.append([])
            self._cells.append(None)
        elif tag == "tr" and self._open:
            self._open[-1].append([])
            self._cells[-1] = None
        elif tag in ("td", "th") and self._open:
            if not self._open[-1]:
                self._open[-1].append([])
            self._cells[-1] = ([], [])
            self._open[-1][-1].append(self._cells[-1])
        elif tag == "a":
            self._anchor = {"href": dict(attrs).get("href"), "label": [], "title": dict(attrs).get("title"), "cell": self._cells[-1] if self._cells else None}

    def handle_endtag(self, tag):
        if tag in SILENT and self._silent:
            self._silent -= 1
        if tag in BLOCKS:
            self.text.append("\n")
        if tag in ("td", "th") and self._cells:
            self._cells[-1] = None
        elif tag == "table" and self._open:
            rows = self._open.pop()
            self._cells.pop()
            self.tables.append([["".join(text).strip() for text, _ in row] for row in rows])
            self.cell_links.append([[links for _, links in row] for row in rows])
        elif tag == "a" and self._anchor is not None:
            if self._anchor["href"]:
                label = " ".join("".join(self._anchor["label"]).split())
                link = {"href": self._anchor["href"], "label": label or self._anchor["title"] or ""}
                self.links.append(link)
                if self._anchor["cell"] is not None:
                    self._anchor["cell"][1].append(link)
            self._anchor = None

    def handle_data(self, data):
        if self._silent:
            return
        self.text.append(data)
        if self._anchor is not None:
            self._anchor["label"].append(data)
        if self._cells and self._cells[-1] is not None:
            self._cells[-1][0].append(data)


def parse_page(source: str) -> Page:
    page = Page()
    page.feed(source)
    page.close()
    return page


def visible_text(source: str) -> str:
    """Text that a reader sees, one line per block."""
    lines = (" ".join(line.split()) for line in "".join(parse_page(source).text).split("\n"))
    return "\n".join(line for line in lines if line)


def label_values(source: str) -> list[dict]:
    """Pairs of all two-column table rows, with the table and row they stand in."""
    return [
        {"label": row[0].rstrip("：: "), "value": row[1], "table_index": t, "row_index": r}
        for t, rows in enumerate(parse_page(source).tables)
        for r, row in enumerate(rows)
        if len(row) == 2 and row[0]
    ]


def single_label_table(source: str) -> dict[str, str]:
    """The pairs of a page with exactly one two-column table; anything else is an error."""
    tables = [rows for rows in parse_page(source).tables if rows and all(len(r) == 2 for r in rows)]
    if len(tables) != 1:
        raise ValueError(f"{len(tables)} label tables")
    labels = [r[0].rstrip("：: ") for r in tables[0]]
    if len(set(labels)) != len(labels):
        raise ValueError("a label occurs twice")
    return dict(zip(labels, (r[1] for r in tables[0])))


def attachment_links(source: str, base: str) -> list[dict]:
    """Links to files, absolute, each address once in order of appearance."""
    seen: dict[str, dict] = {}
    for link in parse_page(source).links:
        url = urljoin(base, html.unescape(link["href"]))
        if url.split("?")[0].split("#")[0].lower().endswith(ATTACHMENTS):
            seen.setdefault(url, {"url": url, "label": link["label"]})
    return list(seen.values())


def listing_rows(source: str, base: str) -> list[dict]:
    """Rows of listing tables that hold a link: ``title, url, cells, links``.

    ``links`` has every link of the row in order: ``column_index, url,
    label``. Title and address are those of the first link that is its whole
    cell, else of the first with a label, else of the first.
    """
    page = parse_page(source)
    out = []
    for rows, linked in zip(page.tables, page.cell_links):
        for row, cells in zip(rows, linked):
            links = [{"column_index": c, "url": urljoin(base, link["href"]), "label": link["label"]} for c, cell in enumerate(cells) for link in cell]
            if links:
                whole = (link for link in links if link["label"] and link["label"] == " ".join(row[link["column_index"]].split()))
                main = next(whole, None) or next((link for link in links if link["label"]), links[0])
                out.append({"title": main["label"], "url": main["url"], "cells": row, "links": links})
    return out


def listing_page(source: str, base: str) -> dict:
    """One page of a listing: its ``rows``, its number, the number of pages and rows that it states, and the address of the next page.

    Page numbers are read from a text like ``第 2 / 7 頁`` or ``Page 2 of 7``,
    the total from ``共 61 筆`` or ``61 results``; without them they are null. The
    next page is the link whose relation or label says so.
    """
    page = parse_page(source)
    text = " ".join("".join(page.text).split())
    place = re.search(r"第\s*(\d+)\s*[/／頁]\s*(?:共\s*)?(\d+)\s*頁?|[Pp]age\s+(\d+)\s+of\s+(\d+)", text)
    total = re.search(r"共\s*(\d+)\s*[筆則]|(\d+)\s+results", text)
    number, pages = ([int(x) for x in place.groups() if x] if place else [None, None])
    following = next((urljoin(base, x["href"]) for x in page.links if x["label"].strip() in ("下一頁", "下頁", "Next", "next", "›", "»")), None)
    return {"rows": listing_rows(source, base), "page": number, "pages": pages, "total": int(total[1] or total[2]) if total else None, "next_url": following}


def listing_problems(pages: list[dict]) -> list[str]:
    """Why the pages of a listing, in order, don't make it whole; empty if they do."""
    problems = []
    if [p["page"] for p in pages] != list(range(1, len(pages) + 1)):
        problems.append("page_numbers")
    if len({p["pages"] for p in pages}) > 1 or len({p["total"] for p in pages}) > 1:
        problems.append("statements_differ")
    if pages and pages[0]["pages"] not in (None, len(pages)):
        problems.append("pages_missing")
    if pages and pages[0]["total"] not in (None, sum(len(p["rows"]) for p in pages)):
        problems.append("rows_missing")
    if any((p["next_url"] is None) != (p is pages[-1]) for p in pages):
        problems.append("next_links")
    addresses = [row["url"] for p in pages for row in p["rows"]]
    if len(set(addresses)) != len(addresses):
        problems.append("repeated_rows")
    return problems


def decode_page(content: bytes, content_type: str | None) -> str:
    """Decode by the header's charset, then the page's own, then UTF-8; undecodable bytes are an error."""
    named = re.search(r"charset=[\"']?([\w-]+)", content_type or "") or re.search(rb"<meta[^>]+charset=[\"']?([\w-]+)", content[:2048])
    charset = (named[1].decode() if isinstance(named[1], bytes) else named[1]) if named else "utf-8"
    return content.decode(charset)


def _mapped(column: Column, function: Callable, arrow: pa.DataType, kind: str) -> Column:
    return F.arrow_udf(lambda values: pa.array([None if v is None else function(v) for v in values.to_pylist()], arrow), kind)(column)


def visible_text_of(column: Column) -> Column:
    """:func:`visible_text` of a column."""
    return _mapped(column, visible_text, pa.string(), "string")


def label_values_of(column: Column) -> Column:
    """:func:`label_values` of a column."""
    arrow = pa.list_(pa.struct([("label", pa.string()), ("value", pa.string()), ("table_index", pa.int32()), ("row_index", pa.int32())]))
    return _mapped(column, label_values, arrow, "array<struct<label:string,value:string,table_index:int,row_index:int>>")


def attachment_links_of(column: Column, base: str) -> Column:
    """:func:`attachment_links` of a column."""
    arrow = pa.list_(pa.struct([("url", pa.string()), ("label", pa.string())]))
    return _mapped(column, lambda s: attachment_links(s, base), arrow, "array<struct<url:string,label:string>>")


def feed_items(feeds: DataFrame, xml: str) -> DataFrame:
    """Items of RSS feeds: the feed's columns, ``item_index, guid, title, link, published``.

    A document type declaration is refused (no entities are expanded), and a
    repeated or missing GUID is an error of its feed: ``feed_error`` then says
    so and the items are null.
    """
    from xml.etree import ElementTree

    arrow = pa.struct(
        [("error", pa.string()), ("items", pa.list_(pa.struct([("item_index", pa.int32()), *[(n, pa.string()) for n in ("guid", "title", "link", "published")]])))]
    )

    def read(source: str) -> dict:
        if "<!DOCTYPE" in source.upper() or "<!ENTITY" in source.upper():
            return {"error": "document type declaration", "items": None}
        try:
            root = ElementTree.fromstring(source)
        except ElementTree.ParseError as problem:
            return {"error": str(problem), "items": None}
        get = lambda item, name: (item.findtext(name) or "").strip() or None
        items = [
            {"item_index": i, "guid": get(x, "guid") or get(x, "link"), "title": get(x, "title"), "link": get(x, "link"), "published": get(x, "pubDate")}
            for i, x in enumerate(root.iter("item"))
        ]
        guids = [x["guid"] for x in items]
        if None in guids or len(set(guids)) != len(guids):
            return {"error": "guids missing or repeated", "items": None}
        return {"error": None, "items": items}

    kind = "struct<error:string,items:array<struct<item_index:int,guid:string,title:string,link:string,published:string>>>"
    rest = [c for c in feeds.columns if c != xml]
    parsed = feeds.select(*rest, _mapped(F.col(xml), read, arrow, kind).alias("__p"))
    return parsed.select(*rest, F.col("__p.error").alias("feed_error"), F.explode_outer("__p.items").alias("__i")).select(*rest, "feed_error", "__i.*")
