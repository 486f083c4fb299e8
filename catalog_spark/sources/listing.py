"""Listing pages (HTML) to rows."""

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.text import strip_html
from .files import ZIP_HEADER

ANCHOR_ITEM = r'<li><a href="([^"]*)">([^<]*)</a></li>'

# HTML elements without an end tag.
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def anchor_items(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, pos, href, text) for each linked list item, with built-in expressions only."""
    items = F.regexp_extract_all(F.col(html), F.lit(ANCHOR_ITEM), F.lit(0))
    # Outer, so that the pattern is not matched a second time to filter empty pages.
    rows = pages.select(page_id, F.posexplode_outer(items).alias("pos", "item")).where(F.col("pos").isNotNull())
    return rows.select(
        page_id,
        "pos",
        F.regexp_extract("item", ANCHOR_ITEM, 1).alias("href"),
        strip_html(F.regexp_extract("item", ANCHOR_ITEM, 2)).alias("text"),
    )


class _PanelReader(HTMLParser):
    """Header cells and item cells of the first panel of a page.

    Each open element is on a stack with its classes; text goes to the innermost
    cell being read.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = []  # (tag, classes, role)
        self.headers, self.items = [], []
        self.done = False

    def _inside(self, role):
        return any(r == role for _, _, r in self.stack)

    def _role(self, classes):
        if not self._inside("panel"):
            return "panel" if "panel-prefixes" in classes and not self.done else None
        if "panel-heading" in classes:
            return "heading"
        if "list-group" in classes and not self._inside("list"):
            return "list"
        if self._inside("list") and "list-group-item" in classes:
            self.items.append(None)
            return "item"
        in_item = self._inside("item")
        if "row" in classes and (in_item or self._inside("heading")):
            if in_item and self.items[-1] is None:
                self.items[-1] = {}
                return "row"
            return "header_row" if not in_item else None
        if in_item and self._inside("row"):
            for name in classes:
                if name.startswith("prefix-col") and name not in self.items[-1]:
                    self.items[-1][name] = []
                    return ("cell", name)
        elif self.stack and self.stack[-1][2] == "header_row" and any("prefix-col" in c for c in classes):
            self.headers.append([])
            return "header"
        return None

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            return
        classes = (dict(attrs).get("class") or "").split()
        self.stack.append((tag, classes, self._role(classes)))

    def handle_endtag(self, tag):
        if any(t == tag for t, _, _ in self.stack):
            while self.stack:
                closed, _, role = self.stack.pop()
                self.done |= role == "panel"
                if closed == tag:
                    break

    def handle_data(self, data):
        text = data.strip()
        for _, _, role in reversed(self.stack):
            if role == "header":
                self.headers[-1].append(text)
                return
            if isinstance(role, tuple):
                if text:
                    self.items[-1][role[1]].append(text)
                return


def _read_panel(page: str, default_header: list[str]):
    reader = _PanelReader()
    reader.feed(page)
    reader.close()
    headers = ["".join(h) for h in reader.headers] or default_header
    return [
        {"pos": i, "header": headers, "cells": [" ".join(cells.get(f"prefix-col{n}", [])) for n in range(1, len(headers) + 1)]}
        for i, cells in enumerate(c for c in reader.items if c is not None)
    ]


MOST_HEADERS = 1_000
PANEL_ROWS = T.ArrayType(
    T.StructType(
        [
            T.StructField("pos", T.IntegerType()),
            T.StructField("header", T.ArrayType(T.StringType())),
            T.StructField("cells", T.ArrayType(T.StringType())),
        ]
    )
)


def panel_items(pages: DataFrame, page_id: str = "page_id", html: str = "html", default_header: list[str] | None = None) -> DataFrame:
    """(page_id, pos, header, cells): one row per list item of the prefix panel of each page.

    Cells are positional, a missing one is '', items without a row container are
    skipped, and the default header serves pages without header cells.  Pages
    without a panel never reach Python.
    """
    names = default_header or ZIP_HEADER

    @F.pandas_udf(PANEL_ROWS)
    def read(s: pd.Series) -> pd.Series:
        return s.map(lambda page: _read_panel(page, names))

    with_panel = pages.where(F.col(html).contains("panel-prefixes")).select(page_id, F.explode_outer(read(F.col(html))).alias("r"))
    return with_panel.where(F.col("r").isNotNull()).select(page_id, "r.pos", "r.header", "r.cells")


def panel_table(pages: DataFrame, columns: list[str] | None = None, **options) -> DataFrame:
    """The cells of ``panel_items`` as string columns named by the pages' own headers.

    ``columns`` names them where a page has no header.  Pages with several headers give all their columns, '' where a
    page lacks one; of equal names in one header the first counts.
    """
    names = columns or ZIP_HEADER
    items = panel_items(pages, default_header=names, **options)
    page_id = items.columns[0]
    headers = items.groupBy("header").agg(F.min(page_id).alias("first")).orderBy("first", "header").limit(MOST_HEADERS + 1).collect()
    if len(headers) > MOST_HEADERS:
        raise ValueError(f"over {MOST_HEADERS} different headers")
    found = list(dict.fromkeys(n for r in headers for n in r.header)) or names
    cell = lambda n: F.coalesce(F.get("cells", (F.array_position("header", F.lit(n)) - 1).cast("int")), F.lit(""))
    return items.select(page_id, "pos", *[F.when(F.array_contains("header", F.lit(n)), cell(n)).otherwise("").alias(n) for n in found])
