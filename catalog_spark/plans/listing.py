"""Listing job: pages with a prefix panel to a table of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import ship_package
from ..sources.listing import panel_table
from ..sources.sinks import write_csv


def listing_job(pages: DataFrame, out: str | None = None, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """Rows of all panels; an input without any row is an error."""
    ship_package(pages.sparkSession)
    rows = panel_table(pages, page_id=page_id, html=html)
    if rows.isEmpty():
        raise ValueError("no panel with rows in the pages")
    if out:
        write_csv(rows.drop(page_id, "pos"), out)
    return rows
