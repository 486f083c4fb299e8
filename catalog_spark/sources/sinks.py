"""Writers.  Every task writes its own files; only tables known to be small are merged into one."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from ..operators.flatten import flatten_json
from ..spec import curated
from .files import read_jsonl

log = logging.getLogger(__name__)

# Fixed value: most rows of a compressed file, which one task reads from its start.
FILE_ROWS = 100_000


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines (UTF-8, nulls kept), folders created as needed."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def _writer(df: DataFrame, compression: str | None) -> DataFrameWriter:
    """A writer of text files; compressed ones cannot be split, so their rows are bounded."""
    return df.write.options(compression=compression, maxRecordsPerFile=FILE_ROWS) if compression else df.write


def append_documents(df: DataFrame, text: str, path: str, compression: str | None = None) -> None:
    """Append documents that already are JSON text."""
    _writer(df.select(F.col(text).alias("value")), compression).mode("append").text(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite", compression: str | None = None) -> None:
    """CSV with a header; ``single_file`` is for tables of a bounded size, such as metrics and summaries."""
    out = df.coalesce(1) if single_file else df
    _writer(out, compression).mode(mode).csv(
        path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def export_flat(spark: SparkSession, jsonl: str, out: str, fmt: str = "csv", compression: str | None = "gzip", **limits) -> DataFrame | None:
    """Flatten all documents of a JSON-lines folder into a table; nothing is written for an empty input.

    CSV repeats its texts so often that it is compressed unless ``compression`` is None; other formats have their own way.
    """
    docs = read_jsonl(spark, jsonl, keep_malformed=True)  # which the flattening leaves out without parsing once more
    if docs.where("doc IS NOT NULL").isEmpty():
        log.warning("no rows in %s, nothing exported", jsonl)
        return None
    flat = flatten_json(docs, "line", variant="doc", **limits)
    if fmt == "csv":
        write_csv(flat, out, compression=compression)
    else:
        flat.write.mode("overwrite").format(fmt).save(out)
    return flat


def write_enriched(df: DataFrame, path: str, neighbors: int = 3) -> None:
    write_csv(curated(df, neighbors), path)


def write_if_wanted(df: DataFrame, path: str | None) -> bool:
    """Small report tables go out only when a path is given."""
    if not path:
        return False
    write_csv(df, path, single_file=True)
    return True
