"""JSON held in table columns: detection, tolerant parsing and the three known shapes."""

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.clean import numeric
from ..functions.text import SPACE, strip_space
from ..spec import BREADCRUMBS, CATEGORY_PATH, CHILDREN, SECONDARY_AVERAGES, parsed

JSON_START = f"^{SPACE}*[\\[{{]"

PACKAGE_QUANTITY = r"(?i)Package Quantity:\s*(\d+)"


def detect_json_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, is_json): whether any value starts with ``[`` or ``{``; one pass for all columns."""
    names = columns or [c for c, t in df.dtypes if t == "string"]
    wide = df.agg(*[F.coalesce(F.bool_or(F.col(c).rlike(JSON_START)), F.lit(False)).alias(f"c{i}") for i, c in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("is_json")) for i, c in enumerate(names)])
    return wide.select(F.inline(pairs))


def json_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    return [r.column_name for r in detect_json_columns(df, columns).collect() if r.is_json]


def _literal_to_json(text: str):
    try:
        return json.dumps(ast.literal_eval(text.strip()), ensure_ascii=False)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def _literals(s: pd.Series) -> pd.Series:
    return s.map(_literal_to_json, na_action="ignore")


def parse_embedded(c: Column) -> Column:
    """VARIANT: JSON, else a Python literal, else the text itself; blank is NULL.

    Only text that looks like JSON but is not goes through Python.
    """
    looks_json = c.rlike(JSON_START)
    direct = F.try_parse_json(F.when(looks_json, c))
    literal = F.try_parse_json(_literals(F.when(looks_json & direct.isNull(), c)))
    text = F.when(strip_space(c) != "", c).cast("variant")
    return F.coalesce(direct, literal, text)


def json_text(c: Column) -> Column:
    """The column as JSON text if it holds JSON or a Python literal, else NULL."""
    looks_json = c.rlike(JSON_START)
    valid = F.try_parse_json(F.when(looks_json, c)).isNotNull()
    return F.when(valid, strip_space(c)).otherwise(_literals(F.when(looks_json & ~valid, c)))


def _elements(text: Column, **fields: tuple[str, str]) -> Column:
    """Array of structs from JSON text; an element or field of another shape gives NULLs, no list gives NULL."""
    array = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    return F.transform(array, lambda x: F.struct(*[F.try_variant_get(x, path, kind).alias(n) for n, (path, kind) in fields.items()]))


def breadcrumbs(text: Column) -> Column:
    return _elements(text, name=("$.name", "string"))


def secondary_averages(text: Column) -> Column:
    return _elements(text, id=("$.id", "string"), value=("$.value", "double"))


def children(text: Column) -> Column:
    """Prices, brand, import designation and bullet texts of each child."""
    return _elements(
        text,
        current_retail=("$.price.current_retail", "string"),
        reg_retail=("$.price.reg_retail", "string"),
        brand=("$.item.primary_brand.name", "string"),
        handling=("$.item.handling.import_designation_description", "string"),
        bullets=("$.item.product_description.bullet_descriptions", "array<string>"),
    )


def breadcrumb_path(crumbs: Column) -> Column:
    """Non-empty names joined by `` > ``."""
    names = F.filter(F.transform(crumbs, lambda x: x["name"]), lambda n: n.isNotNull() & (n != ""))
    return F.array_join(names, " > ")


def keyed_value(averages: Column, key: str) -> Column:
    """Value of the first element with the given id."""
    return F.get(F.filter(averages, lambda x: x["id"] == key), F.lit(0))["value"]


def array_mode(values: Column) -> Column:
    """Most frequent element of a small array, the smallest on ties; NULL when empty."""
    ranked = F.transform(
        F.array_distinct(values),
        lambda v: F.struct((-F.size(F.filter(values, lambda x: x == v))).alias("c"), v.alias("v")),
    )
    return F.array_min(ranked)["v"]


def _filled(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def child_prices(children: Column) -> Column:
    prices = F.transform(children, lambda x: numeric(F.coalesce(x["current_retail"], x["reg_retail"])))
    return F.filter(prices, lambda p: p.isNotNull())


def package_quantities(children: Column) -> Column:
    """First ``Package Quantity`` number of each child that has one."""

    def first_match(x: Column) -> Column:
        hits = F.filter(F.transform(x["bullets"], lambda b: F.regexp_extract(b, PACKAGE_QUANTITY, 1)), lambda s: s != "")
        return F.get(hits, F.lit(0)).try_cast("bigint")

    return F.filter(F.transform(children, first_match), lambda q: q.isNotNull())


def children_rollup(children: Column) -> dict[str, Column]:
    """Price range and modes over the children of one row; no shuffle, as a row holds its children."""
    prices = child_prices(children)
    return {
        "children_price_min": F.array_min(prices),
        "children_price_max": F.array_max(prices),
        "children_brand_mode": array_mode(_filled(F.transform(children, lambda x: x["brand"]))),
        "children_handling_mode": array_mode(_filled(F.transform(children, lambda x: x["handling"]))),
        "children_pkg_qty_mode": array_mode(package_quantities(children)),
    }


def derive_from_json(df: DataFrame) -> DataFrame:
    """Columns derived from the known nested shapes that ``df`` has as JSON text."""
    if BREADCRUMBS in df.columns:
        crumbs = breadcrumbs(json_text(F.col(BREADCRUMBS)))
        df = df.withColumn(CATEGORY_PATH, breadcrumb_path(crumbs))
        df = df.withColumn(parsed(BREADCRUMBS), F.when(crumbs.isNotNull(), json_text(F.col(BREADCRUMBS))))
    if SECONDARY_AVERAGES in df.columns:
        averages = secondary_averages(json_text(F.col(SECONDARY_AVERAGES)))
        df = df.withColumns(
            {"rating_quality": keyed_value(averages, "quality"), "rating_value": keyed_value(averages, "value")}
        )
    if CHILDREN in df.columns:
        df = df.withColumn("__children", children(json_text(F.col(CHILDREN))))
        df = df.withColumns(children_rollup(F.col("__children"))).drop("__children")
    return df
