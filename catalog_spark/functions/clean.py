"""Column expressions that clean and derive product attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import squeeze_space, strip_space, title_case

NUMERIC_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"

# Upper bounds (inclusive) and names of the price bands.
PRICE_BOUNDS = [10, 25, 50, 100, 250, 500, 1000]
PRICE_BANDS = ["<$10", "$10–25", "$25–50", "$50–100", "$100–250", "$250–500", "$500–1000", ">$1000"]

# Names of the canonical origins.
ASSEMBLED_USA = "Assembled in USA (foreign/domestic parts)"
MADE_AND_IMPORTED = "Made in USA and Imported"
MADE_USA = "Made in USA"
IMPORTED = "Imported"


def numeric(c: Column, is_text: bool = True) -> Column:
    """Number or NULL; NaN counts as missing."""
    if is_text:
        text = strip_space(c.cast("string"))
        return F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def first_number(candidates: list[Column]) -> Column:
    return F.coalesce(*candidates)


def missing_flag(c: Column) -> Column:
    return c.isNull().cast("int")


def canonical_origin(c: Column) -> Column:
    """Import designation in one of four canonical forms, else in title case."""
    text = strip_space(c)
    t = F.replace(squeeze_space(F.replace(F.lower(text), F.lit("&"), F.lit("and"))), F.lit(" the usa"), F.lit(" usa"))
    usa = t.contains("usa")
    return (
        F.when(text == "", F.lit(None).cast("string"))
        .when(t.contains("assem") & usa, ASSEMBLED_USA)
        .when(t.contains("made") & usa & t.contains("import"), MADE_AND_IMPORTED)
        .when(t.contains("made") & usa, MADE_USA)
        .when(t.contains("import"), IMPORTED)
        .otherwise(title_case(text))
    )


def import_exposure(c: Column) -> Column:
    """1 exposed to import duty, 0 domestic, NULL undecided."""
    t = F.lower(c)
    exposed = t.contains("import") | t.contains("foreign") | t.contains("assembled")
    return F.when(exposed, 1).when(t.contains("usa"), 0)


def tariff_risk(candidates: list[Column]) -> Column:
    """First decided candidate, 0 when none is decided or none exists."""
    return F.coalesce(*[import_exposure(c) for c in candidates], F.lit(0)).cast("int")


def price_band(price: Column) -> Column:
    """Right-closed band of a price; NULL stays NULL."""
    band = F.when(price.isNull() | F.isnan(price), F.lit(None).cast("string"))
    for bound, label in zip(PRICE_BOUNDS, PRICE_BANDS):
        band = band.when(price <= bound, label)
    return band.otherwise(PRICE_BANDS[-1])


def price_band_rank(price: Column) -> Column:
    """Position of the band, for sorting."""
    rank = F.when(price.isNull() | F.isnan(price), F.lit(None).cast("int"))
    for i, bound in enumerate(PRICE_BOUNDS):
        rank = rank.when(price <= bound, i)
    return rank.otherwise(len(PRICE_BOUNDS))


def iso_second(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
