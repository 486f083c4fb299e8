"""Cleaning stage of the product table: one lazy plan without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import spec
from ..functions import clean
from ..operators.embedded import derive_from_json
from ..operators.features import as_numbers


def price_chain(df: DataFrame, chain: tuple[str, ...]) -> Column:
    """First number along the columns of ``chain`` that exist."""
    return clean.first_number(as_numbers(df, spec.present(df, chain)))


def add_volume(df: DataFrame, dimensions: tuple[str, ...] = spec.DIMENSIONS) -> DataFrame:
    """Volume and its missing flag, always present; NULL if any dimension is missing."""
    found = spec.present(df, dimensions)
    if len(found) == len(dimensions):
        a, b, c = as_numbers(df, found)
        volume = a * b * c
    else:
        volume = F.lit(None).cast("double")
    df = df.withColumn(spec.VOLUME, volume)
    return df.withColumn(spec.missing(spec.VOLUME), clean.missing_flag(F.col(spec.VOLUME)))


def derive_numbers(df: DataFrame) -> DataFrame:
    """Price fallbacks, then missing flags, then volume and weight."""
    for chain in (spec.MIN_PRICE_CHAIN, spec.MAX_PRICE_CHAIN):
        lead = chain[0]
        if lead in df.columns:
            df = df.withColumn(lead, price_chain(df, chain))
            df = df.withColumn(spec.missing(lead), clean.missing_flag(F.col(lead)))
    df = add_volume(df)
    if spec.WEIGHT in df.columns:
        df = df.withColumn(spec.WEIGHT, as_numbers(df, [spec.WEIGHT])[0])
        df = df.withColumn(spec.missing(spec.WEIGHT), clean.missing_flag(F.col(spec.WEIGHT)))
    return df


def clean_products(df: DataFrame) -> DataFrame:
    """Embedded JSON, canonical origins, risk flag, numeric derivations and price band, in that order."""
    df = derive_from_json(df)
    origins = spec.present(df, spec.ORIGIN_COLUMNS)
    if origins:
        df = df.withColumns({c: clean.canonical_origin(F.col(c)) for c in origins})
    df = df.withColumn("tariff_risk", clean.tariff_risk([F.col(c) for c in origins]))
    return derive_numbers(df)


def add_price_band(df: DataFrame, column: str = spec.MAX_PRICE_CHAIN[0]) -> DataFrame:
    price = as_numbers(df, [column])[0] if column in df.columns else F.lit(None).cast("double")
    return df.withColumn("price_band", clean.price_band(price))
