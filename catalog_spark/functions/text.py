"""Text expressions: markup removal, title case, tokens."""

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Whitespace as Python's str methods see it, spelled out for Java and RE2 alike.
SPACE = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]"
SPACES = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
WORD = r"([\p{L}\p{N}_]{2,})"


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def _decompose(text: str) -> str:
    text = unicodedata.normalize("NFKD", text)
    for mark in filter(unicodedata.combining, set(text)):  # a few different ones, in a text of any length
        text = text.replace(mark, "")
    return text


@F.pandas_udf(T.StringType())
def _strip_marks(s: pd.Series) -> pd.Series:
    return s.map(_decompose, na_action="ignore")


def _only_where(condition: Column, udf, c: Column) -> Column:
    """Apply a Python function to the rows that need it; the others send a NULL."""
    return F.when(condition, udf(F.when(condition, c))).otherwise(c)


def once(c: Column) -> Column:
    """``c`` worked out once a row: filters further up do not move below an explode, where each would work it out again.

    For a select without another generator.
    """
    return F.explode_outer(F.array(c))


def strip_space(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def squeeze_space(c: Column) -> Column:
    return F.regexp_replace(c, f"{SPACE}+", " ")


def strip_html(c: Column) -> Column:
    """Entities first, then tags, bullets and runs of whitespace; text between tags stays."""
    text = _only_where(c.contains("&"), _unescape, c)
    text = F.regexp_replace(text, "<[^>]+>", " ")
    text = F.regexp_replace(text, "&bull;|•", " ")
    return F.trim(squeeze_space(text))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters (``initcap`` only knows spaces)."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def fold_accents(c: Column) -> Column:
    return _only_where(F.octet_length(c) != F.char_length(c), _strip_marks, c)


def words(folded: Column) -> Column:
    """Words of two or more word characters in text that is lower-cased and accent-free."""
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(1))


def tokens(c: Column) -> Column:
    """Lower-cased, accent-free words of two or more word characters."""
    return words(fold_accents(F.lower(c)))


def bigrams(words: Column) -> Column:
    n = F.size(words)
    pairs = F.zip_with(
        F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def corpus(parts: list[Column]) -> Column:
    """Clean each part and join what is not null."""
    return F.concat_ws(" \n ", *[strip_html(p) for p in parts])
