import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from catalog_spark import spec
from catalog_spark.functions import clean, text
from catalog_spark.plans.cleaning import add_price_band, clean_products, derive_numbers

SLOW = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(rows, values, fn, kind="string"):
    df = rows([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_strip_html(rows):
    given_text = ["&lt;b&gt;x", "a&bull;b", "<p>a</p>\n\t b", "&amp;lt;", None, "a&nbsp;&nbsp;b", "plain", "x &hearts; <script>kept</script>", "•a•"]
    assert column(rows, given_text, text.strip_html) == ["x", "a b", "a b", "&lt;", None, "a b", "plain", "x ♥ kept", "a"]


def test_canonical_origin(rows):
    values = [
        "Made in the USA", "Imported", "Made in the USA & Imported", "Assembled in the USA", None, "  ", "FOREIGN/domestic",
        " MADE IN  THE USA ", "not specified", "USA/mexico don't",
    ]
    want = [
        clean.MADE_USA, clean.IMPORTED, clean.MADE_AND_IMPORTED, clean.ASSEMBLED_USA, None, None, "Foreign/Domestic",
        clean.MADE_USA, "Not Specified", "Usa/Mexico Don'T",
    ]
    assert column(rows, values, clean.canonical_origin) == want
    named = [clean.MADE_USA, clean.IMPORTED, clean.MADE_AND_IMPORTED, clean.ASSEMBLED_USA]
    assert column(rows, named, clean.canonical_origin) == named


def test_title_case_follows_letters(rows):
    values = ["usa/mexico don't", "élan vital", "3rd-party x"]
    assert column(rows, values, text.title_case) == [v.title() for v in values]


def test_tariff_risk(rows):
    df = rows([("Imported", None), (None, "Made in USA"), (None, None), ("Not Specified", "Foreign"), ("Made in the USA", "Imported")], "a string, b string")
    got = df.select(clean.tariff_risk([F.col("a"), F.col("b")]).alias("r")).collect()
    assert [r.r for r in got] == [1, 0, 0, 1, 0]
    assert df.select(clean.tariff_risk([]).alias("r")).distinct().collect()[0].r == 0


def test_price_band(rows):
    values = [-5.0, 0.0, 10.0, 10.01, 25.0, 1000.0, 1000.5, None, float("nan")]
    assert column(rows, values, clean.price_band, "double") == ["<$10", "<$10", "<$10", "$10–25", "$10–25", "$500–1000", ">$1000", None, None]


@SLOW
@given(st.lists(st.floats(-1e6, 1e6), min_size=2, max_size=30))
def test_price_band_is_total_and_monotone(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = sorted((r.x, r.k, r.b) for r in df.select("x", clean.price_band_rank(F.col("x")).alias("k"), clean.price_band(F.col("x")).alias("b")).collect())
    assert [r[1] for r in got] == sorted(r[1] for r in got)
    assert all(clean.PRICE_BANDS[k] == b for _, k, b in got)


def test_numeric(rows):
    values = [" 5.5 ", "1e3", "", "n/a", None, "5d", "-.5", "+7", "inf", "NaN", "1_000", "0x10"]
    assert column(rows, values, clean.numeric) == [5.5, 1000.0, None, None, None, None, -0.5, 7.0, float("inf"), None, None, None]


def test_tokens(rows):
    values = ["Crème brûlée, 2x a I!", "", None, "ﬁne_x ½cup"]
    got = column(rows, values, lambda c: F.concat(text.tokens(c), text.bigrams(text.tokens(c))))
    # the fraction is 1, a slash and 2: the lone 1 goes, the 2 stays with the word
    assert got == [["creme", "brulee", "2x", "creme brulee", "brulee 2x"], [], None, ["fine_x", "2cup", "fine_x 2cup"]]


def test_corpus_skips_nulls_only(rows):
    df = rows([("a &amp; b", None, "<i>c</i>"), ("x", "", "y")], "p string, q string, r string")
    got = df.select(text.corpus([F.col("p"), F.col("q"), F.col("r")]).alias("c")).collect()
    assert [r.c for r in got] == ["a & b \n c", "x \n  \n y"]


def test_derivations_and_missing_flags(rows):
    low, now = spec.MIN_PRICE_CHAIN[0], spec.MIN_PRICE_CHAIN[1]
    df = rows([("1.5", "9", 2.0), (None, "7", 3.0), ("bad", None, None)], f"`{low}` string, `{now}` string, children_price_min double")
    got = derive_numbers(df).collect()
    assert [r[low] for r in got] == [1.5, 7.0, None]
    assert [r[spec.missing(low)] for r in got] == [0, 0, 1]
    assert [r[spec.VOLUME] for r in got] == [None] * 3 and [r[spec.missing(spec.VOLUME)] for r in got] == [1] * 3


def test_clean_products_on_sparse_input(rows):
    got = add_price_band(clean_products(rows([("a",)], "only string"))).collect()[0]
    assert (got.tariff_risk, got.price_band, got.pkg_volume_lwh__missing) == (0, None, 1)


def test_feature_spec(rows):
    names = [spec.NUMERIC_COLUMNS[0], spec.DIMENSIONS[0], "rating_value", spec.VOLUME, spec.missing(spec.VOLUME), spec.TEXT_COLUMNS[0], spec.CATEGORY_PATH]
    df = rows([], ", ".join(f"`{n}` string" for n in names))
    before = spec.NUMERIC_COLUMNS
    found = spec.FeatureSpec().resolve(df)
    assert found.numeric == (spec.NUMERIC_COLUMNS[0], "rating_value", spec.VOLUME, spec.missing(spec.VOLUME))
    assert found.text == (spec.TEXT_COLUMNS[0], spec.CATEGORY_PATH) and found.categorical == ()
    assert spec.FeatureSpec.from_options(numeric="a|b").numeric == ("a", "b") and spec.NUMERIC_COLUMNS is before


def test_output_columns_follow_neighbour_count(rows):
    assert [c for c in spec.output_columns(5) if c.startswith("nn")][-2:] == ["nn5_id", "nn5_dist"]
    assert spec.curated(rows([("t", 1, "x")], "_tcin string, cluster_id int, other string")).columns == ["cluster_id", "_tcin"]


def test_item_id(rows):
    df = rows([("a", 5)], "`data-product-item-dpci` string, _tcin int")
    assert df.select(spec.item_id(df).alias("i")).first().i == "5"
    plain = rows([("a", 5), ("b", 5)], "x string, y int")
    assert plain.select(spec.item_id(plain).alias("i")).distinct().count() == 2


@pytest.mark.parametrize("value,want", [("2024-01-02 03:04:05.678", "2024-01-02T03:04:05")])
def test_iso_second(rows, value, want):
    df = rows([(value,)], "x string")
    assert df.select(clean.iso_second(F.col("x").cast("timestamp_ntz")).alias("y")).first().y == want
