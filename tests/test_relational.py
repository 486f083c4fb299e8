import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from catalog_spark.operators import quantiles, relate, skew, summary
from catalog_spark.operators.profile import inf_profile, null_profile

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=40))
def test_dedup_is_idempotent_and_load_is_distinct_union(spark, pairs):
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(pairs)], "a int, b int, i int")
    once = relate.first_per_key(df, ["a", "b"], [F.col("i")])
    twice = relate.first_per_key(once, ["a", "b"], [F.col("i")])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    stored, incoming = df.where("i % 2 = 0").dropDuplicates(["a", "b"]), df
    merged = relate.merge_new(stored, incoming, ["a", "b"], [F.col("i")])
    assert sorted((r.a, r.b) for r in merged.collect()) == sorted(set(pairs))


def test_worklist_is_the_whole_product(rows):
    stores, cats = rows([(i,) for i in range(7)], "s int"), rows([(f"c{i}",) for i in range(11)], "c string")
    work = relate.worklist(stores, cats)
    assert work.distinct().count() == 77 == work.count()
    offsets = [r.offset for r in relate.page_plan(work, 24, 1199).where("s = 0 and c = 'c1'").orderBy("offset").collect()]
    assert offsets == list(range(0, 1200, 24))


def test_provenance_precedence(rows):
    df = rows([("own", 1)], "_tcin string, x int")
    assert relate.with_provenance(df, {"_tcin": F.lit("ctx")}, payload_wins=True).first()._tcin == "own"
    assert relate.with_provenance(df, {"_tcin": F.lit("ctx")}, payload_wins=False).first()._tcin == "ctx"


def test_blank_keys(rows):
    df = rows([(" a ",), ("",), ("  ",), (None,)], "k string")
    assert [r.k for r in relate.drop_blank_keys(df, ["k"]).collect()] == ["a"]


@pytest.mark.parametrize("broadcast_rows", [100, 0])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_both_ways(rows, broadcast_rows, how):
    """The hot key takes another route than the rest; the rows are the same."""
    facts = rows([(k, i) for i, k in enumerate(["hot"] * 30 + ["x", "y", None, None])], "k string, i int")
    lookup = rows([("hot", 1), ("x", 2), (None, 3)], "k string, v int")
    got = skew.lookup_join(facts, lookup, ["k"], how, max_rows=broadcast_rows, hot_rows=10)
    values = {(r.k, r.i): r.v for r in got.collect()}
    assert len(values) == (34 if how == "left" else 33)
    assert values[("hot", 5)] == 1 and values[(None, 33)] == 3 and values.get(("y", 31)) is None


@pytest.mark.parametrize("prob", [0.5, 0.95])
def test_group_quantile_is_exact(spark, prob):
    rng = np.random.default_rng(3)
    groups = {
        "one": rng.normal(size=1), "two": rng.normal(size=2), "four": np.array([1.0, 2.0, 3.0, 4.0]), "same": np.full(50, 7.0),
        "large": rng.exponential(size=30_000), "copies": np.concatenate([np.full(20_000, 3.0), rng.normal(size=15_000)]),
    }
    data = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("four", None), ("none", None), ("four", float("nan"))]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: r.q for r in quantiles.group_quantile(df, ["g"], "x", prob, "q").collect()}
    assert got.keys() == groups.keys()
    for g, xs in groups.items():
        assert got[g] == pytest.approx(np.quantile(xs, prob), rel=1e-12)
    whole = quantiles.group_quantile(df, [], "x", prob, "q").first().q
    assert whole == pytest.approx(np.quantile(np.concatenate(list(groups.values())), prob), rel=1e-12)


@pytest.mark.parametrize("small,bins", [(1, 2), (3, 4)])
def test_quantile_by_many_rounds(spark, monkeypatch, small, bins):
    monkeypatch.setattr(quantiles, "SMALL", small)
    monkeypatch.setattr(quantiles, "BINS", bins)
    close = 1.0 + np.arange(40) * np.finfo(float).eps  # neighbours among the doubles
    groups = {
        "close": close, "tiny": np.arange(1, 9) * 5e-324, "signs": np.array([-1e308, -3.0, -2.5e-320, 0.0, -0.0, 4.0, 1e308]), "skewed": np.r_[np.full(30, 2.0), 2.0000001],
        None: np.array([float("-inf"), 1.0, float("inf"), float("inf")]),
    }
    df = spark.createDataFrame([(g, float(v)) for g, xs in groups.items() for v in xs], "g string, x double")
    for prob in (0.0, 0.5, 0.7, 1.0):
        got = {r.g: r.q for r in quantiles.group_quantile(df, ["g"], "x", prob, "q").collect()}
        for g, xs in groups.items():
            at = prob * (len(xs) - 1)
            low, high = sorted(xs)[int(np.floor(at))], sorted(xs)[int(np.ceil(at))]
            assert got[g] == (low if low == high else low + (high - low) * (at - np.floor(at)))


def test_first_bins_never_fall(spark):
    x = np.sort(np.r_[np.geomspace(5e-324, 1.7e308, 3000), -np.geomspace(5e-324, 1.7e308, 3000), 0.0, np.inf, -np.inf, np.nextafter(2.0 ** np.arange(-20, 20), 0)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double")
    bins = [r.b for r in df.select("i", quantiles._first_bin(F.col("x")).alias("b")).orderBy("i").collect()]
    assert bins == sorted(bins)


def test_group_mode(rows):
    df = rows([("a", "y"), ("a", "x"), ("a", "y"), ("a", "x"), ("b", None), ("c", None), ("c", "z")], "g string, v string")
    assert {r.g: r.mode for r in quantiles.group_mode(df, ["g"], "v").collect()} == {"a": "x", "b": None, "c": "z"}


def test_outlier_flag(rows):
    data = [("eq", 1.0)] * 5 + [("one", 3.0)] + [("up", float(i)) for i in range(40)]
    df = rows(data, "cluster_id string, cluster_dist double")
    got = summary.outlier_flag(df).where("cluster_outlier = 1").collect()
    assert sorted(r.cluster_dist for r in got) == [38.0, 39.0] and {r.cluster_id for r in got} == {"up"}


def test_cluster_summary_order(rows):
    data = [(0, "b", 5.0, 1, 0), (0, None, 7.0, 0, 1), (1, "c", None, 1, 0), (1, "c", None, 1, 0), (2, "d", 1.0, None, None)]
    df = rows(data, "cluster_id int, cluster_label string, `data-product-price-reg_retail_max` double, tariff_risk int, cluster_outlier int")
    got = [tuple(r) for r in summary.cluster_summary(df).collect()]
    assert got == [(0, 2, "b", 6.0, 0.5, 0.5), (1, 2, "c", None, 1.0, 0.0), (2, 1, "d", 1.0, 0.0, 0.0)]


def test_rank_rows(rows):
    df = rows([(i, i % 7) for i in range(500)], "i int, k int")
    by = [F.col("k").desc(), F.col("i").asc()]
    got = {r.i: r["rank"] for r in summary.rank_rows(df, by).collect()}
    want = sorted(range(500), key=lambda i: (-(i % 7), i))
    assert got == {i: n + 1 for n, i in enumerate(want)}


def test_min_max_scale(rows):
    df = rows([(1.0, 5.0, None, 1.0), (3.0, 5.0, None, float("inf"))], "a double, b double, c double, d double")
    for c, want in [("a", [0.0, 1.0]), ("b", [0.0, 0.0]), ("c", [0.0, 0.0]), ("d", [0.0, 0.0])]:
        assert [r.s for r in summary.min_max_scale(df, c, "s").collect()] == pytest.approx(want, abs=1e-8)


def test_seeded_sample(rows):
    df = rows([(i,) for i in range(100)], "i int")
    pick = lambda seed, n=10: sorted(r.i for r in summary.seeded_sample(df, F.col("i"), n, seed).collect())
    assert pick(1) == pick(1) != pick(2) and len(pick(1)) == 10 and len(pick(1, 1000)) == 100
    for n in (1, 40, 99, 100, 200):
        counted = summary.seeded_sample(df, F.col("i"), n, 1)
        assert sorted(r.i for r in counted.collect()) == pick(1, n)


def test_profiles(rows):
    df = rows([(i, None if i % 2 else 1.0, float("nan") if i == 3 else float("-inf") if i == 4 else 1.0, "x") for i in range(20)], "id int, a double, b double, c string")
    got = {r.column_name: (r.n_null, r.percent, r.examples) for r in null_profile(df, "id").collect()}
    assert got == {"a": (10, 50.0, "1,3,5,7,9"), "b": (1, 5.0, "3")}
    assert [(r.column_name, r.n_inf, r.examples) for r in inf_profile(df, "id").collect()] == [("b", 1, "4")]
