from functools import reduce

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.ml.functions import array_to_vector, vector_to_array

from catalog_spark.functions.vectors import nonfinite_entries
from catalog_spark.operators import cluster, features, grouped as grouped_counts, kselect, lloyd, neighbors, project, tfidf

rng = np.random.default_rng(7)


def vectors(spark, x, labels=None, **extra):
    labels = np.zeros(len(x), dtype=int) if labels is None else labels
    data = [(i, int(c), [float(v) for v in r], *[v[i] for v in extra.values()]) for i, (r, c) in enumerate(zip(x, labels))]
    return spark.createDataFrame(data, "id long, c int, v array<double>" + "".join(f", {k} string" for k in extra))


def brute(x, labels, k):
    out = {}
    for i in range(len(x)):
        others = [j for j in np.flatnonzero(labels == labels[i]) if j != i]
        ranked = sorted(others, key=lambda j: (np.sqrt(((x[i] - x[j]) ** 2).sum()), j))
        out.update({(i, r + 1): str(j) for r, j in enumerate(ranked[:k])})
    return out


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_neighbours_equal_brute_force(spark, block_rows):
    """One cluster holds most rows, some rows are copies, one cluster has a single row."""
    x = np.concatenate([rng.normal(size=(150, 3)), rng.normal(size=(60, 3)) * 0.01 + 5])
    x[20:40] = x[0]
    labels = np.where(np.arange(len(x)) % 5 == 4, 1, 0)
    labels[-1] = 2
    found = neighbors.nearest_in_cluster(vectors(spark, x, labels), "id", "c", "v", 3, block_rows=block_rows, pivots_per_cluster=8)
    got = {(r.id, r["rank"]): r.nn_id for r in found.collect()}
    assert got == brute(x, labels, 3)


def test_neighbours_with_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "HOT_ROWS", 10)
    x = np.concatenate([np.ones((40, 2)), np.full((5, 2), 3.0), rng.normal(size=(20, 2))])
    labels = np.zeros(len(x), dtype=int)
    found = neighbors.nearest_in_cluster(vectors(spark, x, labels), "id", "c", "v", 2, block_rows=8)
    assert {(r.id, r["rank"]): r.nn_id for r in found.collect()} == brute(x, labels, 2)


def test_neighbours_of_distinct_items(spark):
    x = rng.normal(size=(60, 2))
    x[:30] = x[0]
    items = ["a"] * 25 + [f"i{j // 2}" for j in range(35)]
    found = neighbors.nearest_in_cluster(vectors(spark, x, item=items), "id", "c", "v", 3, item="item", distinct_item=True, block_rows=16)
    got = {}
    for r in found.collect():
        got.setdefault(r.id, {})[r["rank"]] = r.nn_id
    for i in range(60):
        best = {}
        for j in range(60):
            if items[j] != items[i]:
                key = (np.sqrt(((x[i] - x[j]) ** 2).sum()), j)
                best[items[j]] = min(best.get(items[j], key), key)
        want = [name for name, _ in sorted(best.items(), key=lambda kv: kv[1])][:3]
        assert [got[i][r] for r in (1, 2, 3)] == want


def test_widen_small_clusters(spark):
    df = vectors(spark, np.array([[0.0], [1.0], [9.0]]), np.array([0, 0, 1]))
    found = neighbors.nearest_in_cluster(df, "id", "c", "v", 3)
    wide = {r.id: (r.nn1_id, r.nn1_dist, r.nn2_id) for r in neighbors.widen(df, found, "id", 3).collect()}
    assert wide == {0: ("1", 1.0, None), 1: ("0", 1.0, None), 2: (None, None, None)}


def silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(len(x)) != i)
        if not same.any():
            scores.append(0.0)
            continue
        a, b = d[i, same].mean(), min(d[i, labels == c].mean() for c in set(labels) if c != own)
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_metrics_equal_formulas(spark, monkeypatch):
    monkeypatch.setattr(kselect.blocks, "BLOCK_ROWS", 32)
    x = rng.normal(size=(100, 4))
    labels = rng.integers(0, 3, 100)
    labels[0] = 7
    df = vectors(spark, x, labels)
    got = kselect.silhouette(df, "id", "v", {4: "c"}).first().silhouette
    assert got == pytest.approx(silhouette(x, labels), abs=1e-9)
    row = kselect.partition_metrics(df, {4: "c"}, "v").first()
    centers = {c: x[labels == c].mean(0) for c in set(labels)}
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in centers.items())
    between = sum((labels == c).sum() * ((m - x.mean(0)) ** 2).sum() for c, m in centers.items())
    assert row.inertia == pytest.approx(within) and row.calinski_harabasz == pytest.approx((between / 3) / (within / 96))


def test_silhouette_deals_the_rows_to_few_groups(spark, monkeypatch):
    monkeypatch.setattr(kselect.blocks, "BLOCK_ROWS", 8)
    x, labels = rng.normal(size=(400, 4)), rng.integers(0, 3, 400)
    df = vectors(spark, x, labels).selectExpr("*", "0 AS one")
    for limit in (1 << 24, 20):
        monkeypatch.setattr(kselect, "GROUP_VALUES", limit, raising=False)
        found = kselect.silhouette(df, "id", "v", {2: "one", 3: "c"})
        text = found._jdf.queryExecution().executedPlan().toString()
        got = {r.k: r.silhouette for r in found.collect()}
        assert got[2] is None and got[3] == pytest.approx(silhouette(x, labels), abs=1e-9)
        assert "Join" not in text and len(got) == 2


# Worked out by hand: fewer than three points take the largest inertia; of (0, 1), (.25, .318), (.5, .091), (.75, .034), (1, 0)
# the sums x + y are 1, .568, .591, .784, 1, so the second is farthest below the line x + y = 1; a flat curve lies on its
# chord, so the first counts; the last drops at once, to x + y = .2 + .091.
@pytest.mark.parametrize("inertias, want", [([9.0, 4.0], 2), ([100.0, 40.0, 20.0, 15.0, 12.0], 3), ([5.0, 5.0, 5.0], 2), ([50.0, 10.0, 9.0, 8.0, 7.0, 6.0], 3)])
def test_elbow(rows, inertias, want):
    df = rows(list(zip(range(2, 2 + len(inertias)), inertias)), "k int, inertia double")
    assert kselect.elbow_k(df).first().inertia_elbow_k == want


def test_squared_silhouette(spark):
    x = rng.normal(size=(60, 3))
    labels = rng.integers(0, 3, 60)
    labels[0] = 7  # alone: scores 0
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(60) != i)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - d[i, same].mean()) / max(b, d[i, same].mean()) if same.any() else 0.0)
    df = vectors(spark, x, labels).withColumn("one", F.lit(1))
    got = {r.k: r.silhouette for r in kselect.silhouette_squared(df, "v", {4: "c", 1: "one"}).collect()}
    assert got[4] == pytest.approx(np.mean(scores)) and got[1] is None


def test_infinities_stop_the_fit(rows):
    with pytest.raises(ValueError, match="infinite values in .*'b'"):
        features.fit_numeric(rows([(1.0, 1.0), (2.0, float("inf"))], "a double, b double"), ["a", "b"])


@pytest.mark.parametrize(
    "sil,ch,want",
    [
        ([0.5, 0.5, 0.4, 0.3, 0.51], [9.0, 8.0, 7.0, 6.0, 9.1], "best"),
        ([None] * 5, [1.0, 2.0, 3.0, 4.0, 5.0], "best"),
        ([0.0, 0.995, 0.2, 0.3, 1.0], [1.0, 5.0, 2.0, 3.0, 5.0], "elbow"),
    ],
)
def test_choose_k(rows, sil, ch, want):
    inertias = [100.0, 20.0, 18.0, 16.0, 15.0]
    df = rows([(k, i, s, c) for k, i, s, c in zip(range(2, 7), inertias, sil, ch)], "k int, inertia double, silhouette double, calinski_harabasz double")
    scores = kselect.score_table(df)
    assert scores.columns == ["k", "inertia", "silhouette", "calinski_harabasz", "inertia_elbow_k", "sil_norm", "ch_norm", "score"]
    got = kselect.choose_k(scores).first()
    assert (got.best_k, got.inertia_elbow_k) == (6, 3) and got.chosen_k == (6 if want == "best" else 3)


def blobs(n=40):
    centers = np.array([[0, 0], [20, 0], [0, 20]])
    truth = np.repeat(np.arange(3), n)
    return centers[truth] + rng.normal(size=(3 * n, 2)), truth


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_kmeans_recovers_blobs(spark):
    x, truth = blobs()
    df = vectors(spark, x).cache()
    centers = cluster.fit_kmeans(df, 3, "id", "v", restarts=3)
    got = [r.a for r in df.select("id", cluster.nearest_center(centers)("v").alias("a")).orderBy("id").collect()]
    assert same_partition(got, truth)
    with pytest.raises(ValueError):
        cluster.fit_kmeans(df, 1)


def plain_lloyd(x, centers, steps):
    for _ in range(steps):
        own = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
        centers = np.array([x[own == j].mean(0) if (own == j).any() else centers[j] for j in range(len(centers))])
    return centers, ((x[:, None] - centers) ** 2).sum(2).min(1).sum()


@pytest.mark.parametrize("few", [0, 32])
def test_runs_that_share_their_passes(spark, monkeypatch, few):
    x = rng.normal(size=(120, 3)) + 1e6  # far from the origin
    starts = [x[:2], x[5:9], x[20:21], np.vstack([x[:3], [[0.0, 0.0, 0.0]]])]
    monkeypatch.setattr(lloyd, "FEW_TASKS", few)
    fits = lloyd.fit_many(vectors(spark, x).repartition(3).cache(), starts, "v", max_iterations=4, tolerance=0.0)
    for fit, start in zip(fits, starts):
        centers, cost = plain_lloyd(x, start, 4)
        assert np.allclose(fit.centers, centers) and fit.cost == pytest.approx(cost)
    done = lloyd.fit_many(vectors(spark, x).cache(), [x[:2], x[5:9]], "v")
    assert all(1 < f.steps < 300 for f in done) and all(np.allclose(plain_lloyd(x, f.centers, 1)[0], f.centers, atol=1e-3) for f in done)


def test_sums_reach_the_driver_once(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    x, seen, collect = rng.normal(size=(80, 3)), [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: seen.append(collect(df)) or seen[-1])
    found = lloyd.moments(vectors(spark, x).repartition(8), [x[:2], x[:3]], "v")
    assert len(seen) == 1 and len(seen[0]) == 5
    assert all(n.sum() == 80 and np.allclose(sums.sum(0), x.sum(0)) for n, _, sums in found)


def test_moments_of_sparse_vectors(spark):
    from pyspark.ml.linalg import Vectors

    x = rng.normal(size=(40, 5)) * (rng.random((40, 5)) < 0.3)
    dense = vectors(spark, x, np.arange(40) % 3)
    sparse = spark.createDataFrame([(i % 3, Vectors.sparse(5, [(j, v) for j, v in enumerate(row) if v])) for i, row in enumerate(x.tolist())], ["c", "v"])
    a, b = ({r.c: r for r in cluster.cluster_moments(df, ["c"], "v").collect()} for df in (dense, sparse))
    for c in range(3):
        assert a[c].n == b[c].n and np.allclose(a[c].center, b[c].center) and a[c].within == pytest.approx(b[c].within)


def test_starts(spark):
    x, truth = blobs()
    df = vectors(spark, x).cache()
    by_rows = lloyd.row_starts(df, [2, 5], 3, "id", "v")
    assert [len(s) for own in by_rows for s in own] == [2] * 3 + [5] * 3 and (by_rows[0][1] == by_rows[1][1][:2]).all()
    for start in lloyd.spread_starts(df, [3], 4, "id", "v")[0]:
        assert len({truth[((x - c) ** 2).sum(1).argmin()] for c in start}) == 3  # one in each blob
    same = vectors(spark, np.array([[1.0, 2.0]] * 20 + [[5.0, 5.0]])).cache()
    assert len(cluster.fit_kmeans(same, 4, "id", "v", restarts=2)) == 2  # as many as there are different rows
    none = spark.createDataFrame([(1, None)], "id long, v array<double>")
    assert not len(cluster.fit_kmeans(none, 2, "id", "v", restarts=2))


def test_nearest_of_many_centres(spark, monkeypatch):
    monkeypatch.setattr(cluster, "CENTER_ROWS", 7)
    x, c = rng.normal(size=(80, 3)), rng.normal(size=(60, 3))
    c[41] = c[3]  # equal centres: the lower id
    x[0], x[1] = c[3], 1e5
    centers = spark.createDataFrame([(100 - i, [float(v) for v in r]) for i, r in enumerate(c)], "cluster_id int, center array<double>")
    rows = vectors(spark, x).select("id", "v").unionByName(spark.createDataFrame([(500, None)], "id long, v array<double>"))
    d = ((x[:, None] - c) ** 2).sum(axis=2)
    want = {i: min((d[i, j], 100 - j) for j in range(60))[1] for i in range(80)} | {500: None}
    for chunk in (1 << 24, 40):
        assert {r.id: r.near for r in cluster.assign_nearest(rows, centers, "v", "near", chunk).collect()} == want
    assert {r.near for r in cluster.assign_nearest(rows, centers.limit(0), "v", "near").collect()} == {None}


def test_minibatch_recovers_blobs(spark):
    x, truth = blobs()
    df = vectors(spark, x).select("id", "v").cache()
    centers = cluster.fit_minibatch(df, 3, "id", "v", batches=3, epochs=2, restarts=4)
    got = [r.a for r in df.select("id", cluster.nearest_center(centers)("v").alias("a")).orderBy("id").collect()]
    assert same_partition(got, truth)


def test_sweep_finds_three_blobs(spark):
    x, _ = blobs(25)
    df = vectors(spark, x).withColumn("features", array_to_vector("v")).select("id", "features").cache()
    scores = kselect.sweep(df, 2, 5, "id", restarts=2)
    assert kselect.choose_k(scores).first().best_k == 3
    assert [r.k for r in scores.orderBy("k").collect()] == [2, 3, 4, 5]


def test_svd_equals_numpy(spark):
    x = rng.normal(size=(50, 6)) + 2.0
    df = vectors(spark, x).withColumn("features", array_to_vector("v"))
    fit = project.fit_svd(df, 3, "id")
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert fit.singular_values == pytest.approx(s[:3], rel=1e-6)
    got = np.array([r.reduced for r in fit.transform(df, "id").orderBy("id").collect()])
    want = u[:, :3] * s[:3]
    assert np.abs(got) == pytest.approx(np.abs(want), rel=1e-5, abs=1e-6)
    assert all(c[np.abs(c).argmax()] > 0 for c in fit.components.T)
    flat = project.project_2d(df, "id").orderBy("id").collect()
    assert [abs(r.proj_y) for r in flat] == pytest.approx(list(np.abs(want[:, 1])), rel=1e-5, abs=1e-6)


def test_svd_of_sparse_wide_rows(spark, monkeypatch):
    """Fewer directions than columns, sparse and dense rows together, a null and an empty one, small parts and pieces."""
    monkeypatch.setattr(project, "OVERSAMPLING", 8)
    monkeypatch.setattr(project, "PIECE_ROWS", 16)
    monkeypatch.setattr(project, "CELLS", 200)
    m, n, k = 120, 60, 5
    x = (rng.normal(size=(m, 6)) * [50, 30, 20, 12, 7, 2]) @ rng.normal(size=(6, n)) * (rng.random((m, n)) < 0.6)
    x[3] = 0
    rows = [(i, Vectors.dense(r) if i % 3 else Vectors.sparse(n, {int(j): float(r[j]) for j in np.flatnonzero(r)})) for i, r in enumerate(x)]
    df = spark.createDataFrame([*rows, (m, None)], T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT())])).repartition(7)
    fit = project.fit_svd(df, k, "id", passes=30)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert fit.singular_values == pytest.approx(s[:k], rel=1e-5)
    got = {r.id: r.reduced for r in fit.transform(df, "id").collect()}
    assert got.pop(m) is None and got[3] == [0.0] * k
    assert np.abs([got[i] for i in range(m)]) == pytest.approx(np.abs(u[:, :k] * s[:k]), rel=1e-2, abs=1e-2 * s[0])
    few = project.fit_svd(df, k, "id")  # the default number of passes
    assert few.singular_values == pytest.approx(s[:k], rel=2e-2)


def test_svd_of_poor_tables(spark):
    """No rows, only nulls, one row, fewer rows than columns: no crash, zeros beyond the rank."""
    empty = spark.createDataFrame([], "id long, features array<double>")
    assert project.project_2d(empty, "id").count() == 0
    nulls = spark.createDataFrame([(1, None)], "id long, features array<double>")
    assert [(r.proj_x, r.proj_y) for r in project.project_2d(nulls, "id").collect()] == [(None, None)]
    one = spark.createDataFrame([(1, [3.0, 4.0, 0.0]), (2, [3.0, 4.0, 0.0])], "id long, features array<double>")
    assert [(r.proj_x, r.proj_y) for r in project.project_2d(one, "id").collect()] == [(pytest.approx(5), pytest.approx(0, abs=1e-9))] * 2
    assert project.fit_svd(one, 9, "id").singular_values == pytest.approx([50**0.5, 0, 0], abs=1e-9)
    with pytest.raises(Exception, match="components among"):
        project.project_2d(one.unionByName(spark.createDataFrame([(3, [1.0])], "id long, features array<double>")), "id").collect()


def test_numeric_scaler(rows):
    df = rows([("1", None, 4.0, 1.0), ("3", None, 4.0, None), ("x", None, 4.0, 3.0)], "a string, empty double, flat double, b double")
    fit = features.fit_numeric(df, ["a", "empty", "flat", "b"])
    assert fit.columns == ("a", "flat", "b") and fit.medians == (2.0, 4.0, 2.0)
    sd = np.std([1, 3, 2])
    got = fit.transform(df).collect()
    assert [r.num__a for r in got] == pytest.approx([1 / sd, 3 / sd, 2 / sd]) and [r.num__flat for r in got] == [4.0] * 3
    single = features.fit_numeric(rows([(5.0,)], "z double"), ["z"])
    assert single.divisors == (1.0,)


def test_categories(rows):
    data = [("x",)] * 5 + [("y",)] * 4 + [(None,)] * 6 + [("z",)]
    df = rows([(i, *r) for i, r in enumerate(data)], "id int, c string")
    fit = features.fit_categories(df, ["c"])
    names = {r.feature for r in fit.long(df, "id").collect()}
    assert names == {"cat__c_x", "cat__c___null__", "cat__c___infrequent__"}
    new = rows([(1, "x"), (2, "unseen"), (3, "y"), (4, None)], "id int, c string")
    assert {r.id for r in fit.long(new, "id").collect()} == {1, 3, 4}
    dense = {r.id: list(r.v) for r in fit.transform(new, "f").select("id", vector_to_array("f").alias("v")).collect()}
    assert dense[2] == [0.0] * 3 and sum(dense[1]) == 1.0 and dense[1] != dense[3] != dense[4]


def test_assemble(rows):
    df = rows([(1, [1.0, 2.0], [0.0, 3.0])], "id int, a array<double>, b array<double>").withColumn("s", array_to_vector("b"))
    got = features.assemble(df, [("a", 2.0), ("s", 0.5)]).select(vector_to_array("features").alias("f")).first().f
    assert got == [2.0, 4.0, 0.0, 1.5]
    with pytest.raises(ValueError):
        features.assemble(df, [])
    with pytest.raises(ValueError):
        features.weighted_long([(None, 1.0)])


def test_tfidf(rows, tmp_path):
    docs = ["red ring red", "red box", "red ring", "a b c", "", "ring box ring box"]
    df = rows(list(enumerate(docs)), "id int, text string")
    counts = tfidf.term_counts(df, "id", "text")
    fit = tfidf.fit_tfidf(counts, len(docs), min_df=2, max_features=4)
    # Six terms are in two documents or more... the four most frequent stay, ties by term.
    assert fit.terms() == ["box", "red", "red ring", "ring"]
    idf = {r.term: r.idf for r in fit.vocabulary.collect()}
    assert idf["red"] == pytest.approx(np.log(7 / 4) + 1)
    long = {(r.id, r.term): r.weight for r in fit.long(counts, "id").collect()}
    assert sum(w * w for (i, _), w in long.items() if i == 0) == pytest.approx(1.0)
    assert not [k for k in long if k[0] in (3, 4)]
    model = fit.model()
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(tfidf.with_ngrams(df, "text"))
    terms = fit.terms()
    for r in again.select("id", vector_to_array("txt_features").alias("v")).collect():
        assert r.v == pytest.approx([long.get((r.id, t), 0.0) for t in terms])


def test_min_df_is_count_or_share():
    assert tfidf.document_threshold(3, 100) == 3 and tfidf.document_threshold(0.025, 100) == 3
    for bad in (5.0, -1, True):
        with pytest.raises(ValueError):
            tfidf.document_threshold(bad, 100)


def test_encode_text(rows):
    df = rows([(1, "ab"), (2, None), (3, "abcd")], "id int, t string")
    encoder = lambda texts: [[len(t), 1.0] for t in texts]
    got = features.encode_text(df, "t", encoder, batch=2).orderBy("id").collect()
    assert [r.embedding for r in got] == [[2.0, 1.0], [0.0, 1.0], [4.0, 1.0]]


def test_feature_dictionary(rows):
    df = rows([(i, "x" if i < 6 else "r", 1.0 * i) for i in range(8)], "id int, c string, n double")
    numbers, categories = features.fit_numeric(df, ["n"]), features.fit_categories(df, ["c"])
    terms = rows([(0, "t0"), (1, "t1")], "position int, term string")
    got = features.feature_dictionary(numbers.feature_names, categories, terms, df).orderBy("position").collect()
    assert [r.feature for r in got] == ["num__n", "cat__c_x", "cat__c___infrequent__", "txt__t0", "txt__t1"]


def test_nonfinite_entries_of_sparse_and_dense_rows(spark):
    """Only stored entries count; null vectors and rows without any are left out."""
    bad, inf = float("nan"), float("inf")
    data = [(1, Vectors.sparse(1_000_000, {5: 1.0, 7: bad, 999_999: -inf})), (2, Vectors.dense([0.0, inf])), (3, Vectors.sparse(9, {})), (4, None), (5, Vectors.dense([1.0]))]
    df = spark.createDataFrame(data, T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT())]))
    got = {(r.id, r.position): str(r.value) for r in nonfinite_entries(df, "id").collect()}
    assert got == {(1, 7): "nan", (1, 999_999): "-inf", (2, 1): "inf"}


@pytest.mark.parametrize("id_type", ["int", "string"])
@pytest.mark.parametrize("limit", [None, 5])
def test_grouped_counts_give_the_same_weights(rows, monkeypatch, id_type, limit):
    monkeypatch.setattr(tfidf, "TASK_BYTES", 30, raising=False)
    texts = ["a Élan élan snake_case x", "elan vital, elan vital", None, "", "one two one two one", "ab c abc ab", "ab abc 12 ３４ ab", "Straße straße élan vital"]
    docs = [(i if id_type == "int" else f"k{i}", text) for i, text in enumerate(texts * 4)]
    docs += [(docs[0][0], "snake_case again"), (None, "one two"), (None, "two one"), (docs[3][0], "vital one")]
    df = rows(docs, f"id {id_type}, text string")
    by_row, grouped = tfidf.term_counts(df, "id", "text"), tfidf.term_counts(df, "id", "text", grouped=True)
    fits = [tfidf.fit_tfidf(c, 33, min_df=3, max_features=limit) for c in (by_row, grouped)]
    tables = [[tuple(r) for r in f.vocabulary.orderBy("position").collect()] for f in fits]
    assert tables[0] == tables[1] and len(tables[0]) == (limit or len(tables[0])) > 4
    shares = grouped.split()
    assert len(shares) == 2
    weighed = [fits[0].long(by_row, "id"), fits[1].long(grouped, "id"), reduce(DataFrame.union, [fits[1].long(s, "id") for s in shares])]
    assert all(w.columns == ["id", "term", "position", "weight"] for w in weighed)
    found = [sorted(((r.id, r.term, r.position, round(r.weight, 9)) for r in w.collect()), key=str) for w in weighed]
    assert found[0] and found[0] == found[1] == found[2]
    assert fits[1].long(grouped, "id", terms=False).columns == ["id", "position", "weight"]
    with pytest.raises(ValueError):
        fits[1].long(tfidf.term_counts(df, "id", "text", grouped=True), "id")


def test_grouped_counts_of_nothing(rows):
    grouped = tfidf.term_counts(rows([], "id long, text string"), "id", "text", grouped=True)
    fit = tfidf.fit_tfidf(grouped, 0)
    assert fit.vocabulary.count() == 0 and fit.long(grouped, "id").count() == 0


def test_grouped_pairs_too_many_for_one_number(monkeypatch):
    texts = pa.table({"id": ["a", "b", "a"], "__words": pa.array([["x1", "x2", "x1", "x2"], None, ["x1"]], pa.list_(pa.string()))})
    small = grouped_counts.count_terms(texts, "id")
    monkeypatch.setattr(grouped_counts, "ONE_NUMBER", 0)
    large = grouped_counts.count_terms(texts, "id")
    for got in (small, large):
        named = [(t, got.ids[int(r)].as_py(), int(n)) for t, r, n in zip(got.terms(got.term).to_pylist(), got.row, got.tf)]
        assert named == [("x1", "a", 3), ("x1 x2", "a", 2), ("x2", "a", 2), ("x2 x1", "a", 1)]


@given(st.lists(st.integers(-(2**40), 2**40)) | st.lists(st.integers(0, 2**32 - 1)) | st.lists(st.integers(0, 300)))
@settings(max_examples=60, deadline=None)
def test_squeezed_numbers_come_back(values):
    assert grouped_counts.stretch(grouped_counts.squeeze(np.array(values, np.int64))).tolist() == values
