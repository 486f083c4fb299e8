import json
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog_spark import spec
from catalog_spark.operators import fitted
from catalog_spark.plans import clustering, collection, listing
from catalog_spark.sources.files import read_csv_typed
from catalog_spark.streaming.centroids import read_state, track_centroids
from catalog_spark.streaming.ingest import ingest_new, keyed_documents


def paths(tmp_path):
    return collection.CollectionPaths(*[str(tmp_path / n) for n in ("stores", "products", "store_table", "product_table")])


def test_collection(spark, rows, tmp_path):
    p = paths(tmp_path)
    near = lambda *stores: json.dumps({"data": {"nearby_stores": {"stores": list(stores)}}})
    payloads = rows(
        [
            ("1", "t1", near({"store_id": 1, "name": "a", "_discovery_zip": "old"}, {"store_id": None})),
            ("2", "t2", near({"store_id": "1"}, {"store_id": 2, "x": {"y": [1, None]}})),
            ("3", "t3", "{}"),
        ],
        "zip_code string, discovered_at string, line string",
    )
    assert {r[0]: r[1] for r in collection.collect_stores(spark, payloads, p).collect()} == {"1": 1, "2": 1}
    assert collection.collect_stores(spark, payloads, p).count() == 0
    assert collection.stored_store_ids(spark, p.stores).count() == 2

    items = rows([("1", "c1", '{"r":[{"tcin":"10"},{"tcin":11},{"tcin":"12"}]}')], "store_id string, category_id string, line string")
    listed = collection.listed_items(items, max_per_category=2)
    assert sorted(r.tcin for r in listed.collect()) == ["10", "11"]
    fetched = rows(
        [("1", "10", "t", '{"data":{"product":{"tcin":"10","price":{"current_retail_min":5}}}}'), ("1", "10", "u", "{}"), ("1", "13", "t", "{bad")],
        "store_id string, tcin string, fetched_at string, line string",
    )
    assert [tuple(r) for r in collection.collect_products(spark, fetched, p).collect()] == [("1", 1)]
    assert collection.collect_products(spark, fetched, p).count() == 0
    assert [r.tcin for r in collection.open_items(listed, spark, p.products).collect()] == ["11"]

    collection.export_tables(spark, p)
    products = read_csv_typed(spark, p.product_table, string_columns=["_tcin"])
    assert products.first().asDict() == {"_fetched_at": "t", "_store_id": 1, "_tcin": "10", "data-product-price-current_retail_min": 5, "data-product-tcin": 10}
    stores = read_csv_typed(spark, p.store_table)
    assert {"_discovery_zip", "_discovered_at", "name", "store_id", "x-y"} == set(stores.columns)
    assert sorted(r._discovery_zip for r in stores.collect()) == [1, 2]


def test_open_pages(rows):
    cats = rows([("a", "/x"), ("", "/y")], "data_id string, url_path string")
    assert collection.open_pages(rows([("1",), ("2",)], "store_id string"), cats, 24, 1199).count() == 2 * 50


def test_listing_job(spark, rows, tmp_path):
    page = '<div class="panel-prefixes"><ul class="list-group"><li class="list-group-item"><div class="row"><i class="prefix-col1">55401</i></div></li></ul></div>'
    out = str(tmp_path / "zips")
    listing.listing_job(rows([(1, page)], "page_id int, html string"), out)
    assert collection.load_zip_codes(spark, out).first()["ZIP Code"] == "55401"
    with pytest.raises(ValueError):
        listing.listing_job(rows([(1, "<p>")], "page_id int, html string"))


def product_table(rows, n=90):
    """Three kinds of products that differ in price, brand and words."""
    rng = np.random.default_rng(1)
    kinds = [("Toys", "Fun", "plastic ring game", 10.0), ("Home", "Cosy", "cotton towel soft", 60.0), ("Food", "Yum", "sweet apple box", 300.0)]
    data = []
    for i in range(n):
        name, brand, words, price = kinds[i % 3]
        crumbs = json.dumps([{"name": "All"}, {"name": name}])
        kids = json.dumps([{"price": {"current_retail": price}, "item": {"handling": {"import_designation_description": "Imported"}}}]) if i % 2 else None
        data.append((str(i % 4), str(i), name, brand, words, None if i % 5 == 0 else f"{price + rng.normal():.2f}", "Made in the USA" if i % 2 else "Imported", crumbs, kids, "1", "2", None if i == 3 else "3"))
    names = ["_store_id", "data-product-tcin", spec.CATEGORY_NAME, spec.CATEGORICAL_COLUMNS[1], spec.TEXT_COLUMNS[0], spec.MAX_PRICE_CHAIN[0],
             spec.ORIGIN_COLUMNS[0], spec.BREADCRUMBS, spec.CHILDREN, *spec.DIMENSIONS]
    return rows(data, ", ".join(f"`{c}` string" for c in names))


def test_clustering_job(spark, rows, tmp_path):
    options = clustering.ClusterOptions(auto_k=(2, 4), sweep_restarts=1, final_restarts=2, projection=True, svd_dimensions=4)
    result = clustering.cluster_products(product_table(rows), options)
    assert result.k in (2, 3, 4) and result.metrics.count() == 3
    found = result.enriched.collect()
    assert len(found) == 90
    for c in range(result.k):
        names = [r[spec.CATEGORY_NAME] for r in found if r.cluster_id == c]
        assert {r.cluster_label for r in found if r.cluster_id == c} == {min(names, key=lambda n: (-names.count(n), n))}
    sizes = {c: sum(r.cluster_id == c for r in found) for c in range(result.k)}
    assert all((r.nn3_id is not None) == (sizes[r.cluster_id] > 3) for r in found)
    assert all(r.nn1_id != r["data-product-tcin"] and r.proj_x is not None for r in found)
    assert {r.category_path for r in found} == {"All > Toys", "All > Home", "All > Food"}
    assert {r.tariff_risk for r in found} == {0, 1} and all(r.price_band for r in found if r[spec.MAX_PRICE_CHAIN[0]] is not None)
    out = str(tmp_path / "out")
    clustering.write_outputs(result, out, str(tmp_path / "metrics"), str(tmp_path / "summary"))
    back = read_csv_typed(spark, out)
    assert back.columns[0] == "cluster_id" and back.count() == 90 and "nn3_dist" in back.columns
    table = read_csv_typed(spark, str(tmp_path / "summary"))
    assert sum(r.n for r in table.collect()) == 90 and table.count() == result.k and table.columns[:3] == ["cluster_id", "n", "label"]
    assert result.dictionary.where("block = 'txt'").count() == 4
    assert result.matrix_audit.count() == 0 and result.inf_profile.count() == 0
    assert result.null_profile.where(F.col("column_name") == spec.VOLUME).first().n_null == 1


def test_clustering_job_variants(rows):
    options = clustering.ClusterOptions(k=3, minibatch=True, sample=60, neighbors=1, text_mode="encoder", distinct_item=True)
    encoder = lambda texts: [[t.count("plastic") * 9.0, t.count("cotton") * 9.0] for t in texts]
    result = clustering.cluster_products(product_table(rows), options, encoder)
    assert result.dictionary.where("feature = 'txt__embed_1'").count() == 1
    assert result.enriched.count() == 60 and result.metrics is None and "nn2_id" not in result.enriched.columns
    with pytest.raises(ValueError):
        clustering.cluster_products(product_table(rows), clustering.ClusterOptions(k=1))


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_stream_ingest_restarts(spark, tmp_path):
    source, sink, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: ingest_new(spark, str(source), sink, checkpoint).awaitTermination()
    doc = lambda s, t: json.dumps({"_store_id": s, "data": {"product": {"tcin": t}}})
    drop(source, "a.jsonl", [doc("1", "10"), doc("1", "10"), "{bad", "", doc("1", "11"), "{}"])
    run()
    drop(source, "b.jsonl", [doc("1", "11"), doc("2", "10")])
    run()
    run()
    stored = spark.read.parquet(sink)
    assert sorted((r.store_id, r.tcin) for r in stored.collect()) == [("1", "10"), ("1", "11"), ("2", "10")]


def test_keyed_documents_parse_a_line_once(rows):
    docs = ['{"_store_id": "1", "_tcin": "", "data": {"product": {"tcin": 7}}}', ' {"store_id": 2, "tcin": " x "} ', '{"_store_id": "1", "_tcin": 0}', '{"_store_id": NaN, "store_id": "3", "tcin": "4"}', "{bad", ""]
    found = keyed_documents(rows([(d,) for d in docs], "value string"))
    assert [(r.store_id, r.tcin) for r in found.collect()] == [("1", "7"), ("2", "x"), ("3", "4")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") <= 3  # a line, and twice those with a bare NaN


def test_stream_ingest_with_watermark(spark, tmp_path):
    source = tmp_path / "in"
    drop(source, "a.jsonl", [json.dumps({"_store_id": "1", "_tcin": "5", "_fetched_at": f"2024-01-01T00:00:0{i}"}) for i in range(3)])
    ingest_new(spark, str(source), str(tmp_path / "out"), str(tmp_path / "cp"), watermark="1 hour").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_stream_centroids(spark, rows, tmp_path):
    rng = np.random.default_rng(2)
    points = [(i, [float(v) for v in (np.array([0, 0]) if i % 2 else np.array([50, 50])) + rng.normal(size=2)]) for i in range(200)]
    df = rows(points, "id long, v array<double>")
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    run = lambda: track_centroids(spark, source, df.schema, state, str(tmp_path / "cp"), 2, "id", "v", max_files=1).awaitTermination()
    df.where("id < 100").coalesce(1).write.parquet(source)
    run()
    df.where("id >= 100").coalesce(1).write.mode("append").parquet(source)
    run()
    centers, weights = read_state(spark, state)
    assert weights.sum() == 200
    whole = np.array([v for _, v in points])
    assert (centers * weights[:, None]).sum(0) / 200 == pytest.approx(whole.mean(0))


def test_stream_centroids_of_poor_batches(spark, tmp_path):
    """Empty and unusable batches, fewer different rows than centres, and a replayed batch."""
    schema = "id long, v array<double>"
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    batches = [[], [(1, None), (2, [float("nan"), 1.0]), (3, [1.0, None])], [(4, [0.0, 0.0]), (5, [0.0, 0.0])], [], [(6, [9.0, 9.0]), (7, None)], [(8, [9.0, 7.0])]]
    sizes = []
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        track_centroids(spark, source, spark.createDataFrame([], schema).schema, state, str(tmp_path / "cp"), 2, "id", "v").awaitTermination()
        sizes.append(len(read_state(spark, state)[0]))
    centers, weights = read_state(spark, state)
    assert sizes == [0, 0, 1, 1, 2, 2]
    assert centers.tolist() == [[0.0, 0.0], [9.0, 8.0]] and weights.tolist() == [2.0, 2.0]


def test_kept_model_scores_other_rows(spark, tmp_path):
    """Applied to the rows it was fitted on, a model read back gives the job's clusters; odd rows get a cluster as well."""
    raw = product_table(lambda values, schema: spark.createDataFrame(values, schema))
    result = clustering.cluster_products(raw, clustering.ClusterOptions(k=3, final_restarts=2, svd_dimensions=4, neighbors=0))
    path = str(tmp_path / "model")
    assert fitted.versions(spark, path) == []
    with pytest.raises(ValueError, match="no complete version"):
        fitted.load(spark, path)
    assert fitted.save(result.model, path, spark) == 1
    model = fitted.load(spark, path)
    assert model.svd is not None and model.numeric == result.model.numeric and model.svd.components == pytest.approx(result.model.svd.components)
    key = spec.item_id(raw)
    placed = clustering.score_products(model, raw)
    want = Counter((r[0], r.cluster_id) for r in result.enriched.select(key, "cluster_id").collect())
    assert Counter((r[0], r.cluster_id) for r in placed.select(key, "cluster_id").collect()) == want
    # a later save that was cut off before its settings were written does not count
    (tmp_path / "model" / "version=2").mkdir()
    assert fitted.versions(spark, path) == [1]
    assert fitted.save(replace(result.model, centers=None), path, spark) == 2 and fitted.versions(spark, path) == [1, 2]
    with pytest.raises(ValueError, match="no centres"):
        fitted.load(spark, path).score(raw, "row_id")
    # nothing but an id: every column counts as null; repeated ids stay rows of their own; no rows give no rows
    bare = spark.createDataFrame([(1,), (1,), (None,)], "row_id long")
    old = fitted.load(spark, path, 1)
    got = old.score(bare, "row_id").collect()
    assert [r.row_id for r in got].count(1) == 2 and len(got) == 3 and len({r.cluster_dist for r in got}) == 1
    assert old.score(bare.limit(0), "row_id").count() == 0
