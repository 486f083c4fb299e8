import json
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from catalog_spark.operators import embedded, flatten
from catalog_spark.session import work_folder
from catalog_spark.sources import files, listing, sinks

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def flat(rows, docs, **options):
    df = rows([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "doc string")
    return flatten.flatten_json(df, "doc", **options)


def test_flatten_example(rows):
    got = flat(rows, [{"a": {"b": 1}, "c": [2, 3]}])
    assert got.columns == ["a-b", "c"] and tuple(got.first()) == (1, "[2,3]")


def test_flatten_edges(rows):
    got = flat(rows, [{"x y\t z": 1, "n": None, "e": {}, "d": {"e": {}}, "f": 1.5, "t": True}, {"f": 2, "l": [{"b": None, "a": 1}]}, "{bad", "{}"])
    assert sorted(got.columns) == ["f", "l", "n", "t", "x_y_z"]
    values = {(r.f, r.l, r.n, r.t, r.x_y_z) for r in got.collect()}
    assert values == {(1.5, None, None, True, 1), (2.0, '[{"b":null,"a":1}]', None, None, None), (None,) * 5}


def test_flatten_collision_last_key_wins(rows):
    docs = ['{"a":{"b":2},"a.b":1}', '{"a.b":1,"a":{"b":2}}', '{"a":{"b":3}}', '{"a.b":4,"a":{"b":null}}', '{"a":{"b":null},"a.b":5}', '{"a.b":6,"a":{}}', '{"a":8}']
    got = flat(rows, docs)
    assert got.columns == ["a", "a-b"] and [r["a-b"] for r in got.collect()] == [1, 2, 3, None, 5, 6, None]


def test_flatten_collision_of_types_and_three_paths(rows):
    docs = ['{"x":{"y":{"z":1}},"x.y":{"z":"s"},"x.y.z":2.5}', '{"x.y.z":2.5,"x.y":{"z":"s"},"x":{"y":{"z":1}}}', '{"x":{"y":{"z":1}},"x.y.z":2.5,"x.y":{"z":"s"}}']
    assert [tuple(r) for r in flat(rows, docs).collect()] == [("2.5",), ("1",), ("s",)]


def test_flatten_keys_that_differ_in_case(rows):
    docs = ['{"Ab":1,"k":{"Q":[1, 2]}}', '{"ab":2,"k":{"q":"t"}}', '{"Ab":3,"ab":4,"K":{"q":true}}']
    got = flat(rows, docs)
    assert got.columns == ["Ab", "K-q", "ab__2", "k-Q__2", "k-q__3"]
    assert [tuple(r) for r in got.collect()] == [(1, None, None, "[1,2]", None), (None, None, 2, None, "t"), (3, True, 4, None, None)]


def test_flatten_scalar_object_conflict(rows):
    got = flat(rows, [{"a": 1, "k": 1}, {"a": {"b": 2}, "k": 2}, {"a": "s", "k": 3}, {"a": [1, {"z": None}], "k": 4}])
    found = {r.k: (r.a, r["a-b"]) for r in got.collect()}
    assert found == {1: ("1", None), 2: (None, 2), 3: ("s", None), 4: ('[1,{"z":null}]', None)}


def test_flatten_documents_that_are_no_objects(rows):
    got = flat(rows, [{"a": 1}, "[1, 2]", "5"])
    assert {(r.a, r["list"], r["value"]) for r in got.collect()} == {(1, None, None), (None, "[1,2]", None), (None, None, "5")}


def test_flatten_limits(rows):
    assert flat(rows, [{"a": 1, "b": {"c": 2}}], keep=["b-c"]).columns == ["b-c"]
    with pytest.raises(ValueError):
        flat(rows, [{"a": 1, "b": 2}], max_columns=1)


def test_flatten_struct(spark):
    df = spark.sql("SELECT named_struct('b c', 1, 'd.e', array(named_struct('x', cast(null as int)))) AS a, 2 AS z")
    got = flatten.flatten_struct(df)
    assert got.columns == ["a-b_c", "a-d-e", "z"] and tuple(got.first()) == (1, '[{"x":null}]', 2)


leaf = st.one_of(st.integers(-9, 9), st.text("ab", min_size=1, max_size=3), st.booleans(), st.lists(st.integers(0, 9), max_size=2))
tree = st.dictionaries(st.text("pqr", min_size=1, max_size=2), st.recursive(leaf, lambda c: st.dictionaries(st.text("pqr", min_size=1, max_size=2), c, max_size=3), max_leaves=5), max_size=4)


def leaves_of(doc):
    return sum(leaves_of(v) if isinstance(v, dict) else 1 for v in doc.values())


@SLOW
@given(st.lists(tree, min_size=1, max_size=4))
def test_flatten_keeps_every_leaf(spark, docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    got = flatten.flatten_json(df, "doc")
    kept = 0 if not got.columns else sum(sum(v is not None for v in r) for r in got.collect())
    assert kept == sum(leaves_of(d) for d in docs)


def test_key_values(rows):
    docs = ['{"tcin": "1", "a": [{"tcin": 2}, {"b": {"tcin": {"tcin": "3"}}}], "c": {"tcin": "1", "x": "\\"tcin\\": 9"}}', '{"tcin": null}', '{"tcin": [{"tcin": "4"}]}', "[oops"]
    df = rows([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    got = {(r.i, r.value) for r in flatten.key_values(df, "doc", "tcin", ["i"]).collect()}
    assert got == {(0, "1"), (0, "2"), (0, "3"), (2, "4")}


def test_key_values_reads_text_in_the_jvm(rows):
    docs = ['{"tcin":"a\\"b"}', '{"tc\\u0069n":"u"}', '[{"tcin":-5},{"tcin":1.5},{"tcin":true}]', '["tcin","x"]', '{"a":"\\\\","tcin":"é"}', '"tcin"', '{"tcinx":1,"xtcin":2}', json.dumps({"long": 'q"\n' * 50_000, "tcin": "end"}), None]
    df = rows([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    found = flatten.key_values(df, "doc", "tcin", ["i"])
    assert sorted(tuple(r) for r in found.collect()) == [(0, 'a"b'), (1, "u"), (2, "-5"), (2, "True"), (4, "é"), (7, "end")]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_key_values_of_copied_texts(spark, rows):
    docs = ['{"tcin" : 1, "a":"\\\\"}', '{"tcin":1.0}', '{"tcin":-0}', '{"tcin":12345678901234567890.0}', '{"tcin":1,"tcin":2}', '{"a":{"tcin":1},"a":3}', '{"tcin":"1"}{"tcin":"2"}',
            '{"a":"x\\"tcin\\":7","x\\"tcin":8,"b":["tcin",{"tcin":"\\"tcin\\":5"}]}', '{"tc\\u0069n":"u"}', '{"tcin":tru}', '{"tcin":[{"tcin":"é\\n"},{"tcin":"é\\n"}]}']
    df = rows([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        found = flatten.key_values(df, "doc", "tcin", ["i"])
        got = sorted(tuple(r) for r in found.collect())
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    whole = [(0, "1"), (1, "1"), (2, "0"), (3, "12345678901234567890"), (6, "1"), (7, '"tcin":5'), (8, "u"), (10, "é\n")]
    assert got == whole
    assert sorted(tuple(r) for r in flatten.key_values(df, "doc", "tcin", ["i"]).collect()) == sorted([*whole, (4, "2")])
    assert "get_json_object" in plan and plan.count("regexp_extract_all") == 1 and "Filter (Contains" not in plan


def test_first_filled(rows):
    docs = ['{"a": " x ", "b": "y"}', '{"a": "", "b": 7}', '{"a": 0, "b": false, "c": {"d": "z"}}', '{"a": "0"}', "{}", '{"a": 0.0, "b": []}']
    df = rows([(i, d) for i, d in enumerate(docs)], "i int, doc string").withColumn("v", F.try_parse_json("doc"))
    got = df.select("i", flatten.first_filled(F.col("v"), [("a",), ("b",), ("c", "d")]).alias("k")).orderBy("i").collect()
    assert [r.k for r in got] == ["x", "7", "z", "0", "", ""]


def test_explode_path_tolerates_missing(rows):
    df = rows([(1, '{"data":{"s":[{"id":1},{"id":2}]}}'), (2, "{}"), (3, '{"data":{"s":5}}'), (4, "bad")], "k int, doc string")
    got = flatten.explode_path(df, "doc", ("data", "s"), "struct<id:string>", ["k"]).collect()
    assert [(r.k, r.item.id) for r in got] == [(1, "1"), (1, "2")]


def test_add_and_replace_fields(rows):
    df = rows([('{"a":1,"b":[1, 2]}',), ("{}",)], "doc string")
    kept = [json.loads(r[0]) for r in df.select(flatten.add_fields(F.col("doc"), {"a": F.lit("new"), "z": F.lit('q"t')})).collect()]
    assert kept == [{"a": 1, "b": [1, 2], "z": 'q"t'}, {"a": "new", "z": 'q"t'}]
    replaced = [json.loads(r[0]) for r in df.select(flatten.replace_fields(F.col("doc"), {"a": F.lit("new")})).collect()]
    assert replaced == [{"a": "new", "b": [1, 2]}, {"a": "new"}]


def test_parse_embedded(rows):
    values = ["", "[1,2]", "{'n': None}", "[oops", "plain", None, "  ", ' {"a": 1} ']
    df = rows([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = df.select("i", F.to_json(embedded.parse_embedded(F.col("x"))).alias("j")).orderBy("i").collect()
    assert [r.j for r in got] == [None, "[1,2]", '{"n":null}', '"[oops"', '"plain"', None, None, '{"a":1}']


def test_detect_json_columns(rows):
    df = rows([("x", " [1", None), ("{", "y", None)], "a string, b string, c string")
    assert {r.column_name: r.is_json for r in embedded.detect_json_columns(df).collect()} == {"a": True, "b": True, "c": False}


def test_known_shapes(rows):
    crumbs = ['[{"name":"A"},{"name":""},{"x":1},{"name":"B"}]', "[]", "{}", None]
    averages = ['[{"id":"value","value":2.5},5,{"id":"quality","value":4},{"id":"quality","value":1}]', "[]", None, "oops"]
    child = lambda **k: {"item": {"primary_brand": {"name": k.get("brand")}, "product_description": {"bullet_descriptions": k.get("bullets")}}, "price": k.get("price")}
    kids = [
        json.dumps([
            child(brand="b", price={"current_retail": 3, "reg_retail": 9}, bullets=["x", "Package Quantity: 4", "package quantity:5"]),
            child(brand="a", price={"current_retail": "n/a", "reg_retail": 1}),
            child(brand="", price={"reg_retail": "7.5"}),
            child(price=None, bullets=[]),
        ]),
        "[]", None, "{'not': 'a list'}",
    ]
    names = ["data-product-category-breadcrumbs", "data-product-ratings_and_reviews-statistics-secondary_averages", "data-product-children"]
    df = rows([(i, *v) for i, v in enumerate(zip(crumbs, averages, kids))], "i int, " + ", ".join(f"`{n}` string" for n in names))
    got = embedded.derive_from_json(df).orderBy("i").collect()
    assert [r.category_path for r in got] == ["A > B", "", None, None]
    assert [(r.rating_quality, r.rating_value) for r in got][0] == (4.0, 2.5)
    first = got[0]
    assert (first.children_price_min, first.children_price_max, first.children_brand_mode, first.children_pkg_qty_mode) == (3.0, 7.5, "a", 4)
    assert all(r.children_price_min is None and r.children_brand_mode is None for r in got[1:])


def test_jsonl_scan(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a":1}\n\n  {"a":2}  \n{bad\n')
    assert files.read_jsonl(spark, str(tmp_path)).count() == 2
    assert files.read_jsonl(spark, str(tmp_path), keep_malformed=True).where("status = 'malformed'").count() == 1
    assert files.read_jsonl(spark, str(tmp_path / "absent")).count() == 0


def test_csv_types_and_quoting(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,n,d,b,t\n001,1,1.5,True,"a ""q"", b\nc"\n002,,n/a,False,NA\n')
    df = files.read_csv_typed(spark, str(tmp_path), string_columns=["id"])
    assert dict(df.dtypes) == {"id": "string", "n": "bigint", "d": "double", "b": "boolean", "t": "string"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("001", 1, 1.5, True, 'a "q", b\nc'), ("002", None, None, False, None)]


def test_empty_export_writes_nothing(spark, tmp_path):
    assert sinks.export_flat(spark, str(tmp_path / "none"), str(tmp_path / "out")) is None
    assert not (tmp_path / "out").exists()


def test_panel_reader(rows):
    item = '<li class="list-group-item"><div class="row"><span class="prefix-col1">{}</span><span class="prefix-col3"> a <b>b</b></span></div></li>'
    page = '<div class="panel-prefixes"><div class="panel-heading"><div class="row"><div class="prefix-col1">Z</div><div class="prefix-col2">T &amp; U</div><div class="prefix-col3">C</div></div></div><ul class="list-group">{}<li class="list-group-item">skip</li></ul></div>'
    bare = '<div class="panel-prefixes"><ul class="list-group">{}</ul></div>'
    df = rows([(1, page.format(item.format("55401"))), (2, bare.format(item.format("x") * 2)), (3, "<p>none</p>")], "page_id int, html string")
    got = [(r.page_id, r.pos, r.header, r.cells) for r in listing.panel_items(df).orderBy("page_id", "pos").collect()]
    assert got[0] == (1, 0, ["Z", "T & U", "C"], ["55401", "", "a b"])
    assert [g[:2] for g in got[1:]] == [(2, 0), (2, 1)] and got[1][2] == files.ZIP_HEADER and got[1][3] == ["x", "", "a b", "", ""]


def test_apostrophe_in_a_mixed_key(rows):
    df = rows([('{"it\'s": {"b": 1}}',), ('{"it\'s": "x"}',), ('{"it\'s": [1, null]}',)], "j string")
    got = flatten.flatten_json(df, "j")
    assert got.columns == ["it's", "it's-b"] and [tuple(r) for r in got.collect()] == [(None, 1), ("x", None), ("[1,null]", None)]


def test_bare_nan_is_null(rows):
    lines = rows([('{"a": NaN, "k": 1}',), ('{"a": [1, -Infinity], "s": "x: NaN, y"}',), ('{"a": NaN',), ('{"s": ": NaN, "}',)], "value string")
    got = [(r.line, r.status) for r in files.parse_lines(lines).collect()]
    assert got == [('{"a": null, "k": 1}', "ok"), ('{"a": [1, null], "s": "x: null, y"}', "ok"), ('{"a": NaN', "malformed"), ('{"s": ": NaN, "}', "ok")]


def test_texts_are_not_parsed_to_drop_none(rows):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    good = rows([('{"a":1,"b":{"c":"x"}}',), ('{"a":2}',)], "doc string")
    found = flatten.flatten_json(good, "doc")
    assert "parse_json" not in plan(found) and "parseJson" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, "x"), (2, None)]
    some = flatten.flatten_json(good.union(rows([("{bad",), (None,)], "doc string")), "doc")
    assert sorted(map(tuple, some.collect())) == [(1, "x"), (2, None)]


def test_export_parses_a_line_once(spark, tmp_path, monkeypatch):
    from catalog_spark.sources import sinks

    given, original = [], flatten.flatten_json
    monkeypatch.setattr(sinks, "flatten_json", lambda docs, text, **more: given.append((docs, more)) or original(docs, text, **more))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"a":1}\n{"a":NaN}\nbad\n\n{"b":"NaN"}\n')
    flat = sinks.export_flat(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert sorted(map(tuple, flat.collect()), key=str) == [(1, None), (None, "NaN"), (None, None)]
    (docs, more), = given
    assert more == {"variant": "doc"} and docs.where("doc IS NULL").count() == 1


def test_export_and_its_documents_are_small_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_ROWS", 50, raising=False)
    docs = spark.range(400).select(F.to_json(F.struct("id", F.lit("quoted \", and\nbroken ").alias("note"), F.repeat(F.lit("common words "), 20).alias("text"))).alias("doc"))
    sinks.append_documents(docs.coalesce(2), "doc", str(tmp_path / "in"), compression="gzip")
    flat = sinks.export_flat(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    written = {name: list((tmp_path / name).glob("part-*")) for name in ("in", "out")}
    assert len(written["in"]) == 8 and len(written["out"]) >= 8  # files are read by one task each, so their rows are bounded
    assert all(sum(p.stat().st_size for p in files_) < 400 * 260 / 5 for files_ in written.values())
    back = files.read_csv_typed(spark, str(tmp_path / "out"))
    assert back.count() == 400 and not back.exceptAll(flat).count() and not flat.exceptAll(back).count()
    sinks.export_flat(spark, str(tmp_path / "in"), str(tmp_path / "plain"), compression=None)
    assert all(p.suffix == ".csv" for p in (tmp_path / "plain").glob("part-*"))


def test_flat_export_query_writes_no_plain_text(spark, data, monkeypatch):
    from __spark_entry__ import queries
    from catalog_spark.queries import source_queries

    folders = []
    monkeypatch.setattr(source_queries, "work_folder", lambda s, label: folders.append(work_folder(s, label)) or folders[-1])
    assert queries()["flat_export"](spark, data).count() == spark.read.parquet(f"{data}/orders.parquet").count()
    parts = [p for folder in folders for p in Path(folder.removeprefix("file:")).glob("part-*")]
    assert len(folders) == 2 and len(parts) >= 2 and all(p.suffix == ".gz" for p in parts)
