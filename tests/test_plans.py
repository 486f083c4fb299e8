"""Shapes of physical plans."""

import re
from pathlib import Path

import pytest
from oracle_check import compare, duck
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from catalog_spark.operators import relate, tfidf
from catalog_spark.session import work_folder


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_limits_before_the_shuffle(rows):
    df = rows([(1, 2)], "k int, v int")
    text = plan(relate.first_per_key(df, ["k"], [F.col("v")], 3))
    assert re.search(r"WindowGroupLimit.*Partial", text) and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_worklist_is_an_equi_join(rows):
    text = plan(relate.worklist(rows([(1,)], "s int"), rows([("c",)], "c string")))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_text_is_evaluated_once_before_explode(rows):
    text = plan(tfidf.term_counts(rows([(1, "a")], "id int, t string"), "id", "t"))
    assert text.count("regexp_extract_all") == 1 and text.count("Exchange") == 1


@pytest.mark.parametrize("name", ["price_band", "children_rollup", "html_listing_extract", "tariff_risk", "iso_timestamp", "numeric_coerce"])
def test_row_work_needs_no_shuffle(spark, data, name):
    text = plan(queries()[name](spark, data))
    assert not re.search(r"Exchange hashpartitioning\((?!o_orderkey)", text)


def test_scans_read_only_the_columns_in_use(spark, data):
    text = plan(queries()["top_offenders"](spark, data))
    assert "ReadSchema: struct<user_id:bigint>" in text


def test_large_vocabulary_is_not_broadcast(spark, data, monkeypatch):
    monkeypatch.setattr(tfidf, "BROADCAST_ROWS", 10, raising=False)
    found = queries()["tfidf_weights"](spark, data)
    assert "Broadcast" not in plan(found)
    assert compare(spark, duck(data), data, lambda *_: found, oracle_sql()["tfidf_weights"]) is None


def test_tasks_that_count_terms_grow_with_the_texts(rows, monkeypatch):
    monkeypatch.setattr(tfidf, "TASK_BYTES", 1_000, raising=False)
    docs = rows([(i, "some words " * 20) for i in range(200)], "id int, t string")
    counts = tfidf.term_counts(docs, "id", "t")
    assert counts.rdd.getNumPartitions() == 44 and counts.count() == 200 * 4
    assert tfidf.term_counts(docs, "id", "t", 90_000).rdd.getNumPartitions() == 90


def test_tfidf_weights_neither_writes_nor_shuffles_a_row_for_each_term_of_a_text(spark, data, monkeypatch):
    monkeypatch.setattr(tfidf, "TASK_BYTES", 20_000, raising=False)  # more groups than cores, so in shares
    folder = Path(work_folder(spark).removeprefix("file:")).parent
    before = set(folder.glob("*"))
    found = queries()["tfidf_weights"](spark, data)
    written = {p.name.split("-")[0]: spark.read.parquet(str(p)).count() for p in set(folder.glob("*")) - before}
    counts = tfidf.term_counts(spark.read.parquet(f"{data}/documents.parquet"), "doc_id", "text").count()
    assert written and max(written.values()) < counts / 2, (written, counts)
    assert "hashpartitioning(term" not in plan(found)
    assert compare(spark, duck(data), data, lambda *_: found, oracle_sql()["tfidf_weights"]) is None
