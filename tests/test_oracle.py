"""Every registered query against its oracle SQL."""

import pytest
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, data, name):
    result = queries()[name](spark, data)
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert compare(spark, con, data, lambda *_: result, ORACLES[name]) is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(queries())


def test_entry(spark, data):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted({"kmeans_assign", "minibatch_kmeans_assign", "stream_minibatch_centroids"}))
def test_fits_use_every_row(spark, data, name):
    n = spark.read.parquet(f"{data}/embeddings.parquet").count()
    found = queries()[name](spark, data)
    assert found.count() == n
    assert 2 <= found.select("cluster_id").distinct().count() <= 10
