"""Registered queries: same rows as their SQL twins, and a row count where there is none."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from tools.check_queries import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]).startswith("equal")


def test_stream_and_batch_score_every_line(spark):
    batch = QUERIES["score_batch"](spark, FOLDER).groupBy("band").count()
    stream = QUERIES["score_streamed"](spark, FOLDER).groupBy("band").count()
    assert sorted(batch.collect()) == sorted(stream.collect())


@pytest.mark.parametrize("name", ["refit_holdout", "mllib_holdout"])
def test_search_beats_the_majority_class(spark, name):
    row = QUERIES[name](spark, FOLDER).first()
    assert row.accuracy > 0.9 and row.f1_macro > 0.85
