"""Every registered query with a SQL twin gives the twin's result."""

import functools

import pytest

import __spark_entry__ as entry
from peerlight.registry import QUERIES, queries
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"
# Full training runs; covered by the model and batch tests on smaller settings.
SLOW = {
    "candidate_metrics",
    "train_and_score",
    "gbt_classifier_scores",
    "random_forest_scores",
    "logistic_regression_scores",
    "saved_model_scores",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="module", autouse=True)
def shared_stages():
    """Let all queries of this module share one set of stages, so each is computed once."""
    patch = pytest.MonkeyPatch()
    patch.setattr(queries, "Tables", functools.cache(queries.Tables))
    yield
    patch.undo()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, name):
    assert difference(spark, duck, name, SMALL) is None


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 25
