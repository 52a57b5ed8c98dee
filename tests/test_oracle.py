"""Every SQL-checked query equals its DuckDB oracle (row count, columns,
order-insensitive value hash), on the smallest driver tables."""

import pytest

from tavolo.plans.check import compare, duck
from tavolo.plans.oracle import ORACLE
from tavolo.plans.registry import QUERIES

SF_SMALL = "/root/testdata/sf0.001"

NAMES = sorted(n for n in QUERIES if n in ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE[name], con)
    assert r["status"] == "match", r


def test_every_query_has_a_check():
    rows_only = {"spam_classifier_report", "spam_scores", "spam_topics", "topic_distances",
                 "forest_report", "forest_importances", "selected_features", "spam_scores_stream"}
    assert set(QUERIES) - set(ORACLE) == rows_only
