"""Every registered query with a SQL check agrees with DuckDB on whole tables."""

import os

import oracle
import pytest

from scorelake.plans import catalog, load_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
load_queries()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_names_match():
    assert set(catalog.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_agrees(spark, con, name):
    difference = oracle.diff(catalog.QUERIES[name](spark, SF), con, catalog.SQL[name])
    assert difference is None


FITTED = [
    "a2_content_version", "e5_group_components", "e8_feature_elimination", "f2_entropy_edges", "g5_batch_probability",
    "j2_cbpe_calibrated", "j8_drift_summary", "j9_multivariate_drift", "j13_monitor_run",
]


@pytest.mark.parametrize("name", FITTED)
def test_fitted_queries_give_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
