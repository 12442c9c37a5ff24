"""Every registered query at the smallest scale, against its SQL where it has one."""

import pytest
from harness import compare, duck

from __spark_entry__ import entry
from salescope.plans.catalog import QUERIES, SQL

SLOW = {"rfe_cv", "rfe_fixed", "topn_refit", "step_size_sweep", "kmeans_elbow", "skew_aware_losses",
        "feature_toggle_ab", "tree_table", "gbt_early_stop"}


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), duck(sf), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
