"""The queries of single models ask for the whole forest and the whole boosting path."""

from types import SimpleNamespace

import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from salescope.operators import trees as T
from salescope.plans import models as M
from salescope.plans.catalog import QUERIES


class Asked(Exception):
    pass


def asked_for(spark, monkeypatch, kind, name):
    """The estimator that the query would fit."""
    def fit(self, df):
        raise Asked(self)

    bundle = SimpleNamespace(part=lambda split: None, names=[], data=SimpleNamespace(sparkSession=spark))
    monkeypatch.setattr(M, "launch_bundle", lambda *a, **k: bundle)
    monkeypatch.setattr(kind, "fit", fit)
    with pytest.raises(Asked) as caught:
        QUERIES[name](spark, "")
    return caught.value.args[0]


def test_random_forest_has_all_its_trees(spark, monkeypatch):
    e = asked_for(spark, monkeypatch, RandomForestRegressor, "random_forest")
    assert (e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode()) == (300, 30, 5)


def test_gbt_early_stop_has_its_whole_path(spark, monkeypatch):
    e = asked_for(spark, monkeypatch, GBTRegressor, "gbt_early_stop")
    assert (e.getMaxIter(), e.getMaxDepth(), e.getStepSize()) == (500, 6, 0.05)
    assert (e.getSubsamplingRate(), float(e.getFeatureSubsetStrategy())) == (0.8, 0.8)


def test_long_paths_are_cut_by_checkpoints(spark, monkeypatch):
    """Without a folder Spark ignores the interval, and the plan of the residuals grows with each round."""
    asked_for(spark, monkeypatch, GBTRegressor, "gbt_early_stop")
    assert spark.sparkContext.getCheckpointDir() and T.boosted_trees().getCheckpointInterval() > 0
