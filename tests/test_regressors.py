"""All kinds of regressors are fitted, with their full settings."""

import pytest
from pyspark.sql import functions as F

from cantus.operators import modeling as L
from cantus.plans import q_models as QM


@pytest.fixture(scope="module")
def rows(spark):
    at = [((F.col("id") * p) % 97 / 97.0).alias(c) for c, p in (("a", 13), ("b", 29))]
    return spark.range(600).select("id", *at).withColumn("target_score", F.col("a") * 0.7 + F.col("b") * 0.2)


def test_a_network_is_a_regressor_like_the_others(rows):
    model = L.fit(L.regressor_pipeline("mlp", ["a", "b"], hidden=(8,), rounds=40, rate=0.02), rows)
    told = model.transform(rows)
    assert told.columns == [*rows.columns, "prediction"] and told.count() == 600
    assert told.agg(F.sqrt(F.avg((F.col("prediction") - F.col("target_score")) ** 2))).first()[0] < 0.1
    assert "prediction" not in L.as_score_model(model)(rows).columns


def test_a_search_takes_networks(rows):
    found = L.search_regressors(rows, ["id"], ("a", "b"), grids={"mlp": {"hidden": [(1,), (8,)], "rate": [0.02]}}, k=2)
    model, told = found["mlp"]
    assert [p for p, _ in told] == ["{'hidden': (1,), 'rate': 0.02}", "{'hidden': (8,), 'rate': 0.02}"]
    assert model.transform(rows).count() == 600 and {"random_forest", "gbt", "mlp"} == set(L.REGRESSOR_GRID)


def test_the_query_fits_every_kind_with_full_settings(spark, sf, monkeypatch):
    made, make = [], L.regressor_pipeline
    small = {"random_forest": {"n_trees": 2, "max_depth": 2}, "gbt": {"max_iter": 2}, "mlp": {"rounds": 1}}
    monkeypatch.setattr(L, "regressor_pipeline", lambda kind, *a, **p: made.append((kind, make(kind, *a, **p).getStages()[-1])) or make(kind, *a, **{**p, **small[kind]}))
    told = {r.model for r in QM.recommender_regressors(spark, sf).select("model").collect()}
    assert told == {"random_forest", "gbt", "mlp"} == {k for k, _ in made}
    stages = dict(made)
    assert stages["random_forest"].getNumTrees() == 200 and stages["random_forest"].getMaxDepth() == 12
    assert stages["gbt"].getMaxIter() == 20 and stages["mlp"].options == {}
