import pytest
from pyspark.sql import functions as F

from peerlight.operators import model
from peerlight.operators.trees import score_with_saved_trees
from peerlight.sources import save_model


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return spark.range(600).select(
        n.cast("string").alias("provider_id"),
        ((n * 37) % 101).cast("double").alias("a"),
        F.when(n % 17 == 0, None).otherwise((n * n) % 53).alias("b"),
        F.when(n % 13 == 0, float("nan")).otherwise((n % 7) / 3.0).alias("c"),
        (((n * 37) % 101 + n % 7) % 3 == 0).cast("double").alias("is_fraud"),
    )


@pytest.mark.parametrize("name, depth", [("random_forest", 8), ("gbt_classifier", 6)])
def test_node_tables_give_the_models_probability(spark, rows, tmp_path, monkeypatch, name, depth):
    monkeypatch.setitem(model.FOREST_SETTINGS, "numTrees", 12)
    monkeypatch.setitem(model.BOOSTING_SETTINGS, "maxIter", 8)
    weighted = model.add_class_weight(rows, 200, 400)
    fitted = model.train_candidate_models(weighted, ["a", "b", "c"], names=[name])[name]
    path = str(tmp_path / name)
    save_model(fitted, path)
    wanted = {r.provider_id: r.supervised_score for r in model.score_with_model(rows, fitted).collect()}
    scored = score_with_saved_trees(rows, path, ["a", "b", "c"], depth)
    got = {r.provider_id: r.supervised_score for r in scored.collect()}
    assert len(set(got.values())) > 20 and max(abs(got[k] - wanted[k]) for k in wanted) < 1e-9
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
