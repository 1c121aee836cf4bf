"""The walk over a node table against the fitted pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluxwatch.config import ForestConfig
from fluxwatch.operators import forest, ml
from fluxwatch.plans import views
from fluxwatch.schemas import FEATURES
from fluxwatch.sources import writers


@pytest.fixture(scope="module")
def flows(spark):
    pick = np.random.default_rng(8)
    values = pick.normal(size=(400, len(FEATURES)))
    labels = np.where(values[:, 0] > 0.5, "FLOOD", np.where(values[:, 3] + values[:, 7] > 0, "BURST", "Normal"))
    rows = [(i, *map(float, v), str(x)) for i, (v, x) in enumerate(zip(values, labels))]
    return spark.createDataFrame(rows, "flow_id long, " + ", ".join(f"{n} double" for n in FEATURES) + ", Attack_Type string")


def test_votes_are_those_of_the_pipeline(spark, flows, tmp_path):
    trained = ml.train(flows, config=ForestConfig(num_trees=6, max_depth=7))
    writers.save_model(trained.model, f"{tmp_path}/m")
    nodes = forest.node_table(spark, f"{tmp_path}/m")
    assert nodes.schema.simpleString() == "struct<" + forest.NODES.replace(", ", ",").replace(" ", ":").replace("long", "bigint") + ">"
    walk = forest.NodeForest.of(nodes, [*trained.labels, ml.UNKNOWN])
    assert walk.depth() <= 7
    own = {r["flow_id"]: (r["votes"], r["prediction"], r["predicted_attack"]) for r in walk.transform(flows).collect()}
    for r in ml.score(trained.model, flows).collect():
        votes, prediction, label = own[r["flow_id"]]
        np.testing.assert_allclose(votes, r["rawPrediction"].toArray(), rtol=1e-12)
        assert (prediction, label) == (r["prediction"], r["predicted_attack"])


def test_missing_features_ties_and_labels(spark):
    nodes = [
        (0, 0, 0, 1.0, 1, 2, [1.0, 1.0]), (0, 1, -1, None, -1, -1, [3.0, 1.0]), (0, 2, -1, None, -1, -1, [0.0, 2.0]),
        (5, 0, -1, None, -1, -1, [1.0, 3.0]),
    ]
    table = spark.createDataFrame(nodes, forest.NODES)
    one = forest.NodeForest.of(table, ["a"], ["x"])
    rows = spark.createDataFrame([(None,), (1.0,), (1.5,), (float("nan"),)], "x double").withColumn("votes", F.lit("clash"))
    got = [(r["votes"], r["prediction"], r["predicted_attack"]) for r in one.transform(rows).collect()]
    # at the threshold: left; equal votes: the first class; a class without label: null
    assert got == [([1.0, 1.0], 0.0, "a")] * 2 + [([0.25, 1.75], 1.0, None)] * 2
    with pytest.raises(ValueError, match="without gaps"):
        forest.NodeForest.of(table.where("node <> 1"), ["a"], ["x"])


def test_large_forests_are_refused(spark, monkeypatch):
    monkeypatch.setattr(forest, "MOST_NODES", 3)
    with pytest.raises(ValueError, match="pipeline"):
        views.stored_forest(spark)


def test_stays_in_the_jvm_without_shuffle(spark, flows):
    plan = views.stored_forest(spark).transform(flows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan.replace("LogicalRDD", "")
