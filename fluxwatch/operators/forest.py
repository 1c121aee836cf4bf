"""A random forest as a table of nodes, scored by a walk from the roots to the leaves.

The table is what a saved model holds, one row a node, so that any SQL engine can follow and check
a prediction. Here the walk is one expression over the row: no shuffle, no Python, batch and stream alike.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.schemas import FEATURES

# Nodes that are put into the plan as one constant. It is a property of the model, not of the data;
# larger forests are scored by the fitted pipeline itself.
MOST_NODES = 20_000

NODES = "tree int, node int, feature int, threshold double, left int, right int, counts array<double>"


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved pipeline's forest.

    ``feature`` is the position in the feature list and -1 at a leaf; rows at or below the
    ``threshold`` go ``left``. ``counts`` holds the training weight per class index.
    """
    saved = spark.read.parquet(f"{path.rstrip('/')}/stages/1_*/data").select("treeID", "nodeData.*")
    return saved.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("impurityStats").alias("counts"),
    )


@dataclass(frozen=True)
class NodeForest:
    """A forest ready to score rows; stands where a fitted pipeline does."""

    trees: tuple
    labels: tuple[str, ...]
    features: tuple[str, ...] = tuple(FEATURES)

    @classmethod
    def of(cls, nodes: DataFrame, labels: list[str], features: list[str] = FEATURES) -> NodeForest:
        """From a node table; ``labels`` by class index."""
        rows = nodes.limit(MOST_NODES + 1).collect()
        if len(rows) > MOST_NODES:
            raise ValueError(f"a forest of more than {MOST_NODES} nodes is scored by its pipeline")
        trees: dict[int, dict[int, dict]] = {}
        for r in rows:
            total = sum(r["counts"])
            votes = [c / total if total else 0.0 for c in r["counts"]]
            leaf = r["feature"] < 0
            trees.setdefault(r["tree"], {})[r["node"]] = {
                "feature": r["feature"], "threshold": 0.0 if leaf else r["threshold"],
                "left": r["left"], "right": r["right"], "votes": votes,
            }
        for nodes_of in trees.values():
            if set(nodes_of) != set(range(len(nodes_of))):
                raise ValueError("the nodes of a tree are numbered from 0 without gaps")
        packed = tuple(tuple(tree[i] for i in range(len(tree))) for _, tree in sorted(trees.items()))
        return cls(packed, tuple(labels), tuple(features))

    def depth(self) -> int:
        """Steps from a root to the deepest leaf."""
        deepest = 0
        for tree in self.trees:
            level, steps = [0], 0
            while level := [child for n in level if tree[n]["feature"] >= 0 for child in (tree[n]["left"], tree[n]["right"])]:
                steps += 1
            deepest = max(deepest, steps)
        return deepest

    def votes(self) -> Column:
        """Summed class shares of the leaves a row falls into, by class index; trees count alike."""
        kind = "array<array<struct<feature: int, threshold: double, left: int, right: int, votes: array<double>>>>"
        # folded into one constant before the plan runs
        trees = F.from_json(F.lit(json.dumps([list(t) for t in self.trees])), kind)
        values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features])

        def step(tree, node):
            at = F.element_at(tree, node + 1)
            down = F.element_at(values, at["feature"] + 1) <= at["threshold"]
            return F.when(at["feature"] < 0, node).when(down, at["left"]).otherwise(at["right"])

        def leaf(tree):
            end = F.reduce(F.sequence(F.lit(1), F.lit(max(self.depth(), 1))), F.lit(0), lambda node, _: step(tree, node))
            return F.element_at(tree, end + 1)["votes"]

        none = F.array_repeat(F.lit(0.0), len(self.trees[0][0]["votes"]) if self.trees else 0)
        return F.reduce(F.transform(trees, leaf), none, lambda a, b: F.zip_with(a, b, lambda x, y: x + y))

    def transform(self, flows: DataFrame) -> DataFrame:
        """Adds ``votes``, ``prediction`` (the class of most votes, the first of equals) and ``predicted_attack``.

        A missing feature counts as zero; a class without a label is null."""
        names = F.array(*[F.lit(x) for x in self.labels])
        best = (F.array_position("votes", F.array_max("votes")) - 1).cast("double")
        scored = flows.withColumn("votes", self.votes()).withColumn("prediction", best)
        return scored.withColumn("predicted_attack", F.try_element_at(names, F.col("prediction").cast("int") + 1))
