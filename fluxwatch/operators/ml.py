"""Random-forest training, scoring and evaluation."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.config import ForestConfig
from fluxwatch.operators.stats import confusion, observed
from fluxwatch.schemas import FEATURES
from fluxwatch.session import written

UNKNOWN = "__unknown"


def index_labels(flows: DataFrame, label: str = "Attack_Type") -> StringIndexerModel:
    """Label index by falling frequency; an unseen or missing label gets the index after the last."""
    indexer = StringIndexer(inputCol=label, outputCol="label", handleInvalid="keep")
    return indexer.fit(flows)


def forest_pipeline(labels: list[str], config: ForestConfig = ForestConfig()) -> Pipeline:
    """Assembler, forest and index-to-label, in this order."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip"),
            RandomForestClassifier(
                labelCol="label",
                featuresCol="features",
                numTrees=config.num_trees,
                maxDepth=config.max_depth,
                seed=config.seed,
            ),
            # the forest knows one class more than there are labels
            IndexToString(
                inputCol="prediction", outputCol="predicted_attack", labels=[*labels, UNKNOWN]
            ),
        ]
    )


def is_training_row(key: list[str], percent: int = 80, seed: int = 42) -> Column:
    """Membership of the training part, by a hash of the key: the same for every
    partitioning and every retry of a task."""
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(100)) < percent


def split_rows(
    flows: DataFrame, key: list[str], percent: int = 80, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    chosen = is_training_row(key, percent, seed)
    return flows.filter(chosen), flows.filter(~chosen)


def random_split(flows: DataFrame, percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Row-wise random split; depends on how the rows are partitioned."""
    train, test = flows.randomSplit([percent / 100, 1 - percent / 100], seed)
    return train, test


def classification_metrics(counts: DataFrame, label: str, prediction: str, n: str = "count") -> DataFrame:
    """Accuracy and weighted precision, recall and F1 from confusion counts.

    One pass over counts (classes squared rows at most), not over the data.
    """
    hit = F.when(F.col(label) == F.col(prediction), F.col(n)).otherwise(0)
    # every class needs its predicted total, also where no row predicts it right
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col(label).alias("c"), F.col(n).alias("actual"), F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("hits")),
                F.struct(F.col(prediction).alias("c"), F.lit(0).cast("long").alias("actual"), F.col(n).alias("predicted"), F.lit(0).cast("long").alias("hits")),
            )
        ).alias("s")
    ).select("s.*")
    classes = sides.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("actual", "predicted", "hits")])
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    total = F.sum("actual")
    return classes.agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(precision * F.col("actual")) / total).alias("precision"),
        (F.sum(recall * F.col("actual")) / total).alias("recall"),
        (F.sum(f1 * F.col("actual")) / total).alias("f1"),
    )


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per feature."""
    values = model.stages[1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(FEATURES, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def score(model: PipelineModel, flows: DataFrame) -> DataFrame:
    """Adds ``predicted_attack``; the same call for batch and stream."""
    return model.transform(flows)


@dataclass
class Training:
    model: PipelineModel
    labels: list[str]
    predictions: DataFrame
    confusion: DataFrame
    metrics: dict
    importance: DataFrame


def train(
    flows: DataFrame,
    key: list[str] | None = None,
    config: ForestConfig = ForestConfig(),
    iat_unit: str = "s",
) -> Training:
    """Fits and evaluates the forest on flow rows.

    The features are kept on executors for the several passes a forest makes;
    a lost block is recomputed from its lineage.
    """
    spark = flows.sparkSession
    key = key or ["flow_id"]
    kept = flows.na.fill(0.0, FEATURES).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counted, all_rows = observed(kept, "rows")
        indexer = index_labels(counted)
        labels = list(indexer.labels)
        indexed = indexer.transform(kept)
        train_rows, test_rows = split_rows(indexed, key, config.train_percent, config.seed)
        started = time.monotonic()
        model = forest_pipeline(labels, config).fit(train_rows)
        seconds = time.monotonic() - started
        # written once: neither the metrics nor the caller build the features again
        watched, scored_rows = observed(score(model, test_rows).drop("features", "rawPrediction", "probability"), "scored")
        scored = written(watched, "scored")
        table = written(confusion(scored, "Attack_Type", "predicted_attack"), "confusion")
        result = classification_metrics(table, "Attack_Type", "predicted_attack").first()
    finally:
        kept.unpersist()
    metrics = {
        **(result.asDict() if result else {}),
        "numTrees": config.num_trees,
        "maxDepth": config.max_depth,
        "trainingTimeSec": round(seconds, 3),
        "iatUnit": iat_unit,
        # counted as they passed, without jobs of their own
        "rows": all_rows.get["rows"],
        "testRows": scored_rows.get["rows"],
    }
    return Training(model, labels, scored, table, metrics, feature_importance(spark, model))


def in_unit(flows: DataFrame, unit: str) -> DataFrame:
    """Gap features from milliseconds into the unit a model was trained on."""
    if unit not in ("s", "ms"):
        raise ValueError(f"unknown unit of gaps {unit!r}")
    gaps = [c for c in FEATURES if c.startswith("Flow_IAT_")]
    return flows.withColumns({c: F.col(c) / 1000.0 for c in gaps}) if unit == "s" else flows


def check_iat_unit(metrics: dict, iat_unit: str) -> None:
    """Refuses to score gaps in another unit than the model saw."""
    trained = metrics.get("iatUnit", iat_unit)
    if trained != iat_unit:
        raise ValueError(f"model was trained on gaps in {trained}, not {iat_unit}")
