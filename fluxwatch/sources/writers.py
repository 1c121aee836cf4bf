"""Sinks."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fluxwatch.config import WindowConfig
from fluxwatch.operators.alerts import as_json
from fluxwatch.sources.readers import read_packets


def write_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str, trigger: str | None = WindowConfig.trigger
) -> StreamingQuery:
    """Streams a ``value`` (and optional ``key``) column to a topic, at least once.

    ``trigger`` None writes what is there and stops. Needs the Kafka connector on the classpath.
    """
    writer = (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    timed = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return timed.start()


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Writes keyed rows to a topic in one batch, acknowledged by all replicas."""
    (
        df.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def write_jsonl_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = "15 minutes",
    rows_per_file: int = 500_000,
    available_now: bool = False,
) -> StreamingQuery:
    """Appends rows as JSON lines. The trigger interval and the row limit per file
    take the place of a time- and size-based roll policy; files appear only complete."""
    writer = (
        as_json(df)
        .writeStream.format("text")
        .option("maxRecordsPerFile", rows_per_file)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    timed = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return timed.start(path)


def write_console(df: DataFrame, mode: str = "append", trigger: str = WindowConfig.trigger) -> StreamingQuery:
    """Prints each micro-batch of a stream."""
    return (
        df.writeStream.format("console")
        .option("truncate", False)
        .outputMode(mode)
        .trigger(processingTime=trigger)
        .start()
    )


def preview(df: DataFrame, n: int = 10) -> None:
    """Prints the first rows of a batch result."""
    df.show(n, truncate=False)


def packets_to_parquet(
    spark: SparkSession, source: str, target: str, partition_by_label: bool = False
) -> None:
    """Typed, snappy-compressed Parquet copy of a packet CSV."""
    writer = read_packets(spark, source).write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy("attack_type") if partition_by_label else writer).parquet(target)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def write_metrics(spark: SparkSession, metrics: dict, importance: DataFrame, folder: str) -> None:
    """Evaluation as one JSON line, importances (one row per feature) as JSON lines."""
    line = spark.range(1).select(F.lit(json.dumps(metrics)).alias("value"))
    line.coalesce(1).write.mode("overwrite").text(f"{folder}/evaluation.json")
    ranked = importance.orderBy(F.desc("importance")).select(
        F.to_json(F.struct("feature", "importance")).alias("value")
    )
    ranked.coalesce(1).write.mode("overwrite").text(f"{folder}/feature-importance.txt")
