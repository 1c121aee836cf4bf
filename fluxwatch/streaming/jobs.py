"""Structured Streaming jobs: detection, window statistics, model scoring."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fluxwatch.config import WindowConfig
from fluxwatch.functions.rules import classify_rules
from fluxwatch.functions.scalars import zero_fill
from fluxwatch.operators.alerts import as_json, to_alerts, to_ml_alerts
from fluxwatch.operators.ml import in_unit, score
from fluxwatch.operators.stats import windowed_stats
from fluxwatch.schemas import TRAINING_NAMES
from fluxwatch.sources.decode import decode_flows, to_training_names

# Fixed value: size at which a JSON-lines file is closed.
ROLL_BYTES = 128 * 1024 * 1024


def detect(messages: DataFrame, timestamp=None) -> DataFrame:
    """JSON messages -> rule alerts. No shuffle; batch and stream alike."""
    return to_alerts(classify_rules(decode_flows(messages)), timestamp)


def stream_flow_stats(
    flows: DataFrame, time: str | None = None, config: WindowConfig = WindowConfig()
) -> DataFrame:
    """Statistics per tumbling window.

    With ``time`` the windows follow that event-time column, and rows later than
    the watermark are dropped. Without it they follow the arrival of rows: a stream's
    windows then close by the clock, whether or not further rows come.
    """
    if time is None:
        return _arrival_stats(flows, config)
    if flows.isStreaming:
        flows = flows.withWatermark(time, config.watermark)
    return windowed_stats(flows, time, config.length)


def _arrival_stats(flows: DataFrame, config: WindowConfig) -> DataFrame:
    """Windows of arrival. A heartbeat of one row a second moves the watermark with the clock, so that
    in append mode a window is published once, soon after its end, also when the stream is idle."""
    if not flows.isStreaming:
        return windowed_stats(flows.withColumn("__arrival", F.current_timestamp()), "__arrival", config.length)
    labelled = flows if "attack_type" in flows.columns else classify_rules(flows)
    clock = flows.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    beats = clock.select(F.lit(True).alias("__beat"))
    both = labelled.withColumn("__beat", F.lit(False)).unionByName(beats, allowMissingColumns=True)
    timed = both.withColumn("__arrival", F.current_timestamp()).withWatermark("__arrival", "0 seconds")
    rows = windowed_stats(timed, "__arrival", config.length, F.count_if(~F.col("__beat")))
    return rows.filter(F.col("totalFlows") > 0)


def until_closed(query: StreamingQuery, length: str = WindowConfig.length, poll: float = 0.2) -> None:
    """Waits until a stream of arrival windows has read what there is and published its last window, then
    stops it. A later run with the same checkpoint goes on from there and publishes none of them again."""
    amount, unit = length.split()
    size = timedelta(**{unit if unit.endswith("s") else f"{unit}s": int(amount)}).total_seconds()
    seen, end, quiet = -1, 0.0, 0
    while query.isActive:
        for p in query.recentProgress:
            if p.batchId <= seen:
                continue
            seen = p.batchId
            begun = datetime.fromisoformat(p.timestamp).timestamp()
            if any(s.numInputRows for s in p.sources if "Rate" not in s.description):
                done = begun + p.durationMs.get("triggerExecution", 0) / 1000
                end, quiet = max(end, (done // size + 1) * size), 0
                continue
            # the first batch may be one that an earlier run had planned and not finished
            quiet += 1
            mark = p.eventTime.get("watermark")
            if quiet > 1 and (not end or mark and datetime.fromisoformat(mark).timestamp() >= end):
                query.stop()
                return
        query.awaitTermination(poll)


def score_messages(
    messages: DataFrame, model: PipelineModel, timestamp=None, keep: list[str] | None = None, iat_unit: str = "ms"
) -> DataFrame:
    """JSON messages -> model alerts; every message is scored, also a broken one.

    ``iat_unit`` is the unit of gaps the model was trained on; messages hold milliseconds.
    """
    flows = decode_flows(messages, "permissive", keep=keep)
    named = in_unit(zero_fill(to_training_names(flows, TRAINING_NAMES)), iat_unit)
    return to_ml_alerts(score(model, named), timestamp)


def fan_out(
    stream: DataFrame,
    sinks: list[Callable[[DataFrame, int], None]],
    checkpoint: str,
    mode: str = "append",
    trigger: str | None = None,
) -> StreamingQuery:
    """One stream, several outputs: each micro-batch is computed once.

    ``trigger`` None processes what is there and stops. A batch may be replayed
    after a failure, with the same number: sinks that write under that number
    stay exact.
    """

    def write(batch: DataFrame, number: int) -> None:
        if len(sinks) == 1:
            sinks[0](batch, number)
            return
        kept = batch.persist()
        try:
            for sink in sinks:
                sink(kept, number)
        finally:
            kept.unpersist()

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    timed = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return timed.start()


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch into a folder of its own number."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def jsonl_sink(path: str) -> Callable[[DataFrame, int], None]:
    """The same as JSON lines."""

    def write(batch: DataFrame, number: int) -> None:
        as_json(batch).write.mode("overwrite").text(f"{path}/batch={number}")

    return write


def rolling_jsonl_sink(path: str, max_bytes: int = ROLL_BYTES) -> Callable[[DataFrame, int], None]:
    """JSON lines in files of at most ``max_bytes``, whatever the width of the rows; a wider row has a file alone.

    A micro-batch begins new files, so the trigger sets how old a file grows. Files of a task
    are cut by the running size of its lines, and all of a batch lie below its number.
    """

    def write(batch: DataFrame, number: int) -> None:
        size = F.octet_length("value") + 1
        lines = as_json(batch).withColumns(
            {"bytes": size.cast("long"), "task": F.spark_partition_id(), "at": F.monotonically_increasing_id()}
        )
        kept = lines.persist()
        try:
            widest = kept.agg(F.max("bytes")).first()[0] or 0
            room = max(1, max_bytes - widest)  # a line that begins inside it ends within the limit
            before = Window.partitionBy("task").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
            roll = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / room)
            rows = kept.withColumn("roll", roll).select("value", "task", "roll")
            rows.write.mode("overwrite").partitionBy("task", "roll").text(f"{path}/batch={number}")
        finally:
            kept.unpersist()

    return write


def console_sink(n: int = 20) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        batch.show(n, truncate=False)

    return write


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """Current statistics per window from the batches of an ``update`` mode stream."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in ("windowStart", "batch")]
    newest = F.max_by(F.struct(*columns), "batch").alias("now")
    return rows.groupBy("windowStart").agg(newest).select("windowStart", "now.*")


def replay(stream: DataFrame, path: str, mode: str = "append") -> None:
    """Runs a finite stream to its end into ``path``."""
    query = fan_out(stream, [parquet_sink(f"{path}/rows")], f"{path}/checkpoint", mode)
    query.awaitTermination()
