"""The engine's jobs from input to output, as the command line starts them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fluxwatch.config import TOPIC_ALERTS, TOPIC_FLOWS, TOPIC_STATS, WindowConfig
from fluxwatch.operators import ml
from fluxwatch.operators.alerts import enrich_export, to_topic_rows
from fluxwatch.operators.bandwidth import bandwidth_series, in_megabytes
from fluxwatch.operators.timeseries import compare
from fluxwatch.operators.timeseries.frame import series_frame
from fluxwatch.session import written
from fluxwatch.sources import readers, writers
from fluxwatch.sources.decode import decode_flows
from fluxwatch.streaming import jobs
from fluxwatch.streaming.state import keyed_messages


def train(spark: SparkSession, data: str, out: str) -> dict:
    """Forest from packet or flow records; model and metrics below ``out``."""
    flows = readers.read_training(spark, data)
    # features made from packets hold gaps in seconds, flow records in milliseconds
    per_packet = "flow_id" in flows.columns
    key = ["flow_id"] if per_packet else ["Flow_ID"]
    trained = ml.train(flows, key, iat_unit="s" if per_packet else "ms")
    writers.save_model(trained.model, f"{out}/rf-model")
    writers.write_metrics(spark, trained.metrics, trained.importance, f"{out}/metrics")
    return trained.metrics


def messages(spark: SparkSession, source: str, topic: str | None, starting: str) -> DataFrame:
    """Flow messages as a stream: from a topic of the servers ``source``, or from a folder."""
    if topic:
        return readers.read_flow_topic(spark, source, topic, starting)
    return readers.read_text_stream(spark, source)


def _topic_sink(servers: str, topic: str):
    """Sends keyed messages: a batch sent again has the same keys, and readers drop them (``told_once``)."""

    def write(batch: DataFrame, number: int) -> None:
        writers.publish(keyed_messages(batch, number, topic), servers, topic)

    return write


def detect(
    spark: SparkSession,
    source: str,
    out: str,
    topic: str | None = None,
    trigger: str | None = WindowConfig.trigger,
    show: bool = False,
) -> list[StreamingQuery]:
    """Rule alerts and window statistics, each to files, to its topic and to the console.

    A window is published once, when it has closed by the clock. A run that stops at the end of its
    input (``trigger`` None) waits for that; a further run publishes only windows of further input.
    """
    raw = messages(spark, source, topic, "earliest")

    def sinks(name: str, target: str) -> list:
        found = [jobs.rolling_jsonl_sink(f"{out}/{name}")]
        if topic:
            found.append(_topic_sink(source, target))
        return found + ([jobs.console_sink()] if show else [])

    alerts = jobs.fan_out(
        jobs.detect(raw), sinks("alerts", TOPIC_ALERTS), f"{out}/checkpoints/alerts", trigger=trigger
    )
    stats = jobs.fan_out(
        jobs.stream_flow_stats(decode_flows(raw)),
        sinks("statistics", TOPIC_STATS),
        f"{out}/checkpoints/statistics",
        trigger=trigger or "1 second",
    )
    if trigger is None:
        jobs.until_closed(stats)
    return [alerts, stats]


def score(
    spark: SparkSession,
    source: str,
    model: str,
    out: str,
    topic: str | None = None,
    trigger: str | None = WindowConfig.trigger,
) -> StreamingQuery:
    """Model alerts of every message, to the alert topic or to files.

    Messages hold gaps in milliseconds; they are converted to the unit that the metrics
    beside the model name.
    """
    evaluation, _ = readers.read_metrics(spark, f"{model.rstrip('/').rpartition('/')[0]}/metrics")
    stored = evaluation.first()
    unit = (stored["iatUnit"] if stored else None) or "ms"
    rows = jobs.score_messages(messages(spark, source, topic, "latest"), readers.load_model(model), iat_unit=unit)
    sink = _topic_sink(source, TOPIC_ALERTS) if topic else jobs.rolling_jsonl_sink(f"{out}/scored")
    return jobs.fan_out(rows, [sink], f"{out}/checkpoints/score", trigger=trigger)


def bandwidth(spark: SparkSession, packets: str, out: str) -> None:
    """Bandwidth per second as CSV."""
    writers.write_csv(bandwidth_series(readers.read_packets(spark, packets)), out)


def series_models(spark: SparkSession, series: str, out: str, names: list[str] | None = None) -> DataFrame:
    """Model comparison in MB/s, ranked, as CSV; forecasts next to the actual values as well."""
    frame = written(series_frame(in_megabytes(readers.read_series(spark, series))), "frame")
    models = compare.fit_models(frame, names)
    compared = compare.actual_and_forecast(models, frame)
    ranked = compare.rank_models(compare.model_table(models, compared))
    writers.write_csv(ranked, f"{out}/metrics")
    writers.write_csv(compare.plot_rows(compared, frame), f"{out}/forecasts")
    return spark.read.option("header", True).csv(f"{out}/metrics")


def export_flows(spark: SparkSession, folder: str, servers: str | None, out: str | None = None) -> None:
    """Flow files to the flow topic, or as keyed rows to a folder."""
    rows = to_topic_rows(enrich_export(readers.read_flow_files(spark, folder)))
    if servers:
        writers.publish(rows, servers, TOPIC_FLOWS)
    else:
        rows.select(F.col("value")).write.mode("overwrite").text(out)


def convert(spark: SparkSession, packets: str, out: str, by_label: bool = False) -> None:
    """Packet CSV to Parquet."""
    writers.packets_to_parquet(spark, packets, out, by_label)
