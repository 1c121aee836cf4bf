"""Registered queries: every operator on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.config import ForestConfig, WindowConfig
from fluxwatch.functions.rules import (
    classify_rules,
    label_from_code,
    severity_by_label,
    severity_by_rate,
)
from fluxwatch.functions.scalars import percent, rate_value, short_number, zero_fill
from fluxwatch.operators import alerts as al
from fluxwatch.operators import history, ml, stats
from fluxwatch.operators.bandwidth import bandwidth_series, in_megabytes
from fluxwatch.operators.counters import attach_metadata, flow_metrics_from_counters
from fluxwatch.operators.features import flow_features, packet_iat
from fluxwatch.operators.forest import NodeForest, node_table
from fluxwatch.operators.timeseries import compare, ols, recursion
from fluxwatch.operators.timeseries.anomaly import above_forecast, variance_shock
from fluxwatch.operators.timeseries.frame import fill_gaps, lagged, series_frame, test_rows, train_rows
from fluxwatch.operators.timeseries.linear import fit_arima, fit_var, forecast
from fluxwatch.operators.timeseries.volatility import fit_garch, variance_path
from fluxwatch.plans import views
from fluxwatch.schemas import FEATURES, TRAINING_NAMES
from fluxwatch.session import run_dir, written
from fluxwatch.sources import readers, writers
from fluxwatch.sources.decode import decode_flows, to_training_names
from fluxwatch.streaming import jobs, state

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RATES = {"Flow_Bytes_s": 3, "Flow_Packets_s": 3}
GAPS = ["Flow_IAT_Mean", "Flow_IAT_Std", "Flow_IAT_Max", "Flow_IAT_Min", "Flow_Duration"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def event_ms() -> Column:
    return F.unix_millis("event_time")


# ---- packets to flows --------------------------------------------------------


@query
def packet_gaps(spark, folder):
    rows = packet_iat(views.packets(spark, folder))
    return rows.select("flow_id", "timestamp_s", "packet_size_bytes", "iat")


def features(spark, folder):
    return flow_features(views.packets(spark, folder))


def _feature_columns(rows: DataFrame, key: list[str]) -> DataFrame:
    places = {
        **RATES,
        **dict.fromkeys(GAPS, 9),
        **dict.fromkeys(["Fwd_Pkt_Len_Mean", "Fwd_Pkt_Len_Std"], 6),
    }
    return rounded(rows, places).select(
        *key, *FEATURES, F.col("Attack_Type").alias("label"), F.col("PQC_Enabled").alias("pqc")
    )


@query
def flow_feature_table(spark, folder):
    return _feature_columns(features(spark, folder), ["flow_id"])


@query
def flow_features_by_run(spark, folder):
    rows = flow_features(views.packets(spark, folder), key=["run_id", "flow_id"])
    return _feature_columns(rows, ["run_id", "flow_id"])


@query
def flow_features_sent(spark, folder):
    rows = flow_features(views.packets(spark, folder), directions=("tx",))
    return rounded(rows, RATES).select("flow_id", "Total_Fwd_Packets", "Flow_Bytes_s", "Flow_Packets_s")


@query
def flow_alerts(spark, folder):
    rows = severity_by_rate(classify_rules(features(spark, folder), name="rule_type"))
    return rounded(rows, RATES).select(
        "flow_id", F.col("Attack_Type").alias("label"), "rule_type", "severity", "Flow_Bytes_s", "Flow_Packets_s"
    )


@query
def counter_metrics(spark, folder):
    rows = flow_metrics_from_counters(views.counters(spark, folder))
    return rows.select(
        "l_orderkey", "l_linenumber", "flow_duration", "flow_bytes_s", "flow_packets_s",
        "flow_iat_mean", "flow_iat_std", "flow_iat_max", "flow_iat_min",
        "fwd_pkt_len_mean", "fwd_pkt_len_std", "fwd_pkt_len_max", "fwd_pkt_len_min",
    )


@query
def class_codes(spark, folder):
    events = views.table(spark, folder, "events")
    return events.select("event_id", label_from_code(F.col("event_id") % 6).alias("label"))


@query
def attached_metadata(spark, folder):
    flows = views.bulk_flows(spark, folder).select("flow_id", "dst_port", "flow_bytes_s")
    return attach_metadata(flows, views.port_metadata(spark, folder), ["dst_port"])


# ---- rules and alerts --------------------------------------------------------


@query
def rule_classify(spark, folder):
    rows = severity_by_rate(classify_rules(views.bulk_flows(spark, folder)))
    return rows.select("flow_id", "flow_bytes_s", "attack_type", "severity")


@query
def rule_alerts(spark, folder):
    return al.to_alerts(views.bulk_flows(spark, folder)).drop("timestamp")


@query
def label_severity(spark, folder):
    rows = severity_by_label(classify_rules(views.bulk_flows(spark, folder)), "attack_type")
    return rows.select("flow_id", "flow_packets_s", "attack_type", "severity")


def _whole_rates(spark, folder) -> DataFrame:
    """Labelled flows with rates in whole bytes, whose sums are exact in any order."""
    flows = classify_rules(views.timed_flows(spark, folder))
    return flows.withColumn("flow_bytes_s", F.floor("flow_bytes_s").cast("double"))


def _scored_by_rules(spark, folder) -> DataFrame:
    """Flows with the rule class in the place of a model's prediction."""
    return classify_rules(views.timed_flows(spark, folder), name="predicted_attack")


@query
def ml_alerts(spark, folder):
    rows = al.to_ml_alerts(_scored_by_rules(spark, folder), F.col("event_time"), "epoch_ms")
    return rounded(rows, {"kemHandshakeMs": 6, "sigSignMs": 6})


@query
def ml_attack_alerts(spark, folder):
    rows = al.to_ml_alerts(
        _scored_by_rules(spark, folder), F.col("event_time"), "epoch_ms", include_normal=False
    )
    return rows.select("flowId", "attackType", "severity", "timestamp")


def merged_alerts(spark, folder) -> DataFrame:
    rule = al.to_alerts(views.timed_flows(spark, folder), event_ms())
    ml_rows = al.to_ml_alerts(_scored_by_rules(spark, folder), F.col("event_time"))
    return al.merge_alert_streams(rule, ml_rows)


@query
def alerts_union(spark, folder):
    return merged_alerts(spark, folder)


@query
def alert_json(spark, folder):
    texts = al.as_json(al.to_alerts(views.timed_flows(spark, folder), event_ms()))
    parts = {"flowId": "int", "attackType": "string", "timestamp": "long", "message": "string", "pqcEnabled": "boolean"}
    return texts.select(*[F.get_json_object("value", f"$.{n}").cast(t).alias(n) for n, t in parts.items()])


@query
def severity_filtered(spark, folder):
    rows = al.severity_filter(merged_alerts(spark, folder), "HIGH")
    return rows.select("flow_id", "attack_type", "severity", "timestamp_ms", "is_ml")


@query
def alert_counter(spark, folder):
    return al.severity_counts(merged_alerts(spark, folder))


@query
def latest_alerts(spark, folder):
    rows = al.severity_filter(merged_alerts(spark, folder))
    shown = history.latest(rows, "timestamp_ms", history.ALERTS_SHOWN, ["flow_id", "is_ml"])
    return shown.select("flow_id", "attack_type", "severity", "timestamp_ms", "is_ml")


@query
def alert_history(spark, folder):
    rows = al.to_alerts(views.timed_flows(spark, folder), event_ms())
    return history.latest(rows, "timestamp", history.HISTORY, ["flowId"]).select("flowId", "severity", "timestamp")


@query
def topic_rows(spark, folder):
    flows = views.timed_flows(spark, folder).select("flow_id", "src_ip", "flow_bytes_s")
    rows = al.to_topic_rows(al.enrich_export(flows, F.lit(1704067200000)))
    parts = {"exported_at": "long", "source": "string", "src_ip": "string", "flow_bytes_s": "double"}
    return rows.select(
        "key", *[F.get_json_object("value", f"$.{n}").cast(t).alias(n) for n, t in parts.items()]
    )


# ---- statistics --------------------------------------------------------------


def _flat_stats(rows: DataFrame) -> DataFrame:
    """The class histogram as columns, averages rounded."""
    spread = {
        f"n_{c.lower()}": F.coalesce(F.try_element_at("attackTypes", F.lit(c)), F.lit(0).cast("long"))
        for c in ("FLOOD", "STEALTH", "BURST")
    }
    places = {"avgBytesPerSec": 4, "avgPacketsPerSec": 9, "avgKemHandshakeMs": 9, "avgSigSignMs": 9}
    return rounded(rows.withColumns(spread).drop("attackTypes"), places)


@query
def flow_stats_10s(spark, folder):
    return _flat_stats(stats.windowed_stats(_whole_rates(spark, folder), "event_time"))


@query
def flow_stats_total(spark, folder):
    return _flat_stats(stats.flow_stats(views.bulk_flows(spark, folder)))


@query
def flow_stats_merge(spark, folder):
    parts = stats.flow_stats(views.bulk_flows(spark, folder), ["status"])
    return _flat_stats(stats.merge_stats(parts))


@query
def attack_histogram(spark, folder):
    rows = stats.flow_stats(views.bulk_flows(spark, folder), ["dst_port"])
    return _flat_stats(rows).select("dst_port", "n_flood", "n_stealth", "n_burst", "totalFlows")


@query
def class_distribution(spark, folder):
    return stats.class_distribution(classify_rules(views.bulk_flows(spark, folder)))


@query
def run_totals(spark, folder):
    return stats.row_counts(views.packets(spark, folder))


@query
def running_rates(spark, folder):
    rows = stats.running_rates(_whole_rates(spark, folder), "event_time", by=["src_ip"], tie=["flow_id"])
    return rows.select("src_ip", "flow_id", "flow_count", "avg_bytes_s", "avg_packets_s")


@query
def running_rates_overall(spark, folder):
    rows = stats.running_rates(_whole_rates(spark, folder), "event_time", tie=["flow_id"])
    return rows.select("flow_id", "flow_count", "avg_bytes_s", "avg_packets_s")


@query
def chart_points(spark, folder):
    rows = stats.running_rates(_whole_rates(spark, folder), "event_time", tie=["flow_id"])
    shown = history.chart_points(rows.withColumn("event_ms", event_ms()), "event_ms", tie=["flow_id"])
    return shown.select("flow_id", "event_ms", "flow_count", "avg_bytes_s")


@query
def rate_values(spark, folder):
    flows = views.timed_flows(spark, folder)
    mixed = flows.select(
        "flow_id",
        F.when(F.col("flow_id") % 3 != 0, F.col("flow_bytes_s")).alias("flow_bytes_s"),
        F.when(F.col("flow_id") % 2 == 0, F.col("flow_packets_s")).alias("avgBytesPerSec"),
    )
    return mixed.select("flow_id", rate_value(mixed, "flow_bytes_s", "avgBytesPerSec").alias("bytes_value"))


def _frame(spark, folder) -> DataFrame:
    """The series frame written once, for queries that read it many times."""
    return written(views.frame(spark, folder), "frame")


def _horizon(length: str) -> Query:
    def run(spark, folder):
        return history.horizon_rates(_whole_rates(spark, folder), "event_time", length)

    return run


for _length in history.HORIZONS:
    QUERIES[f"horizon_{_length.split()[0]}s"] = _horizon(_length)


@query
def display_numbers(spark, folder):
    flows = views.bulk_flows(spark, folder)
    return flows.select(
        "flow_id", "flow_bytes_s",
        short_number(F.col("flow_bytes_s")).alias("bytes_text"),
        percent(F.when(F.col("pqc_enabled"), F.col("flow_iat_mean"))).alias("percent_text"),
    )


# ---- bandwidth ---------------------------------------------------------------


@query
def bandwidth(spark, folder):
    return bandwidth_series(views.packets(spark, folder))


@query
def bandwidth_by_run(spark, folder):
    return bandwidth_series(views.packets(spark, folder), by=["run_id"])


@query
def bandwidth_megabytes(spark, folder):
    return in_megabytes(bandwidth_series(views.packets(spark, folder)))


@query
def bandwidth_split(spark, folder):
    rows = bandwidth_series(views.packets(spark, folder), by=["run_id"])
    placed = series_frame(rows, by=["run_id"])
    return placed.select("run_id", "time_bucket", "total_bytes_per_sec", "idx", "n_train", "is_train")


@query
def filled_series(spark, folder):
    rows = fill_gaps(views.series(spark, folder), ["tx_bytes_per_sec", "rx_bytes_per_sec", "total_bytes_per_sec"])
    return rows.select("series_id", "time_bucket", "total_bytes_per_sec")


# ---- decoding and files ------------------------------------------------------

DECODED = ["flow_id", "src_ip", "dst_port", "flow_bytes_s", "flow_packets_s", "pqc_enabled", "kem_handshake_ms", "sig_bytes", "timestamp"]


@query
def decode_strict(spark, folder):
    return decode_flows(views.messages(spark, folder)).select(*DECODED)


@query
def decode_permissive(spark, folder):
    return decode_flows(views.messages(spark, folder), "permissive").select(*DECODED)


@query
def training_names(spark, folder):
    flows = decode_flows(views.messages(spark, folder), "permissive")
    return zero_fill(to_training_names(flows, TRAINING_NAMES)).select("flow_id", *FEATURES)


@query
def detected_alerts(spark, folder):
    return jobs.detect(views.messages(spark, folder)).drop("timestamp")


def _packet_csv(spark, folder) -> str:
    path = run_dir(spark, "packets-csv")
    rows = views.packets(spark, folder)
    typed = rows.withColumn("pqc_enabled", F.col("pqc_enabled").cast("int"))
    writers.write_csv(typed.select(*readers.PACKET.names), path)
    return path


@query
def csv_bandwidth(spark, folder):
    return bandwidth_series(readers.read_packets(spark, _packet_csv(spark, folder)))


@query
def parquet_copy(spark, folder):
    target = run_dir(spark, "packets") + ".parquet"
    writers.packets_to_parquet(spark, _packet_csv(spark, folder), target)
    rows = readers.read_packets(spark, target)
    return rows.groupBy("attack_type", "pqc_enabled").agg(
        F.count("*").alias("packets"), F.sum("packet_size_bytes").alias("bytes")
    )


@query
def training_from_csv(spark, folder):
    rows = readers.read_training(spark, _packet_csv(spark, folder))
    return rows.select("flow_id", "Total_Fwd_Packets", "Fwd_Pkt_Len_Max", F.col("Attack_Type").alias("label"))


@query
def run_files(spark, folder):
    base = run_dir(spark, "runs")
    rows = views.packets(spark, folder)
    typed = rows.withColumn("pqc_enabled", F.col("pqc_enabled").cast("int"))
    named = typed.withColumn("run", F.concat(F.lit("run-"), F.col("run_id")))
    named.select("run", *readers.PACKET.names).write.partitionBy("run").option("header", True).csv(base)
    runs = readers.read_runs(spark, base)
    return runs.groupBy("run_id").agg(
        F.count("*").alias("packets"), F.sum("packet_size_bytes").alias("bytes")
    )


# ---- models ------------------------------------------------------------------


def _training_rows(spark, folder) -> DataFrame:
    """Flow features; a few labels are swapped so that no model is perfect."""
    rows = features(spark, folder)
    swapped = F.when(F.col("flow_id") % 35 == 0, "BURST").otherwise(F.col("Attack_Type"))
    return rows.withColumn("Attack_Type", swapped)


def _relabelled(spark, folder) -> DataFrame:
    rows = classify_rules(views.bulk_flows(spark, folder), name="prediction")
    swapped = F.when(F.col("flow_id") % 7 == 0, "BURST").otherwise(F.col("prediction"))
    return rows.withColumn("label", swapped)


@query
def confusion(spark, folder):
    return stats.confusion(_relabelled(spark, folder), "label", "prediction")


@query
def classification_metrics(spark, folder):
    counts = stats.confusion(_relabelled(spark, folder), "label", "prediction")
    rows = ml.classification_metrics(counts, "label", "prediction")
    return rounded(rows, dict.fromkeys(["accuracy", "precision", "recall", "f1"], 9))


@query
def metric_texts(spark, folder):
    counts = stats.confusion(_relabelled(spark, folder), "label", "prediction")
    return history.display_metrics(ml.classification_metrics(counts, "label", "prediction"))


@query
def rf_predict(spark, folder):
    trained = ml.train(_training_rows(spark, folder))
    return trained.predictions.select("flow_id", F.col("Attack_Type").alias("label"), "prediction", "predicted_attack")


@query
def rf_confusion(spark, folder):
    return ml.train(_training_rows(spark, folder)).confusion


@query
def rf_importance(spark, folder):
    return history.display_features(ml.train(_training_rows(spark, folder)).importance)


@query
def rf_reloaded(spark, folder):
    """Model and metrics written, read back and used."""
    base = run_dir(spark, "model")
    rows = _training_rows(spark, folder)
    trained = ml.train(rows)
    writers.save_model(trained.model, f"{base}/rf-model")
    writers.write_metrics(spark, trained.metrics, trained.importance, f"{base}/metrics")
    metrics, _ = readers.read_metrics(spark, f"{base}/metrics")
    scored = ml.score(readers.load_model(f"{base}/rf-model"), rows)
    share = scored.agg(F.avg((F.col("predicted_attack") == F.col("Attack_Type")).cast("double")).alias("agreement"))
    kept = metrics.select("numTrees", "maxDepth", "accuracy")
    return share.withColumn("__one", F.lit(1)).join(kept.withColumn("__one", F.lit(1)), "__one").drop("__one")


@query
def forest_predict(spark, folder):
    """All flows by a stored forest: votes of its trees and the class."""
    rows = views.stored_forest(spark).transform(_training_rows(spark, folder))
    votes = [F.round(F.element_at("votes", i + 1), 9).alias(f"votes_{n.lower()}") for i, n in enumerate(views.FOREST_LABELS)]
    return rows.select("flow_id", F.col("Attack_Type").alias("label"), "prediction", "predicted_attack", *votes)


@query
def forest_confusion(spark, folder):
    rows = views.stored_forest(spark).transform(_training_rows(spark, folder))
    return stats.confusion(rows, "Attack_Type", "predicted_attack").withColumnRenamed("Attack_Type", "label")


@query
def forest_reloaded(spark, folder):
    """A trained forest, saved and scored twice: by its pipeline and by a walk over its stored nodes."""
    path = f"{run_dir(spark, 'nodes')}/rf-model"
    rows = written(_training_rows(spark, folder), "features")
    trained = ml.train(rows, config=ForestConfig(num_trees=8, max_depth=5))
    writers.save_model(trained.model, path)
    walk = NodeForest.of(node_table(spark, path), [*trained.labels, ml.UNKNOWN])
    by_nodes = walk.transform(rows).select("flow_id", F.col("predicted_attack").alias("by_nodes"))
    scored = ml.score(readers.load_model(path), rows).join(by_nodes, "flow_id")
    return scored.agg(F.count("*").alias("n_flows"), F.count_if(F.col("by_nodes") == F.col("predicted_attack")).alias("n_equal"))


@query
def stream_rolled_lines(spark, folder):
    """Alerts as JSON lines in files of at most 64 KiB, read back; the largest file is told with them."""
    path = run_dir(spark, "rolled")
    found = jobs.detect(views.message_stream(spark, folder))
    jobs.fan_out(found, [jobs.rolling_jsonl_sink(f"{path}/rows", 1 << 16)], f"{path}/checkpoint").awaitTermination()
    schema = "flowId int, attackType string, severity string, flowBytesPerSec double, pqcEnabled boolean"
    rows = spark.read.schema(schema).json(f"{path}/rows").select(*[c.split(" ")[0] for c in schema.split(", ")], (F.col("_metadata.file_size") <= 1 << 16).alias("within"))
    return rows


@query
def stream_forest_alerts(spark, folder):
    """Messages scored by the stored forest as they arrive."""
    path = run_dir(spark, "forest")
    jobs.replay(jobs.score_messages(views.message_stream(spark, folder), views.stored_forest(spark)), path)
    rows = spark.read.parquet(f"{path}/rows")
    return rows.select("flowId", "flowBytesPerSec", "attackType", "severity", "source")


# ---- streams -----------------------------------------------------------------


@query
def stream_flow_stats(spark, folder):
    path = run_dir(spark, "stats")
    flows = classify_rules(views.flow_stream(spark, folder))
    whole = flows.withColumn("flow_bytes_s", F.floor("flow_bytes_s").cast("double"))
    rows = jobs.stream_flow_stats(whole, "event_time")
    jobs.replay(rows, path, "update")
    return _flat_stats(jobs.latest_windows(spark, f"{path}/rows"))


@query
def stream_alerts(spark, folder):
    path = run_dir(spark, "alerts")
    jobs.replay(jobs.detect(views.message_stream(spark, folder)), path)
    return spark.read.parquet(f"{path}/rows").drop("timestamp", "batch")


@query
def stream_alert_lines(spark, folder):
    """The JSON-lines sink, read back."""
    path = run_dir(spark, "lines")
    found = jobs.detect(views.message_stream(spark, folder))
    writers.write_jsonl_stream(
        found, f"{path}/rows", f"{path}/checkpoint", available_now=True
    ).awaitTermination()
    schema = "flowId int, attackType string, severity string, flowBytesPerSec double, pqcEnabled boolean"
    return spark.read.schema(schema).json(f"{path}/rows")


def _in_thirds(spark, rows: DataFrame, path: str, start) -> None:
    """Feeds rows to a stream in three runs on one checkpoint; ``start`` makes a query of the stream."""
    for step in range(3):
        views.arriving(spark, rows, f"{path}/in", step)
        start(spark.readStream.schema(rows.schema).parquet(f"{path}/in")).awaitTermination()


@query
def stream_arrival_stats(spark, folder):
    """Windows of arrival over two runs, combined: each is published once, the last one too."""
    path, config = run_dir(spark, "arrival"), WindowConfig(length="2 seconds")
    flows = classify_rules(views.flow_stream(spark, folder))
    whole = flows.withColumn("flow_bytes_s", F.floor("flow_bytes_s").cast("double"))
    for _ in range(2):
        rows = jobs.stream_flow_stats(whole, config=config)
        jobs.until_closed(jobs.fan_out(rows, [jobs.parquet_sink(f"{path}/rows")], f"{path}/checkpoint", trigger="1 second"), config.length)
    published = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    return _flat_stats(stats.merge_stats(published))


@query
def stream_running_rates(spark, folder):
    """Totals carried over three runs, the last batch replayed."""
    path = run_dir(spark, "running")
    rows = _whole_rates(spark, folder).select("src_ip", "flow_id", "event_time", "flow_bytes_s", "flow_packets_s")
    sink = state.running_rates_sink(path, "event_time", by=["src_ip"], tie=["flow_id"])
    _in_thirds(spark, rows, path, lambda stream: jobs.fan_out(stream, [sink], f"{path}/checkpoint"))
    sink(rows.filter(F.unix_seconds("event_time") >= F.lit(1704067200 + 180)), 2)
    found = spark.read.parquet(f"{path}/rows")
    return found.select("src_ip", "flow_id", "flow_count", "avg_bytes_s", "avg_packets_s")


@query
def stream_alert_history(spark, folder):
    """The newest alerts after three runs, the last batch replayed."""
    path = run_dir(spark, "history")
    flows = views.timed_flows(spark, folder)
    sink = state.history_sink(f"{path}/table", "timestamp", tie=["flowId"])
    _in_thirds(spark, flows, path, lambda stream: jobs.fan_out(al.to_alerts(stream, event_ms()), [sink], f"{path}/checkpoint"))
    sink(al.to_alerts(flows.filter(F.unix_seconds("event_time") >= F.lit(1704067200 + 180)), event_ms()), 2)
    return state.read_history(spark, f"{path}/table", "timestamp", tie=["flowId"]).select("flowId", "severity", "timestamp")


@query
def stream_alerts_union(spark, folder):
    """Both producers' alerts merged live; the second third of the rule alerts is sent twice."""
    path = run_dir(spark, "merge")
    rule = al.to_alerts(views.timed_flows(spark, folder), event_ms())
    scored = al.to_ml_alerts(_scored_by_rules(spark, folder), F.col("event_time"))
    at = {"event_time": F.timestamp_millis("timestamp")}
    for step, again in ((0, False), (1, False), (1, True), (2, False)):
        views.arriving(spark, rule.withColumns(at), f"{path}/rule", step)
        if not again:
            views.arriving(spark, scored.withColumn("event_time", F.col("timestamp")), f"{path}/ml", step)
        streams = [
            spark.readStream.schema(rows.schema).parquet(f"{path}/{name}") for name, rows in (("rule", rule), ("ml", scored))
        ]
        jobs.fan_out(state.merge_live_alerts(*streams), [jobs.parquet_sink(f"{path}/rows")], f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("batch")


@query
def stream_messages(spark, folder):
    """Alerts as messages of which the last batch is sent twice, read once."""
    path = run_dir(spark, "messages")
    flows = views.timed_flows(spark, folder)
    sink = state.message_files(f"{path}/topic", "alerts")
    _in_thirds(spark, flows, path, lambda stream: jobs.fan_out(al.to_alerts(stream, event_ms()), [sink], f"{path}/checkpoint"))
    sink(al.to_alerts(flows.filter(F.unix_seconds("event_time") >= F.lit(1704067200 + 180)), event_ms()), 2)
    told = state.told_once(spark.read.schema("key string, value string").json(f"{path}/topic"))
    parts = {"flowId": "int", "attackType": "string", "timestamp": "long", "message": "string", "pqcEnabled": "boolean"}
    return told.select(*[F.get_json_object("value", f"$.{n}").cast(t).alias(n) for n, t in parts.items()])


@query
def stream_ml_alerts(spark, folder):
    path = run_dir(spark, "scored")
    trained = ml.train(_training_rows(spark, folder))
    rows = jobs.score_messages(views.message_stream(spark, folder), trained.model)
    jobs.replay(rows, path)
    return spark.read.parquet(f"{path}/rows").drop("timestamp", "batch")


# ---- series models -----------------------------------------------------------


@query
def naive_error(spark, folder):
    rows = lagged(views.frame(spark, folder), {"total": 1})
    errors = compare.forecast_error(test_rows(rows), "total", "total_1", ["series_id"])
    return rounded(errors, {"rmse": 8, "mae": 8})


@query
def ar1_ols(spark, folder):
    return rounded(ols.ar1_fit(views.frame(spark, folder)), {"slope": 8, "intercept": 8})


@query
def arch1_ols(spark, folder):
    return rounded(ols.arch1_fit(views.frame(spark, folder)), {"slope": 8, "intercept": 8})


@query
def var1_ols(spark, folder):
    rows = fit_var(views.frame(spark, folder), order=1)
    names = ["const_tx", "const_rx", "tx_from_tx", "rx_from_tx", "tx_from_rx", "rx_from_rx"]
    found = [F.round(F.element_at("params", i + 1), 7).alias(n) for i, n in enumerate(names)]
    return rows.select("series_id", "nobs", *found, *[F.round(c, 5).alias(c) for c in ("llf", "aic", "bic")])


@query
def forecast_anomalies(spark, folder):
    frame = _frame(spark, folder)
    rows = above_forecast(ols.one_step(frame, ols.ar1_fit(frame)), "total", "yhat", F.col("sigma"), 2.0)
    return rounded(rows, {"yhat": 7, "sigma": 7}).select("series_id", "time_bucket", "total", "yhat", "sigma", "is_anomaly")


@query
def variance_anomalies(spark, folder):
    frame = _frame(spark, folder)
    rows = variance_shock(ols.arch1_variance(frame, ols.arch1_fit(frame)), k=4.0)
    return rounded(rows, {"r": 7, "variance": 7}).select("series_id", "time_bucket", "r", "variance", "is_shock")


@query
def variance_run(spark, folder):
    """Conditional variance with given coefficients, over training and test rows."""
    frame = views.frame(spark, folder)
    given = train_rows(frame).groupBy("series_id").agg(
        F.array(F.avg("total"), F.var_pop("total") * F.lit(0.1), F.lit(0.1), F.lit(0.8)).alias("params")
    )
    return rounded(variance_path(frame, given), {"r": 7, "variance": 7})


@query
def garch_shocks(spark, folder):
    frame = _frame(spark, folder)
    path = variance_path(frame, fit_garch(frame).filter("converged"))
    return variance_shock(path, k=4.0)


@query
def arima_anomalies(spark, folder):
    frame = _frame(spark, folder)
    models = fit_arima(frame)
    rows = compare.actual_and_forecast(models, frame)
    spread = models.select("series_id", "model", F.sqrt(F.element_at("params", -1)).alias("sigma"))
    return above_forecast(rows.join(spread, ["series_id", "model"]), "y", "yhat", F.col("sigma"))


@query
def forecasts(spark, folder):
    frame = _frame(spark, folder)
    return forecast(fit_arima(frame).unionByName(fit_var(frame)), frame)


@query
def model_table(spark, folder):
    frame = _frame(spark, folder)
    models = compare.fit_models(frame)
    return compare.model_table(models, compare.actual_and_forecast(models, frame))


@query
def model_rank(spark, folder):
    return compare.rank_models(model_table(spark, folder))


@query
def model_plot_rows(spark, folder):
    frame = _frame(spark, folder)
    models = compare.fit_models(frame, ["ARMA(1,1)", "ARIMA(1,1,1)", "SARIMA", "VAR"])
    return compare.plot_rows(compare.actual_and_forecast(models, frame), frame)


@query
def label_index(spark, folder):
    """Labels in the order of their index."""
    labels = ml.index_labels(_training_rows(spark, folder)).labels
    return spark.createDataFrame(list(enumerate(labels)), "label_index int, label string")


@query
def arma_forecast(spark, folder):
    """Sum of squares, last residual and forecasts of an ARMA with given coefficients."""
    frame = _frame(spark, folder)
    given = train_rows(frame).groupBy("series_id").agg(F.avg("total").alias("mean"), F.max_by("total", "idx").alias("last"))
    points = given.select("series_id", F.array(F.lit(0.5), F.lit(-0.9), F.lit(0.0)).alias("p"), "mean")
    # one round evaluates the starting point
    run = recursion.least_squares(frame, "total", ["series_id"], points, False, 0, rounds=1)
    ahead = F.lit(0.5) * (F.col("last") - F.col("mean")) + F.lit(-0.9) * F.col("last_e")
    state = F.array(F.col("mean") + ahead, ahead, F.lit(1.0))
    zero, one, phi = F.lit(0.0), F.lit(1.0), F.lit(0.5)
    matrix = F.array(zero, phi, F.col("mean"), zero, phi, zero, zero, zero, one)
    models = given.join(run, "series_id").select("series_id", F.lit("ARMA(1,1)").alias("model"), state.alias("state"), matrix.alias("matrix"), "squares", "last_e")
    rows = forecast(models, frame).join(models.select("series_id", "squares", "last_e"), "series_id")
    return rounded(rows, {"yhat": 6, "squares": 4, "last_e": 6}).select("series_id", "model", "step", "yhat", "squares", "last_e")


@query
def given_rank(spark, folder):
    """Ranks of given criteria, ties and missing errors among them."""
    sums = views.frame(spark, folder).groupBy("series_id").agg(F.round(F.avg("tx"), 3).alias("tx"), F.round(F.avg("rx"), 3).alias("rx"))
    given = [("ARMA(1,1)", "tx", "rx"), ("ARIMA(1,1,1)", "rx", "tx"), ("SARIMA", "rx", "tx"), ("VAR", "tx", "tx"), ("GARCH(1,1)", None, "rx")]
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), (F.col(r) if r else F.lit(None).cast("double")).alias("rmse"), F.col(a).alias("aic")) for m, r, a in given]))
    table = sums.select("series_id", rows.alias("m")).select("series_id", "m.*")
    return compare.rank_models(table)


@query
def naive_plot_rows(spark, folder):
    """Plot rows of the last training value as forecast."""
    frame = views.frame(spark, folder)
    last = train_rows(frame).groupBy("series_id").agg(F.max_by("total", "idx").alias("yhat"))
    compared = test_rows(frame).join(last, "series_id").select("series_id", "step", F.lit("naive").alias("model"), "yhat")
    return compare.plot_rows(compared, frame)
