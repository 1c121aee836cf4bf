"""The engine's inputs (packets, flows, counters, series) read from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.operators.forest import NODES, NodeForest
from fluxwatch.operators.timeseries.frame import series_frame
from fluxwatch.schemas import FLOW
from fluxwatch.sources.readers import read_table_stream


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _offset_us() -> Column:
    """Microseconds since 2024-01-01, whatever the session time zone."""
    start = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'").cast("timestamp")
    return F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(start)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _by_class(label: Column, flood, burst, stealth, normal) -> Column:
    return (
        F.when(label == 0, F.lit(flood))
        .when(label == 1, F.lit(burst))
        .when(label == 2, F.lit(stealth))
        .otherwise(F.lit(normal))
    )


def packets(spark: SparkSession, folder: str) -> DataFrame:
    """Packet log from ``events``: a flow per user."""
    user, kind = F.col("user_id"), F.col("user_id") % 5
    return table(spark, folder, "events").select(
        (F.col("event_id") % 4).alias("run_id"),
        (user % 50 + _offset_us() / _by_class(kind, 2e14, 3e13, 1e11, 2e13)).alias("timestamp_s"),
        user.alias("flow_id"),
        F.concat(F.lit("10.1."), user % 200, F.lit(".1")).alias("src_ip"),
        F.concat(F.lit("10.2."), user % 200, F.lit(".2")).alias("dst_ip"),
        (9000 + user).cast("int").alias("port"),
        (_by_class(kind, 1024, 1400, 64, 512) + _k() % 8).cast("long").alias("packet_size_bytes"),
        F.when(F.col("event_type").isin("click", "view", "purchase"), "tx").otherwise("rx").alias("direction"),
        _by_class(kind, "FLOOD", "BURST", "STEALTH", "Normal").alias("attack_type"),
        (user % 2 == 0).alias("pqc_enabled"),
        (F.lit(0.1) + user / F.lit(1000.0)).alias("kem_handshake_ms"),
        (F.lit(0.2) + user / F.lit(500.0)).alias("sig_sign_ms"),
        (F.lit(0.05) + user / F.lit(2000.0)).alias("sig_verify_ms"),
    )


def bulk_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Flow records without time, from ``lineitem``."""
    quantity = F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("int").alias("flow_id"),
        F.concat(F.lit("10.1."), F.col("l_suppkey") % 200, F.lit(".1")).alias("src_ip"),
        F.concat(F.lit("10.2."), F.col("l_partkey") % 200, F.lit(".2")).alias("dst_ip"),
        (9000 + F.col("l_orderkey") % 200).cast("int").alias("dst_port"),
        (F.col("l_extendedprice") * quantity * quantity / F.lit(50.0)).alias("flow_bytes_s"),
        (quantity * F.lit(90.0)).alias("flow_packets_s"),
        F.col("l_discount").alias("flow_iat_mean"),
        F.col("l_tax").alias("flow_iat_std"),
        (F.lit(40.0) + quantity * F.lit(20.0)).alias("fwd_pkt_len_mean"),
        (F.col("l_linenumber") % 2 == 0).alias("pqc_enabled"),
        (F.lit(0.1) + F.col("l_linenumber") / F.lit(8.0)).alias("kem_handshake_ms"),
        (F.lit(0.2) + F.col("l_linenumber") / F.lit(4.0)).alias("sig_sign_ms"),
        F.col("l_linestatus").alias("status"),
    )


def _timed(events: DataFrame) -> DataFrame:
    k, value = F.col("__k"), F.col("value")
    micros = F.floor(_offset_us() / F.lit(10000.0)).cast("long")
    return events.withColumn("__k", _k()).select(
        F.col("event_id").cast("int").alias("flow_id"),
        F.concat(F.lit("10.1."), F.col("user_id") % 200, F.lit(".1")).alias("src_ip"),
        F.concat(F.lit("10.2."), F.col("event_id") % 200, F.lit(".2")).alias("dst_ip"),
        F.col("user_id").cast("int").alias("src_port"),
        (9000 + F.col("user_id") % 100).cast("int").alias("dst_port"),
        F.timestamp_micros(F.lit(1704067200000000) + micros).alias("event_time"),
        (value * value * F.lit(100.0)).alias("flow_bytes_s"),
        (k * F.lit(50.0)).alias("flow_packets_s"),
        (F.lit(1.0) + F.col("user_id") % 7).alias("flow_iat_mean"),
        (F.col("event_id") % 5 * F.lit(0.5)).alias("flow_iat_std"),
        (F.lit(40.0) + k * F.lit(10.0)).alias("fwd_pkt_len_mean"),
        (k % 2 == 0).alias("pqc_enabled"),
        (F.lit(0.1) + k / F.lit(1000.0)).alias("kem_handshake_ms"),
        (F.lit(0.2) + k / F.lit(500.0)).alias("sig_sign_ms"),
    )


def timed_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Flow records with an event time, from ``events``; a month becomes 260 seconds."""
    return _timed(table(spark, folder, "events"))


def _messages(flows: DataFrame) -> DataFrame:
    """Flows as topic messages. Every tenth is cut off and every tenth from the
    third on lacks its rate and has a key the schema does not know."""
    names = [c for c in FLOW.names if c in flows.columns]
    part = F.col("flow_id") % 10
    whole = F.to_json(F.struct(*names))
    odd = F.to_json(F.struct(*[c for c in names if c != "flow_bytes_s"], F.lit("x").alias("vendor")))
    text = F.when(part == 0, F.substring(whole, 1, 9)).when(part == 3, odd).otherwise(whole)
    return flows.select(text.alias("value"), "event_time")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return _messages(timed_flows(spark, folder))


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same messages as a stream over the table's file."""
    schema = table(spark, folder, "events").schema
    return _messages(_timed(read_table_stream(spark, folder, "events", schema)))


def flow_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return _timed(read_table_stream(spark, folder, "events", schema))


def arriving(spark: SparkSession, rows: DataFrame, path: str, step: int) -> None:
    """Appends the ``step``-th (0, 1, 2) third of the rows, by event time, to a folder that a stream reads."""
    second = F.unix_seconds("event_time") - F.lit(1704067200)
    third = F.when(second < 90, 0).when(second < 180, 1).otherwise(2)
    rows.filter(third == step).write.mode("append").parquet(path)


def series(spark: SparkSession, folder: str) -> DataFrame:
    """Two-hourly sent and received volume per event type, from ``events``."""
    volume = F.floor(F.lit(1000.0) + F.col("value")).cast("long")
    even = F.col("user_id") % 2 == 0
    sums = table(spark, folder, "events").groupBy(
        F.col("event_type").alias("series_id"),
        F.floor(_offset_us() / F.lit(7200000000.0)).cast("long").alias("time_bucket"),
    ).agg(
        F.coalesce(F.sum(F.when(even, volume)), F.lit(0).cast("long")).alias("tx_bytes_per_sec"),
        F.coalesce(F.sum(F.when(~even, volume)), F.lit(0).cast("long")).alias("rx_bytes_per_sec"),
    )
    total = F.col("tx_bytes_per_sec") + F.col("rx_bytes_per_sec")
    return sums.withColumn("total_bytes_per_sec", total)


def frame(spark: SparkSession, folder: str) -> DataFrame:
    """The series in thousands of bytes, with positions and the chronological split."""
    scale = F.lit(1000.0)
    rows = series(spark, folder).select(
        "series_id",
        "time_bucket",
        (F.col("tx_bytes_per_sec") / scale).alias("tx"),
        (F.col("rx_bytes_per_sec") / scale).alias("rx"),
        (F.col("total_bytes_per_sec") / scale).alias("total"),
    )
    return series_frame(rows)


# A small forest: tree, node, feature (its position in FEATURES, -1 at a leaf), threshold, left, right and
# the training weight per class of FOREST_LABELS.
FOREST_LABELS = ["Normal", "FLOOD", "BURST", "STEALTH"]
FOREST_NODES = [
    (0, 0, 8, 295.5, 1, 2, [50.0, 30.0, 30.0, 14.0]),
    (0, 1, -1, None, -1, -1, [2.0, 0.0, 0.0, 14.0]),
    (0, 2, 8, 700.5, 3, 4, [48.0, 30.0, 30.0, 0.0]),
    (0, 3, 1, 40.5, 5, 6, [48.0, 6.0, 0.0, 0.0]),
    (0, 4, -1, None, -1, -1, [1.0, 24.0, 30.0, 0.0]),
    (0, 5, -1, None, -1, -1, [45.0, 0.0, 0.0, 0.0]),
    (0, 6, -1, None, -1, -1, [3.0, 6.0, 0.0, 0.0]),
    (1, 0, 6, 1200.5, 1, 2, [50.0, 30.0, 30.0, 14.0]),
    (1, 1, 6, 100.5, 3, 4, [50.0, 30.0, 0.0, 14.0]),
    (1, 2, -1, None, -1, -1, [0.0, 2.0, 30.0, 0.0]),
    (1, 3, -1, None, -1, -1, [0.0, 0.0, 0.0, 14.0]),
    (1, 4, 6, 700.5, 5, 6, [50.0, 30.0, 0.0, 0.0]),
    (1, 5, -1, None, -1, -1, [50.0, 1.0, 0.0, 0.0]),
    (1, 6, -1, None, -1, -1, [0.0, 29.0, 0.0, 0.0]),
    (2, 0, 1, 66.5, 1, 2, [50.0, 30.0, 30.0, 14.0]),
    (2, 1, -1, None, -1, -1, [25.0, 10.0, 10.0, 7.0]),
    (2, 2, -1, None, -1, -1, [25.0, 20.0, 20.0, 7.0]),
]


def stored_forest(spark: SparkSession) -> NodeForest:
    """The small forest, by way of its node table."""
    return NodeForest.of(spark.createDataFrame(FOREST_NODES, NODES), FOREST_LABELS)


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """Raw per-flow counters from ``lineitem``."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") * 3).cast("long").alias("tx_packets"),
        (F.col("l_quantity") * 2 - 2).cast("long").alias("rx_packets"),
        (F.col("l_extendedprice") * F.lit(3.0)).alias("tx_bytes"),
        (F.col("l_extendedprice") * F.lit(2.0)).alias("rx_bytes"),
        (F.col("l_tax") * F.lit(100.0)).alias("duration_s"),
        F.col("l_discount").alias("delay_sum_s"),
    )


def port_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Label and timings per port, without every tenth port."""
    return (
        packets(spark, folder)
        .filter(F.col("flow_id") % 10 != 9)
        .select(
            F.col("port").alias("dst_port"), "attack_type",
            F.col("kem_handshake_ms").alias("meta_kem_ms"), F.col("sig_sign_ms").alias("meta_sign_ms"),
        )
        .distinct()
    )
