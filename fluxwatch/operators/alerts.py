"""Alert rows: projections of both producers, their union, normalisation, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxwatch.functions.rules import classify_rules, label_severity, only_attacks, rate_severity
from fluxwatch.functions.scalars import instant_ms, present, truthy_number, truthy_text


# The producer names messages carry.
EXPORT_SOURCE, ML_SOURCE = "ns3-simulator", "spark-ml"


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def alert_message() -> Column:
    return F.format_string(
        "%s attack detected from %s→%s! Severity: %s, Bytes/s: %.0f, PQC: %s",
        F.col("attack_type"), F.col("src_ip"), F.col("dst_ip"), F.col("severity"),
        F.col("flow_bytes_s"), F.when(F.col("pqc_enabled"), "ON").otherwise("OFF"),
    )


def to_alerts(flows: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Rule alerts of the attack flows, 11 columns; ``timestamp`` defaults to now."""
    labelled = flows if "attack_type" in flows.columns else classify_rules(flows)
    graded = only_attacks(labelled).withColumn("severity", rate_severity())
    return graded.select(
        F.col("flow_id").alias("flowId"),
        F.col("attack_type").alias("attackType"),
        (now_ms() if timestamp is None else timestamp).alias("timestamp"),
        "severity",
        F.col("src_ip").alias("srcIp"),
        F.col("dst_ip").alias("dstIp"),
        F.col("flow_bytes_s").alias("flowBytesPerSec"),
        F.col("flow_packets_s").alias("flowPacketsPerSec"),
        F.col("pqc_enabled").alias("pqcEnabled"),
        F.col("kem_handshake_ms").alias("kemHandshakeMs"),
        alert_message().alias("message"),
    )


def to_ml_alerts(
    scored: DataFrame,
    timestamp: Column | None = None,
    timestamp_format: str = "iso",
    include_normal: bool = True,
) -> DataFrame:
    """Alerts of model-scored flows, 12 columns; Normal flows are kept as LOW by default."""
    rows = scored if include_normal else only_attacks(scored, "predicted_attack")
    when = F.current_timestamp() if timestamp is None else timestamp
    if timestamp_format == "epoch_ms":
        when = F.unix_millis(when)
    return rows.select(
        F.col("flow_id").alias("flowId"),
        F.col("src_ip").alias("srcIp"),
        F.col("dst_ip").alias("dstIp"),
        F.col("Flow_Bytes_s").alias("flowBytesPerSec"),
        F.col("Flow_Packets_s").alias("flowPacketsPerSec"),
        F.col("predicted_attack").alias("attackType"),
        label_severity("predicted_attack").alias("severity"),
        F.col("pqc_enabled").alias("pqcEnabled"),
        F.col("KEM_Handshake_ms").alias("kemHandshakeMs"),
        F.col("SIG_Sign_ms").alias("sigSignMs"),
        when.alias("timestamp"),
        F.lit(ML_SOURCE).alias("source"),
    )


def as_json(df: DataFrame) -> DataFrame:
    """One ``value`` column holding each row as JSON."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def to_topic_rows(df: DataFrame, key: str = "flow_id") -> DataFrame:
    """Keyed messages: the flow id as text (or ``unknown``) and the row as JSON."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("unknown")) if key in df.columns else F.lit("unknown")
    return df.select(name.alias("key"), F.to_json(F.struct("*")).alias("value"))


def enrich_export(flows: DataFrame, exported_at: Column | None = None, source: str = EXPORT_SOURCE) -> DataFrame:
    """Adds ``exported_at`` (epoch ms) and ``source``."""
    return flows.withColumns(
        {"exported_at": now_ms() if exported_at is None else exported_at, "source": F.lit(source)}
    )


def normalize_alerts(alerts: DataFrame, now: Column | None = None) -> DataFrame:
    """One alert layout from either spelling, with defaults for what is missing.

    Empty text and zero count as missing. Timestamps may be numbers, digits,
    ISO text or timestamps; the result is epoch milliseconds.
    """

    def text(default: str, *names: str) -> Column:
        found = [truthy_text(c) for c in present(alerts, list(names))]
        return F.coalesce(*found, F.lit(default))

    rates = present(alerts, ["flowBytesPerSec", "flowBytesS", "bytes_per_sec"], "double")
    instants = [
        F.nullif(instant_ms(F.col(n), alerts.schema[n].dataType), F.lit(0).cast("long"))
        for n in ("timestamp", "classified_at")
        if n in alerts.columns
    ]
    flow = present(alerts, ["flowId", "flow_id"], "long")
    return alerts.select(
        F.coalesce(*flow).cast("long").alias("flow_id"),
        text("LOW", "severity").alias("severity"),
        text("Unknown", "attackType", "attack_type").alias("attack_type"),
        text("?", "srcIp", "src_ip").alias("src_ip"),
        text("?", "dstIp", "dst_ip").alias("dst_ip"),
        F.coalesce(*[truthy_number(c) for c in rates], F.lit(0.0)).alias("bytes_per_sec"),
        F.coalesce(*present(alerts, ["pqcEnabled", "pqc_enabled"], "boolean"), F.lit(False)).alias(
            "pqc_enabled"
        ),
        F.coalesce(*instants, now_ms() if now is None else now).alias("timestamp_ms"),
        F.coalesce(*present(alerts, ["source"]), F.lit("")).eqNullSafe(F.lit(ML_SOURCE)).alias("is_ml"),
    )


def merge_alert_streams(rule: DataFrame, ml: DataFrame, now: Column | None = None) -> DataFrame:
    """Both producers' alerts in one normalised layout."""
    return normalize_alerts(rule, now).unionByName(normalize_alerts(ml, now))


def severity_filter(alerts: DataFrame, level: str = "all") -> DataFrame:
    """Alerts of one severity, or all of them."""
    return alerts if level == "all" else alerts.filter(F.col("severity") == level)


def severity_counts(alerts: DataFrame) -> DataFrame:
    """The alert counter: everything received, whatever is shown, plus the split by severity."""
    return alerts.groupBy("severity").count()
