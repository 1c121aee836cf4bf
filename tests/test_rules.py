import pytest

from fluxwatch.functions.rules import classify_rules, label_from_code, severity_by_label, severity_by_rate
from pyspark.sql import functions as F

NAN = float("nan")


def flow(spark, **given):
    row = dict(
        flow_bytes_s=0.0, flow_packets_s=0.0, flow_iat_mean=0.0, flow_iat_std=0.0, fwd_pkt_len_mean=0.0
    )
    row.update(given)
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" for c in row))


@pytest.mark.parametrize(
    "given, expected",
    [
        (dict(flow_bytes_s=2_000_000.0, flow_packets_s=4_000.0), "Normal"),
        (dict(flow_bytes_s=2_000_000.5), "FLOOD"),
        (dict(flow_packets_s=4_000.5), "FLOOD"),
        (dict(flow_bytes_s=600_000.0, flow_iat_mean=10.0, flow_iat_std=3.0), "Normal"),
        (dict(flow_bytes_s=600_000.0, flow_iat_mean=10.0, flow_iat_std=3.1), "BURST"),
        (dict(flow_bytes_s=500_000.0, flow_iat_mean=10.0, flow_iat_std=9.0), "Normal"),
        (dict(flow_bytes_s=3e6, flow_iat_mean=10.0, flow_iat_std=9.0), "FLOOD"),
        (dict(flow_bytes_s=4_999.0, flow_packets_s=99.0, fwd_pkt_len_mean=99.9), "STEALTH"),
        (dict(flow_bytes_s=5_000.0, flow_packets_s=99.0, fwd_pkt_len_mean=99.9), "Normal"),
        (dict(flow_bytes_s=4_999.0, flow_packets_s=100.0, fwd_pkt_len_mean=99.9), "Normal"),
        (dict(flow_bytes_s=4_999.0, flow_packets_s=99.0, fwd_pkt_len_mean=100.0), "Normal"),
        (dict(), "STEALTH"),
        (dict(flow_bytes_s=NAN), "Normal"),
        (dict(flow_bytes_s=NAN, flow_packets_s=5_000.0), "FLOOD"),
        (dict(flow_bytes_s=600_000.0, flow_iat_mean=10.0, flow_iat_std=NAN), "Normal"),
    ],
)
def test_classes(spark, given, expected):
    assert classify_rules(flow(spark, **given)).first()["attack_type"] == expected


@pytest.mark.parametrize(
    "rate, packets, expected",
    [
        (5e7, 0.0, "HIGH"), (5e7 + 1, 0.0, "CRITICAL"),
        (1e7, 0.0, "MEDIUM"), (1e7 + 1, 0.0, "HIGH"),
        (1e6, 0.0, "LOW"), (1e6 + 1, 0.0, "MEDIUM"),
        (0.0, 50_000.0, "HIGH"), (0.0, 50_001.0, "CRITICAL"),
        (0.0, 20_000.0, "MEDIUM"), (0.0, 20_001.0, "HIGH"),
        (0.0, 5_000.0, "LOW"), (0.0, 5_001.0, "MEDIUM"),
        (NAN, NAN, "LOW"),
    ],
)
def test_rate_severity(spark, rate, packets, expected):
    row = severity_by_rate(flow(spark, flow_bytes_s=rate, flow_packets_s=packets)).first()
    assert row["severity"] == expected


def test_label_severity(spark):
    rows = spark.createDataFrame([("FLOOD",), ("BURST",), ("STEALTH",), ("Normal",), (None,)], "predicted_attack string")
    found = {r[0]: r[1] for r in severity_by_label(rows).collect()}
    assert found == {"FLOOD": "CRITICAL", "BURST": "HIGH", "STEALTH": "MEDIUM", "Normal": "LOW", None: "LOW"}


def test_codes(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (3,), (4,), (None,)], "c int")
    found = [r[0] for r in rows.select(label_from_code(F.col("c"))).collect()]
    assert found == ["Normal", "FLOOD", "STEALTH", "BURST", "Normal", "Normal"]
