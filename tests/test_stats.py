import numpy as np
import pytest
from pyspark.sql import functions as F

from fluxwatch.operators import history, stats
from fluxwatch.operators.alerts import normalize_alerts, severity_filter, to_alerts, to_topic_rows
from fluxwatch.operators.bandwidth import bandwidth_series
from fluxwatch.operators.counters import attach_metadata, flow_metrics_from_counters
from fluxwatch.operators.ml import classification_metrics

FLOWS = (
    "flow_id int, t double, flow_bytes_s double, flow_packets_s double, flow_iat_mean double, flow_iat_std double, "
    "fwd_pkt_len_mean double, kem_handshake_ms double, sig_sign_ms double, part int"
)


def flows(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    rows = [
        (
            i, float(rng.uniform(0, 100)), float(10 ** rng.uniform(2, 7.5)), float(10 ** rng.uniform(1, 4)),
            1.0, float(rng.uniform(0, 1)), float(rng.uniform(50, 150)), 0.5, 0.25, int(rng.integers(0, 7)),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, FLOWS)


def test_merging_parts_equals_the_whole(spark):
    rows = flows(spark)
    whole = stats.flow_stats(rows).first().asDict()
    merged = stats.merge_stats(stats.flow_stats(rows, ["part"])).first().asDict()
    for name, value in whole.items():
        if isinstance(value, float):
            assert merged[name] == pytest.approx(value, rel=1e-12), name
        else:
            assert merged[name] == value, name


def test_no_rows_give_zeros(spark):
    empty = flows(spark).filter("flow_id < 0")
    for row in (stats.flow_stats(empty).first(), stats.merge_stats(stats.flow_stats(empty, ["part"])).first()):
        assert row["totalFlows"] == 0 and row["attackRate"] == 0.0 and row["maxBytesPerSec"] == 0.0
        assert row["avgBytesPerSec"] == 0.0 and row["attackTypes"] == {}


@pytest.mark.parametrize("rows_per_slice", [2_000_000, 25, 3])
def test_running_rates_match_brute_force(spark, rows_per_slice):
    rows = flows(spark)
    found = stats.running_rates(rows, "t", by=["part"], tie=["flow_id"], rows_per_slice=rows_per_slice)
    got = found.toPandas().sort_values("flow_id")
    df = rows.toPandas().sort_values(["part", "t", "flow_id"])
    df["n"] = df.groupby("part").cumcount() + 1
    df["avg"] = df.groupby("part").flow_bytes_s.cumsum() / df["n"]
    df = df.sort_values("flow_id")
    assert list(got.flow_count) == list(df["n"])
    np.testing.assert_allclose(got.avg_bytes_s, df["avg"], rtol=1e-12)


def test_slices_are_balanced_in_a_burst(spark):
    """A third of all rows falls into one instant's neighbourhood."""
    rng = np.random.default_rng(3)
    t = np.r_[rng.uniform(0, 1000, 2000), 500 + rng.uniform(0, 0.001, 1000)]
    rows = spark.createDataFrame([(float(x),) for x in t], "t double")
    sizes = [r["count"] for r in stats.time_slices(rows, "t", 100).groupBy("__slice").count().collect()]
    assert max(sizes) < 250 and sum(sizes) == 3000


def test_bandwidth_missing_direction(spark):
    rows = spark.createDataFrame([(-0.5, "tx", 5), (0.2, "tx", 7), (3.9, "tx", 1)], "timestamp_s double, direction string, packet_size_bytes long")
    got = {r["time_bucket"]: tuple(r)[1:] for r in bandwidth_series(rows).collect()}
    assert got == {0: (12, 0, 12), 3: (1, 0, 1)}
    strict = bandwidth_series(rows, strict_columns=True)
    assert strict.columns == ["time_bucket", "tx"]
    both = rows.withColumn("direction", F.when(F.col("timestamp_s") > 3, "rx").otherwise("tx"))
    assert bandwidth_series(both, strict_columns=True).columns[1:] == ["tx_bytes_per_sec", "rx_bytes_per_sec", "total_bytes_per_sec"]


@pytest.mark.parametrize("cuts", [1, 7])
def test_bandwidth_does_not_depend_on_partitioning(spark, cuts):
    rows = spark.createDataFrame(
        [(i * 0.01, "tx" if i % 3 else "rx", i) for i in range(500)], "timestamp_s double, direction string, packet_size_bytes long"
    )
    a = sorted(map(tuple, bandwidth_series(rows.repartition(cuts)).collect()))
    assert a == sorted(map(tuple, bandwidth_series(rows).collect()))


def test_alert_message_and_columns(spark):
    row = spark.createDataFrame(
        [(1, "10.0.0.1", "10.0.0.2", 2_500_000.5, 10.0, 0.0, 0.0, 0.0, True, 0.5)],
        "flow_id int, src_ip string, dst_ip string, flow_bytes_s double, flow_packets_s double, flow_iat_mean double, "
        "flow_iat_std double, fwd_pkt_len_mean double, pqc_enabled boolean, kem_handshake_ms double",
    )
    alert = to_alerts(row, F.lit(5).cast("long"))
    assert alert.columns == [
        "flowId", "attackType", "timestamp", "severity", "srcIp", "dstIp", "flowBytesPerSec",
        "flowPacketsPerSec", "pqcEnabled", "kemHandshakeMs", "message",
    ]
    assert alert.first()["message"] == "FLOOD attack detected from 10.0.0.1→10.0.0.2! Severity: MEDIUM, Bytes/s: 2500001, PQC: ON"


def test_normalising_both_spellings(spark):
    now = F.lit(9).cast("long")
    camel = spark.createDataFrame(
        [(1, "FLOOD", 1704067200123, "", "a", None, 0.0)],
        "flowId int, attackType string, timestamp long, severity string, srcIp string, dstIp string, flowBytesPerSec double",
    )
    snake = spark.createDataFrame(
        [(2, "", "2024-01-01T00:00:00.123Z", "b", 7.0, True, "spark-ml"), (3, None, "", None, None, None, None)],
        "flow_id long, attack_type string, classified_at string, src_ip string, bytes_per_sec double, pqc_enabled boolean, source string",
    )
    a = normalize_alerts(camel, now).first()
    assert (a["severity"], a["attack_type"], a["src_ip"], a["dst_ip"]) == ("LOW", "FLOOD", "a", "?")
    assert a["timestamp_ms"] == 1704067200123 and a["bytes_per_sec"] == 0.0 and not a["is_ml"]
    b, c = normalize_alerts(snake, now).orderBy("flow_id").collect()
    assert (b["attack_type"], b["timestamp_ms"], b["bytes_per_sec"], b["pqc_enabled"], b["is_ml"]) == ("Unknown", 1704067200123, 7.0, True, True)
    assert (c["timestamp_ms"], c["pqc_enabled"], c["is_ml"]) == (9, False, False)


def test_severity_filter_and_counter(spark):
    rows = spark.createDataFrame([("LOW",), ("HIGH",), ("LOW",)], "severity string")
    assert severity_filter(rows).count() == 3 and severity_filter(rows, "LOW").count() == 2


def test_topic_rows_without_id(spark):
    rows = spark.createDataFrame([(1, 2), (None, 3)], "flow_id int, x int")
    assert [r["key"] for r in to_topic_rows(rows).collect()] == ["1", "unknown"]
    assert to_topic_rows(rows.select("x")).first()["key"] == "unknown"


def test_counters(spark):
    spec = "tx_packets long, rx_packets long, tx_bytes long, rx_bytes long, duration_s double, delay_sum_s double"
    rows = spark.createDataFrame([(10, 5, 1000, 500, 2.0, 0.5), (0, 1, 0, 50, 0.0, 0.5)], spec)
    a, b = flow_metrics_from_counters(rows).collect()
    assert (a["flow_bytes_s"], a["flow_packets_s"], a["flow_iat_mean"]) == (250.0, 7.5, 500.0)
    assert a["flow_iat_max"] == 200.0 and a["flow_iat_min"] == 250.0 and a["flow_iat_std"] == 150.0
    assert (a["fwd_pkt_len_mean"], a["fwd_pkt_len_max"]) == (100.0, 120.0)
    assert (b["flow_duration"], b["flow_bytes_s"]) == (0.001, 50000.0)
    assert b["flow_iat_mean"] == 0.0 and b["flow_iat_max"] == 0.0 and b["fwd_pkt_len_mean"] == 0.0


@pytest.mark.parametrize("max_rows", [2_000_000, 10])
def test_metadata_defaults_to_normal(spark, max_rows):
    left = spark.createDataFrame([(1, 5), (2, 5), (3, 9)] + [(i, 5) for i in range(4, 59)] + [(59, None)], "id int, port int")
    meta = spark.createDataFrame([(5, "FLOOD", 0.5)], "port int, attack_type string, kem double")
    got = attach_metadata(left, meta, ["port"], max_rows=max_rows).toPandas()
    assert len(got) == 59 and sorted(got.id) == list(range(1, 60))
    assert set(got[got.port == 5].attack_type) == {"FLOOD"} and set(got[got.port != 5].attack_type) == {"Normal"}


def test_latest_and_ranking(spark):
    rows = spark.createDataFrame([(i, i // 2) for i in range(300)], "id int, t int")
    newest = [r["id"] for r in history.latest(rows, "t", 5, ["id"]).collect()]
    assert newest == [299, 298, 297, 296, 295]
    assert [r["id"] for r in history.chart_points(rows, "t", 3, ["id"]).collect()] == [297, 298, 299]
    ranks = spark.createDataFrame([("a_b", 0.1), ("c", 0.7)], "feature string, importance double")
    assert [r["feature"] for r in history.display_features(ranks).collect()] == ["c", "a b"]


def test_metrics_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = np.random.default_rng(2)
    # class 4 is never predicted and class 5 never right
    rows = [(float(a), float(b)) for a, b in zip(rng.integers(0, 5, 400), rng.integers(0, 4, 400))] + [(0.0, 5.0)] * 9
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = classification_metrics(stats.confusion(df, "label", "prediction"), "label", "prediction").first()
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for ours, theirs in {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}.items():
        assert found[ours] == pytest.approx(judge.setMetricName(theirs).evaluate(df), rel=1e-12)


def test_observed_counts_without_a_job(spark):
    rows, seen = stats.observed(spark.range(37), "rows_seen")
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 37


def test_distribution_order(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",)], "attack_type string")
    assert [tuple(r) for r in stats.class_distribution(rows).collect()] == [("b", 2), ("a", 1)]
