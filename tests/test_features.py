import numpy as np
import pandas as pd
import pytest

from fluxwatch.operators.features import flow_features, packet_iat, split_by_size, training_flows

COLUMNS = (
    "timestamp_s double, flow_id long, packet_size_bytes long, direction string, attack_type string, "
    "pqc_enabled boolean, kem_handshake_ms double, sig_sign_ms double, sig_verify_ms double"
)


def packets(spark, rows):
    """(time, flow, size) rows."""
    return spark.createDataFrame(
        [(float(t), f, s, "tx" if i % 2 else "rx", "FLOOD", True, 0.1, 0.2, 0.3) for i, (t, f, s) in enumerate(rows)],
        COLUMNS,
    )


def brute_force(rows):
    df = pd.DataFrame(rows, columns=["t", "f", "s"])
    out = {}
    for f, g in df.groupby("f"):
        g = g.sort_values("t")
        gap = g.t.diff().dropna()
        span = max(g.t.max() - g.t.min(), 0.001)
        out[f] = [
            g.t.max() - g.t.min(), len(g), g.s.sum() / span, len(g) / span,
            gap.mean() if len(gap) else 0.0, gap.std() if len(gap) > 1 else 0.0,
            gap.max() if len(gap) else 0.0, gap.min() if len(gap) else 0.0,
            g.s.mean(), g.s.std() if len(g) > 1 else 0.0, g.s.max(), g.s.min(),
        ]
    return out


NAMES = [
    "Flow_Duration", "Total_Fwd_Packets", "Flow_Bytes_s", "Flow_Packets_s", "Flow_IAT_Mean", "Flow_IAT_Std",
    "Flow_IAT_Max", "Flow_IAT_Min", "Fwd_Pkt_Len_Mean", "Fwd_Pkt_Len_Std", "Fwd_Pkt_Len_Max", "Fwd_Pkt_Len_Min",
]


@pytest.mark.parametrize("max_rows", [4_000_000, 40, 7])
def test_features_match_brute_force_with_and_without_slices(spark, max_rows):
    """One flow holds two thirds of the packets; small limits force it into slices."""
    rng = np.random.default_rng(5)
    rows = [(t, 0, int(s)) for t, s in zip(rng.exponential(0.02, 400).cumsum(), rng.integers(40, 1500, 400))]
    rows += [(t, int(f), int(s)) for t, f, s in zip(rng.uniform(0, 9, 200), rng.integers(1, 9, 200), rng.integers(40, 1500, 200))]
    rows += [(3.0, 50, 100)]
    expected = brute_force(rows)
    found = flow_features(packets(spark, rows), max_rows=max_rows).toPandas().set_index("flow_id")
    assert sorted(found.index) == sorted(expected)
    for f, values in expected.items():
        np.testing.assert_allclose(found.loc[f, NAMES].astype(float), values, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("max_rows", [4_000_000, 10])
def test_iat_per_packet(spark, max_rows):
    rng = np.random.default_rng(6)
    rows = [(t, 0, 10) for t in rng.uniform(0, 5, 120)] + [(t, 1, 10) for t in rng.uniform(0, 5, 5)]
    found = packet_iat(packets(spark, rows), max_rows=max_rows).toPandas()
    assert len(found) == len(rows)
    df = pd.DataFrame(rows, columns=["t", "f", "s"]).sort_values(["f", "t"])
    expected = df.groupby("f").t.diff().to_numpy()
    got = found.sort_values(["flow_id", "timestamp_s"])["iat"]
    np.testing.assert_allclose(got, expected, rtol=1e-12)


def test_single_packet_and_ties(spark):
    found = flow_features(packets(spark, [(1.0, 1, 100), (2.0, 2, 60), (2.0, 2, 80)])).toPandas().set_index("flow_id")
    one = found.loc[1]
    assert one["Flow_Bytes_s"] == 100 / 0.001 and one["Flow_Packets_s"] == 1 / 0.001
    assert [one[c] for c in ("Flow_IAT_Mean", "Flow_IAT_Std", "Flow_IAT_Max", "Fwd_Pkt_Len_Std")] == [0, 0, 0, 0]
    two = found.loc[2]
    assert two["Flow_IAT_Max"] == 0 and two["Flow_Duration"] == 0 and two["Flow_Bytes_s"] == 140 / 0.001


def test_key_list_and_direction(spark):
    rows = packets(spark, [(1.0, 1, 100), (2.0, 1, 60), (3.0, 1, 80), (4.0, 1, 10)])
    by_both = flow_features(rows, key=["flow_id", "direction"])
    assert by_both.count() == 2
    assert flow_features(rows, directions=("tx",)).first()["Total_Fwd_Packets"] == 2


def test_constant_columns_come_from_the_earliest_packet(spark):
    rows = [(2.0, 7, 1, "tx", "BURST", False, 2.0, 2.0, 2.0), (1.0, 7, 1, "rx", "FLOOD", True, 1.0, 1.0, 1.0)]
    row = flow_features(spark.createDataFrame(rows, COLUMNS)).first()
    assert (row["Attack_Type"], row["PQC_Enabled"], row["KEM_Handshake_ms"]) == ("FLOOD", True, 1.0)


def test_format_detection(spark):
    flows = spark.createDataFrame([(1, 2.0)], "Flow_ID int, Flow_Bytes_s double")
    assert training_flows(flows) is flows
    assert "Flow_IAT_Std" in training_flows(packets(spark, [(1.0, 1, 5)])).columns


def _crowd(kind):
    """A flow of 3,000 packets beside small ones, unevenly in time."""
    rng = np.random.default_rng(9)
    times = {
        "one late": [*rng.uniform(0, 1, 2999), 1e7],
        "one instant": [5.0] * 3000,
        "few instants": list(rng.integers(0, 7, 3000).astype(float)),
        "bursts": list(np.concatenate([rng.exponential(1e-6, 2900).cumsum(), rng.uniform(50, 9000, 100)])),
    }[kind]
    rows = [(t, 0, int(s)) for t, s in zip(times, rng.integers(40, 1500, 3000))]
    return rows + [(float(i), 1 + i % 5, 64) for i in range(60)]


@pytest.mark.parametrize("kind", ["one late", "one instant", "few instants", "bursts"])
def test_large_flows_are_cut_by_rows(spark, kind):
    rows, limit = _crowd(kind), 100
    table = packets(spark, rows)
    plain, sliced = split_by_size(table, ["flow_id"], "timestamp_s", limit)
    assert plain.count() == 60 and sliced.count() == 3000
    # what a task orders: instants, not packets
    instants = sliced.select("__slice", "timestamp_s").distinct().groupBy("__slice").count()
    assert instants.agg({"count": "max"}).first()[0] <= 2 * limit
    if kind in ("one late", "bursts"):
        assert sliced.groupBy("__slice").count().agg({"count": "max"}).first()[0] <= 2 * limit
    expected = brute_force(rows)
    found = flow_features(table, max_rows=limit).toPandas().set_index("flow_id")
    for f, values in expected.items():
        np.testing.assert_allclose(found.loc[f, NAMES].astype(float), values, rtol=1e-9, atol=1e-9)
    gaps = packet_iat(table, max_rows=limit).toPandas()
    df = pd.DataFrame(rows, columns=["t", "f", "s"]).sort_values(["f", "t"])
    for f, part in df.groupby("f"):
        got = gaps[gaps.flow_id == f]["iat"]
        assert got.isna().sum() == 1 and len(got) == len(part)
        np.testing.assert_allclose(np.sort(got.dropna()), np.sort(part.t.diff().dropna()), rtol=1e-9, atol=1e-9)


def test_more_cuts_than_a_stride(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(float(t), 0, 100) for t in rng.uniform(0, 1, 2000)]
    sliced = split_by_size(packets(spark, rows), ["flow_id"], "timestamp_s", 10)[1]
    bounds = sliced.groupBy("__slice").agg({"timestamp_s": "min"}).orderBy("__slice").collect()
    times = sorted(t for t, _, _ in rows)
    assert len(bounds) > 150 and [b[1] for b in bounds] == sorted(b[1] for b in bounds) and bounds[0][1] == times[0]


def test_null_flows_and_times(spark):
    rows = [(None, 1, 10), (1.0, 1, 20), (2.5, 1, 30), (1.0, None, 5), (4.0, None, 7), (None, None, 1)] * 5
    table = spark.createDataFrame([(t, f, s, "tx", "FLOOD", True, 0.1, 0.2, 0.3) for t, f, s in rows], COLUMNS)
    whole = flow_features(table).toPandas().sort_values("flow_id").reset_index(drop=True)
    cut = flow_features(table, max_rows=4).toPandas().sort_values("flow_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(whole, cut)
    assert packet_iat(table, max_rows=4).count() == packet_iat(table).count() == 30
