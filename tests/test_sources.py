import json

import pytest
from pyspark.sql import functions as F

from fluxwatch.operators import ml
from fluxwatch.operators.alerts import as_json
from fluxwatch.schemas import FEATURES, FLOW, FLOW_DEFAULTS, LABELLED_FLOW, PACKET, TRAINING_NAMES
from fluxwatch.sources import readers, writers
from fluxwatch.sources.decode import decode_flows, to_training_names

HEADER = ",".join(PACKET.names)
LINES = [
    "0.000100,0,10.1.1.1,10.1.2.2,9000,1024,tx,FLOOD,1,0.5,0.2,0.1",
    "0.200000,0,10.1.1.1,10.1.2.2,9000,1024,rx,FLOOD,1,0.5,0.2,0.1",
    "1.500000,1,10.1.3.1,10.1.4.2,9001,512,tx,Normal,0,0.5,0.2,0.1",
]


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


GOOD = json.dumps({"flow_id": 7, "flow_bytes_s": 3.5, "pqc_enabled": True, "vendor": "x"})
BAD = ["{bad", "[1]", None, "", "7", json.dumps({"flow_id": "x"}), json.dumps({"flow_id": 1e12}), json.dumps({"flow_bytes_s": []})]


def test_strict_drops_what_does_not_decode(spark):
    rows = decode_flows(messages(spark, [GOOD, *BAD])).collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    assert row == {**FLOW_DEFAULTS, "flow_id": 7, "flow_bytes_s": 3.5, "pqc_enabled": True}


def test_strict_converts_numbers(spark):
    given = [{"flow_id": "12", "flow_bytes_s": "2.5"}, {"flow_id": 3.0}, {"flow_id": 3.7, "total_fwd_packets": None}]
    messages = spark.createDataFrame([(json.dumps(g),) for g in given], "value string")
    found = [(r["flow_id"], r["flow_bytes_s"], r["total_fwd_packets"]) for r in decode_flows(messages).collect()]
    assert found == [(12, 2.5, 0), (3, 0.0, 0), (3, 0.0, 0)]


def test_an_empty_object_is_all_defaults(spark):
    assert decode_flows(messages(spark, ["{}"])).first().asDict() == FLOW_DEFAULTS


def test_permissive_keeps_every_message(spark):
    rows = decode_flows(messages(spark, [GOOD, "{bad", None]), "permissive").collect()
    assert len(rows) == 3
    broken = sorted(rows, key=lambda r: r["flow_id"])[0]
    assert broken["flow_bytes_s"] == 0.0 and broken["flow_id"] == 0
    assert broken["src_ip"] is None and broken["pqc_enabled"] is None


def test_bytes_and_carried_columns(spark):
    df = messages(spark, [GOOD]).withColumn("at", F.lit(5)).withColumn("value", F.col("value").cast("binary"))
    assert decode_flows(df, keep=["at"]).first()["at"] == 5
    with pytest.raises(ValueError):
        decode_flows(df, "loose")


def test_each_message_is_parsed_once(spark):
    """The parser must not be copied into later filters and projections."""
    from fluxwatch.operators.alerts import to_alerts

    plan = to_alerts(decode_flows(messages(spark, [GOOD])))._jdf.queryExecution().optimizedPlan().toString()
    # the second one is for records that hold a number of another type
    assert plan.count("from_json") == 2 and plan.count("CASE WHEN isnotnull(_corrupt_record") == 1


def test_training_names(spark):
    named = to_training_names(decode_flows(messages(spark, [GOOD])), TRAINING_NAMES)
    assert set(FEATURES) <= set(named.columns) and len(TRAINING_NAMES) == 15


def test_packet_csv_and_parquet(spark, tmp_path):
    (tmp_path / "p.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    rows = readers.read_packets(spark, str(tmp_path / "p.csv"))
    assert rows.count() == 3 and dict(rows.dtypes)["pqc_enabled"] == "boolean"
    for split in (False, True):
        target = str(tmp_path / f"copy{split}.parquet")
        writers.packets_to_parquet(spark, str(tmp_path / "p.csv"), target, split)
        back = readers.read_packets(spark, target).select(*rows.columns)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert (tmp_path / "copyTrue.parquet" / "attack_type=FLOOD").is_dir()


def test_only_needed_csv_columns_are_read(spark, tmp_path):
    from fluxwatch.operators.bandwidth import bandwidth_series

    (tmp_path / "p.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    plan = bandwidth_series(readers.read_packets(spark, str(tmp_path / "p.csv")))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<timestamp_s:double,packet_size_bytes:bigint,direction:string>" in plan


def test_training_format_detection(spark, tmp_path):
    (tmp_path / "packets.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    flows = readers.read_training(spark, str(tmp_path / "packets.csv"))
    assert flows.count() == 2 and "Flow_IAT_Std" in flows.columns
    values = ["1", "a", "b", "1", "2", "2.0", "3", "4"] + ["1.5"] * 10 + ["1", "0.1", "1184", "1088", "0.2", "0.3", "3293", "BURST"]
    (tmp_path / "flows.csv").write_text(",".join(LABELLED_FLOW.names) + "\n" + ",".join(values) + "\n")
    row = readers.read_training(spark, str(tmp_path / "flows.csv")).first()
    assert row["Attack_Type"] == "BURST" and row["PQC_Enabled"] is True and row["SIG_Bytes"] == 3293


def test_runs_are_told_apart(spark, tmp_path):
    for run in (1, 12):
        folder = tmp_path / f"run-{run}"
        folder.mkdir()
        (folder / "packets.csv").write_text("\n".join([HEADER, *LINES[:run]]) + "\n")
    counts = {r["run_id"]: r["count"] for r in readers.read_runs(spark, str(tmp_path)).groupBy("run_id").count().collect()}
    assert counts == {1: 1, 12: 3}


def test_columns_go_by_the_header(spark, tmp_path):
    names = [n for n in PACKET.names if n != "sig_sign_ms"]
    names[0], names[1] = names[1], names[0]
    values = {n: "1" for n in names} | {"timestamp_s": "0.5", "flow_id": "7", "direction": "tx"}
    (tmp_path / "p.csv").write_text(",".join([*names, "extra"]) + "\n" + ",".join([*(values[n] for n in names), "x"]) + "\n")
    row = readers.read_packets(spark, str(tmp_path / "p.csv")).first()
    assert (row["flow_id"], row["timestamp_s"], row["sig_sign_ms"]) == (7, 0.5, None) and "extra" not in row


def test_the_last_run_in_a_path_counts(spark, tmp_path):
    for run in (3, 4):
        folder = tmp_path / "run-2024" / f"run-{run}"
        folder.mkdir(parents=True)
        (folder / "p.csv").write_text(",".join(PACKET.names) + "\n" + ",".join(["1"] * len(PACKET.names)) + "\n")
    assert sorted(r["run_id"] for r in readers.read_runs(spark, str(tmp_path)).collect()) == [3, 4]


def test_training_from_parquet(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 5, "a", "b", 1, 100, "tx", "Normal", True, 0.1, 0.1, 0.1)], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PACKET).replace("pqc_enabled int", "pqc_enabled boolean"))
    rows.write.parquet(str(tmp_path / "p.parquet"))
    assert readers.read_training(spark, str(tmp_path / "p.parquet")).first()["Total_Fwd_Packets"] == 1


def test_flow_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"flow-{i}.json").write_text(json.dumps({"flow_id": i, "flow_bytes_s": 1.5}, indent=2))
    (tmp_path / "other.json").write_text("{}")
    rows = readers.read_flow_files(spark, str(tmp_path))
    assert sorted(r["flow_id"] for r in rows.collect()) == [0, 1, 2] and rows.schema.names == FLOW.names


def test_metrics_round_trip(spark, tmp_path):
    importance = spark.createDataFrame([("a", 0.25), ("b", 0.75)], "feature string, importance double")
    writers.write_metrics(spark, {"accuracy": 0.5, "numTrees": 100}, importance, str(tmp_path))
    metrics, ranks = readers.read_metrics(spark, str(tmp_path))
    assert metrics.first()["accuracy"] == 0.5 and metrics.first()["f1"] is None
    assert [r["feature"] for r in ranks.collect()] == ["b", "a"]
    metrics, ranks = readers.read_metrics(spark, str(tmp_path / "missing"))
    assert metrics.count() == 0 and ranks.count() == 0


def test_csv_sink(spark, tmp_path):
    writers.write_csv(spark.range(5), str(tmp_path / "out"))
    writers.write_csv(spark.range(3), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3


def test_maps_are_written_as_objects(spark):
    row = spark.sql("SELECT map('FLOOD', 2L) AS attackTypes")
    assert json.loads(as_json(row).first()["value"]) == {"attackTypes": {"FLOOD": 2}}


def _labelled(spark, n=240):
    rng = __import__("random").Random(4)
    rows = []
    for i in range(n):
        label = ["Normal", "Normal", "FLOOD", "BURST"][i % 4]
        base = {"Normal": 3e5, "FLOOD": 6e6, "BURST": 1.8e6}[label]
        rows.append((i, *[base * rng.uniform(0.8, 1.2) if c == "Flow_Bytes_s" else rng.random() for c in FEATURES], label))
    return spark.createDataFrame(rows, ", ".join(["flow_id int", *[f"{c} double" for c in FEATURES], "Attack_Type string"]))


def test_forest(spark, tmp_path):
    from fluxwatch.config import ForestConfig

    flows = _labelled(spark)
    trained = ml.train(flows, config=ForestConfig(num_trees=40, max_depth=6))
    assert trained.labels[0] == "Normal" and trained.metrics["accuracy"] > 0.9
    assert trained.importance.orderBy(F.desc("importance")).first()["feature"] == "Flow_Bytes_s"
    assert [r["feature"] for r in trained.importance.collect()] == FEATURES
    writers.save_model(trained.model, str(tmp_path / "m"))
    again = ml.score(readers.load_model(str(tmp_path / "m")), flows)
    direct = ml.score(trained.model, flows)
    pick = ["flow_id", "predicted_attack"]
    assert sorted(map(tuple, again.select(*pick).collect())) == sorted(map(tuple, direct.select(*pick).collect()))
    train, test = ml.split_rows(flows, ["flow_id"])
    assert train.count() + test.count() == 240 and train.intersect(test).count() == 0
    assert sorted(map(tuple, ml.split_rows(flows.repartition(7), ["flow_id"])[0].select("flow_id").collect())) == sorted(map(tuple, train.select("flow_id").collect()))
    with pytest.raises(ValueError):
        ml.check_iat_unit(trained.metrics, "ms")


def test_unseen_label_gets_the_last_index(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "Attack_Type string")
    other = spark.createDataFrame([("zzz",), (None,)], "Attack_Type string")
    model = ml.index_labels(rows)
    assert [r["label"] for r in model.transform(other).collect()] == [2.0, 2.0]
