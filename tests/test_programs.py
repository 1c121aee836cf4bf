"""The jobs from files to files."""

import json

import numpy as np

from fluxwatch.__main__ import arguments
from fluxwatch.plans import programs
from fluxwatch.schemas import PACKET


def write_packets(path, seconds=70):
    rng = np.random.default_rng(3)
    rows = [",".join(PACKET.names)]
    for i in range(1500):
        label = ["Normal", "FLOOD"][i % 2]
        size = 1024 if label == "FLOOD" else int(rng.integers(400, 600))
        rows.append(
            f"{rng.uniform(0, seconds):.6f},{i % 30},10.1.1.1,10.1.2.2,9000,{size},{['tx', 'rx'][int(rng.integers(0, 2))]},{label},1,0.5,0.2,0.1"
        )
    path.write_text("\n".join(rows) + "\n")


def test_train_then_score(spark, tmp_path):
    write_packets(tmp_path / "p.csv")
    metrics = programs.train(spark, str(tmp_path / "p.csv"), str(tmp_path / "out"))
    assert metrics["numTrees"] == 100 and metrics["iatUnit"] == "s"
    assert metrics["rows"] == 30 and 0 < metrics["testRows"] < 30
    flows = tmp_path / "flows"
    flows.mkdir()
    for i in range(5):
        (flows / f"flow-{i}.json").write_text(json.dumps({"flow_id": i, "flow_bytes_s": 3e6}))
    programs.export_flows(spark, str(flows), None, str(tmp_path / "topic"))
    line = spark.read.json(str(tmp_path / "topic")).first()
    assert line["source"] == "ns3-simulator" and line["exported_at"] > 1_600_000_000_000
    programs.score(
        spark, str(tmp_path / "topic"), str(tmp_path / "out" / "rf-model"), str(tmp_path / "s"), trigger=None
    ).awaitTermination()
    assert spark.read.json(str(tmp_path / "s" / "scored")).count() == 5
    for query in programs.detect(spark, str(tmp_path / "topic"), str(tmp_path / "d"), trigger=None):
        query.awaitTermination()
    assert spark.read.json(str(tmp_path / "d" / "alerts")).count() == 5
    seen = spark.read.json(str(tmp_path / "d" / "statistics"))
    assert sum(r["totalFlows"] for r in seen.collect()) == 5


def test_bandwidth_then_models(spark, tmp_path):
    write_packets(tmp_path / "p.csv")
    programs.convert(spark, str(tmp_path / "p.csv"), str(tmp_path / "p.parquet"))
    programs.bandwidth(spark, str(tmp_path / "p.parquet"), str(tmp_path / "bw"))
    table = programs.series_models(spark, str(tmp_path / "bw"), str(tmp_path / "m"), ["ARIMA(1,1,1)", "VAR"])
    rows = table.collect()
    assert len(rows) == 2 and sum(r["winner"] == "true" for r in rows) == 1
    ahead = spark.read.option("header", True).csv(str(tmp_path / "m" / "forecasts"))
    assert ahead.count() == 3 * 14


def test_command_line():
    given = arguments().parse_args(["detect", "folder", "out", "--once"])
    assert (given.job, given.source, given.once, given.topic) == ("detect", "folder", True, None)
