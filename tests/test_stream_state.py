"""What streams carry from batch to batch, with replays."""

import json
import time

import pytest
from pyspark.sql import functions as F

from fluxwatch.config import WindowConfig
from fluxwatch.operators.alerts import merge_alert_streams
from fluxwatch.operators.stats import running_rates
from fluxwatch.sources.decode import decode_flows
from fluxwatch.sources.readers import read_text_stream
from fluxwatch.streaming import jobs, state
from test_streaming import write_messages

TWO = WindowConfig(length="2 seconds")


def _run_arrival(spark, folder, path):
    rows = jobs.stream_flow_stats(decode_flows(read_text_stream(spark, folder, 1)), config=TWO)
    jobs.until_closed(jobs.fan_out(rows, [jobs.parquet_sink(f"{path}/rows")], f"{path}/c", trigger="1 second"), TWO.length)
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")


def test_arrival_windows_close_by_the_clock_and_once(spark, tmp_path):
    flows = [[{"flow_id": i, "flow_bytes_s": 3e6} for i in range(k, k + 10)] for k in (0, 10, 20)]
    write_messages(tmp_path / "in", flows[:2])
    begun = time.time()
    first = _run_arrival(spark, str(tmp_path / "in"), f"{tmp_path}/out").collect()
    assert sum(r["totalFlows"] for r in first) == sum(r["attackFlows"] for r in first) == 20
    assert all(begun * 1000 - 2000 <= r["windowStart"] and r["windowEnd"] <= time.time() * 1000 for r in first)
    # nothing new: nothing is published again
    second = _run_arrival(spark, str(tmp_path / "in"), f"{tmp_path}/out").collect()
    assert sorted(map(str, second)) == sorted(map(str, first))
    (tmp_path / "in" / "late.json").write_text("\n".join(json.dumps(r) for r in flows[2]))
    third = _run_arrival(spark, str(tmp_path / "in"), f"{tmp_path}/out").collect()
    assert sum(r["totalFlows"] for r in third) == 30 and len({r["windowStart"] for r in third}) == len(third)


BATCHES = [
    [("a", 1, 10.0), ("b", 2, 4.0), ("a", 3, 20.0)],
    [("a", 5, 60.0), ("c", 4, None)],
    [],
    [("c", 9, 8.0), ("b", 7, 6.0), (None, 8, 1.0), (None, 8, 1.0)],
]
ROW = "src string, at long, flow_bytes_s double"


def _batch(spark, rows):
    return spark.createDataFrame(rows, ROW).withColumns({"flow_packets_s": F.lit(1.0), "time": F.timestamp_seconds("at")})


@pytest.mark.parametrize("by", [["src"], None])
def test_running_totals_over_batches_equal_one_batch(spark, tmp_path, by):
    sink = state.running_rates_sink(str(tmp_path), "time", by=by)
    for number, rows in enumerate(BATCHES):
        sink(_batch(spark, rows), number)
        if number in (1, 3):
            sink(_batch(spark, rows), number)  # replayed
    found = spark.read.parquet(f"{tmp_path}/rows").drop("batch")
    whole = running_rates(_batch(spark, [r for rows in BATCHES for r in rows]), "time", by=by)
    columns = ["src", "at", "flow_count", "avg_bytes_s", "avg_packets_s"]
    assert sorted(map(str, found.select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))
    assert len(state.VersionedTable(spark, f"{tmp_path}/totals").versions()) == state.KEPT


def test_history_over_batches(spark, tmp_path):
    assert state.read_history(spark, str(tmp_path), "at") is None
    sink = state.history_sink(str(tmp_path), "at", 3, ["src"])
    for number, rows in enumerate(BATCHES):
        for _ in range(1 + number % 2):  # every other batch is replayed
            sink(_batch(spark, rows), number)
        seen = sorted((r for b in BATCHES[:number + 1] for r in b), key=lambda r: (-r[1], r[0] or ""))
        shown = state.read_history(spark, str(tmp_path), "at", 3, ["src"])
        assert [r["at"] for r in shown.collect()] == [r[1] for r in seen[:3]]


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    table = state.VersionedTable(spark, str(tmp_path))
    table.put(4, spark.range(3))
    (tmp_path / "version=5").mkdir()
    assert table.versions() == [4] and table.before(6).count() == 3 and table.before(4) is None


RULE = "flowId long, attackType string, severity string, timestamp long"
ML = RULE + ", source string"


def _alerts(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("flowId", "attackType", "severity", "timestamp", "source"), r))) for r in rows))


def test_live_merge_drops_what_is_sent_again(spark, tmp_path):
    base = 1_704_067_200_000
    rule = [(i, "FLOOD", "HIGH", base + 1000 * i) for i in range(20)]
    ml = [(i, "FLOOD", "HIGH", base + 1000 * i, "spark-ml") for i in range(20)]

    def run():
        streams = [spark.readStream.schema(s).json(f"{tmp_path}/{n}") for n, s in (("rule", RULE), ("ml", ML))]
        jobs.fan_out(state.merge_live_alerts(*streams, lateness="5 seconds"), [jobs.parquet_sink(f"{tmp_path}/out")], f"{tmp_path}/c").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").drop("batch")

    _alerts(tmp_path / "rule", "a.json", rule[:12])
    _alerts(tmp_path / "ml", "a.json", ml)
    assert run().count() == 32
    _alerts(tmp_path / "rule", "b.json", rule[:12])  # sent again, in part beyond the lateness
    _alerts(tmp_path / "ml", "b.json", ml[15:])
    assert run().count() == 32
    _alerts(tmp_path / "rule", "c.json", rule[18:] * 2)
    got = run()
    want = merge_alert_streams(spark.createDataFrame(rule[:12] + rule[18:], RULE), spark.createDataFrame(ml, ML))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_messages_are_told_once(spark, tmp_path):
    rows = [(1, "x"), (1, "x"), (2, None), (None, None)]
    sink = state.message_files(f"{tmp_path}/topic", "alerts")
    for number in (0, 1, 1):  # the second batch is sent twice
        sink(spark.createDataFrame(rows, "a int, b string"), number)
    sent = spark.read.schema("key string, value string").json(f"{tmp_path}/topic")
    assert sent.count() == 12
    told = state.told_once(sent).collect()
    assert sorted(r["value"] for r in told) == sorted(['{"a":1,"b":"x"}', '{"a":1,"b":"x"}', '{"a":2}', "{}"] * 2)
    stream = spark.readStream.schema("key string, value string").json(f"{tmp_path}/topic").withColumn("timestamp", F.current_timestamp())
    jobs.replay(state.told_once(stream, "timestamp"), f"{tmp_path}/told")
    assert spark.read.parquet(f"{tmp_path}/told/rows").count() == 8
    with pytest.raises(ValueError, match="time"):
        state.told_once(stream)
