import json
import os

from pyspark.sql import functions as F

from fluxwatch.session import run_dir
from fluxwatch.sources.readers import read_text_stream
from fluxwatch.sources.decode import decode_flows
from fluxwatch.streaming import jobs


def write_messages(folder, files):
    folder.mkdir()
    for i, rows in enumerate(files):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
        path = folder / f"part-{i}.json"
        path.write_text("\n".join(lines) + "\n")
        # files are taken in order of their age
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


FILES = [
    [{"flow_id": i, "flow_bytes_s": 3e6 if i % 2 else 3e5, "src_ip": "a", "dst_ip": "b", "timestamp": str(1704067200 + 3 * i)} for i in range(k, k + 10)]
    + ["{broken"]
    for k in (0, 10, 20)
]


def test_stream_equals_batch(spark, tmp_path):
    write_messages(tmp_path / "in", FILES)
    stream = jobs.detect(read_text_stream(spark, str(tmp_path / "in"), 1))
    path = run_dir(spark, "t")
    jobs.replay(stream, path)
    got = spark.read.parquet(f"{path}/rows").drop("timestamp", "batch")
    batch = jobs.detect(spark.read.text(str(tmp_path / "in"))).drop("timestamp")
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and got.count() == 15


def _timed(messages):
    return decode_flows(messages).withColumn("at", F.timestamp_seconds(F.col("timestamp").cast("long")))


def test_window_statistics_over_several_batches(spark, tmp_path):
    write_messages(tmp_path / "in", FILES)
    rows = jobs.stream_flow_stats(_timed(read_text_stream(spark, str(tmp_path / "in"), 1)), "at")
    path = run_dir(spark, "t")
    jobs.replay(rows, path, "update")
    got = jobs.latest_windows(spark, f"{path}/rows")
    batch = jobs.stream_flow_stats(_timed(spark.read.text(str(tmp_path / "in"))), "at")
    assert got.count() == batch.count() == 9
    assert sorted(map(str, got.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_append_mode_holds_back_open_windows(spark, tmp_path):
    write_messages(tmp_path / "in", FILES)
    rows = jobs.stream_flow_stats(_timed(read_text_stream(spark, str(tmp_path / "in"), 1)), "at")
    path = run_dir(spark, "t")
    jobs.replay(rows, path, "append")
    closed = spark.read.parquet(f"{path}/rows").count()
    assert 0 < closed < 9


def test_arrival_time_windows(spark):
    flows = decode_flows(spark.createDataFrame([('{"flow_bytes_s": 3e6}',)], "value string"))
    row = jobs.stream_flow_stats(flows).first()
    assert row["totalFlows"] == 1 and row["attackTypes"] == {"FLOOD": 1}
    assert row["windowEnd"] - row["windowStart"] == 10_000


def test_several_sinks(spark, tmp_path):
    write_messages(tmp_path / "in", FILES)
    path = run_dir(spark, "t")
    stream = jobs.detect(read_text_stream(spark, str(tmp_path / "in")))
    query = jobs.fan_out(
        stream, [jobs.parquet_sink(f"{path}/a"), jobs.jsonl_sink(f"{path}/b"), jobs.console_sink(1)], f"{path}/c"
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{path}/a").count() == spark.read.text(f"{path}/b").count() == 15


def test_scoring_covers_broken_messages(spark, tmp_path):
    from test_sources import _labelled

    from fluxwatch.config import ForestConfig
    from fluxwatch.operators import ml

    write_messages(tmp_path / "in", FILES)
    model = ml.train(_labelled(spark), config=ForestConfig(num_trees=5, max_depth=3)).model
    path = run_dir(spark, "t")
    jobs.replay(jobs.score_messages(read_text_stream(spark, str(tmp_path / "in")), model), path)
    got = spark.read.parquet(f"{path}/rows")
    assert got.count() == 33 and got.filter("srcIp IS NULL").count() == 3
    assert got.columns[:12] == [
        "flowId", "srcIp", "dstIp", "flowBytesPerSec", "flowPacketsPerSec", "attackType", "severity",
        "pqcEnabled", "kemHandshakeMs", "sigSignMs", "timestamp", "source",
    ]


def test_files_roll_by_size(spark, tmp_path):
    """Wide and narrow rows: no file above the limit but one that holds a single wider row."""
    rows = [(i, "x" * (10 if i % 3 else 900)) for i in range(400)] + [(999, "y" * 5000)]
    batch = spark.createDataFrame(rows, "a int, b string").repartition(3)
    sink = jobs.rolling_jsonl_sink(f"{tmp_path}/out", 4000)
    for number in (0, 1, 1):
        sink(batch, number)
    sink(batch.limit(0), 2)
    files = [p for p in (tmp_path / "out").rglob("part-*") if p.suffix != ".crc"]
    large = [p for p in files if p.stat().st_size > 4000]
    assert len(large) == 2 and all(len(p.read_text().splitlines()) == 1 for p in large)
    assert spark.read.json(f"{tmp_path}/out").count() == 2 * len(rows)
    whole = jobs.rolling_jsonl_sink(f"{tmp_path}/one", 10**9)
    whole(batch, 0)
    assert len([p for p in (tmp_path / "one").rglob("part-*") if p.suffix != ".crc"]) <= 3
