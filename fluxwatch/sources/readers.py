"""Batch and streaming sources, all with explicit schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.config import TOPIC_FLOWS
from fluxwatch.operators.features import training_flows
from fluxwatch.schemas import FLOW, LABELLED_FLOW, PACKET


def _pqc_flag(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name) == 1)


def read_packets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Packet log as CSV with a header, or as Parquet written by ``packets_to_parquet``."""
    first = path if isinstance(path, str) else path[0]
    if first.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    return _pqc_flag(_by_header(spark, path, PACKET), "pqc_enabled")


def read_labelled_flows(spark: SparkSession, path: str) -> DataFrame:
    """Labelled flow records, CSV with a header."""
    return _pqc_flag(_by_header(spark, path, LABELLED_FLOW), "PQC_Enabled")


def _header(spark: SparkSession, path: str | list[str], **options) -> list[str]:
    """Column names of a CSV (first line only)."""
    line = spark.read.options(**options).text(path).limit(1).first()
    return [] if line is None else [c.strip() for c in line[0].split(",")]


def _by_header(
    spark: SparkSession, path: str | list[str], schema: T.StructType, extra: dict | None = None, **options
) -> DataFrame:
    """CSV columns by the names of the header, whatever their order. A column the file lacks
    is null, others are left out; files below one path whose headers differ are refused.
    ``extra`` adds metadata columns."""
    names = _header(spark, path, **options)
    if not names:
        return spark.createDataFrame([], schema).withColumns({k: F.lit(None) for k in extra or {}})
    known = {f.name: f for f in schema}
    found = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])
    raw = spark.read.schema(found).options(header=True, enforceSchema=False, **options).csv(path)
    columns = [F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return raw.select(*columns, *[c.alias(k) for k, c in (extra or {}).items()])


def read_training(spark: SparkSession, path: str, **options) -> DataFrame:
    """Flow rows for training from either kind of file, CSV or Parquet, told apart by the columns."""
    if path.rstrip("/").endswith(".parquet"):
        return training_flows(spark.read.parquet(path), **options)
    per_packet = "packet_size_bytes" in _header(spark, path)
    raw = read_packets(spark, path) if per_packet else read_labelled_flows(spark, path)
    return training_flows(raw, **options)


def read_runs(spark: SparkSession, folder: str, pattern: str = r"run-(\d+)") -> DataFrame:
    """Packet logs of many runs below one folder, with the ``run_id`` of their path.

    The last match in the path counts, so folders above the runs may be named alike."""
    run = F.regexp_extract(F.col("_metadata.file_path"), f".*{pattern}", 1).try_cast("long")
    raw = _by_header(spark, folder, PACKET, {"run_id": run}, recursiveFileLookup=True, pathGlobFilter="*.csv")
    return _pqc_flag(raw, "pqc_enabled")


def read_flow_files(spark: SparkSession, folder: str) -> DataFrame:
    """Flow records stored as one JSON object per ``flow-*.json`` file."""
    return (
        spark.read.schema(FLOW)
        .option("multiLine", True)
        .option("pathGlobFilter", "flow-*.json")
        .json(folder)
    )


def read_flow_topic(
    spark: SparkSession, servers: str, topic: str = TOPIC_FLOWS, starting: str = "earliest"
) -> DataFrame:
    """Messages of a topic as a stream. Needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )


def read_text_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same ``value`` column from a folder of JSON-lines files."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """One Parquet table of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    )


_SERIES = T.StructType(
    [T.StructField("series_id", T.StringType())]
    + [
        T.StructField(n, T.LongType())
        for n in ("time_bucket", "tx_bytes_per_sec", "rx_bytes_per_sec", "total_bytes_per_sec")
    ]
)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Bandwidth series as CSV; without a ``series_id`` column it is one series."""
    named = "series_id" in _header(spark, path)
    schema = _SERIES if named else T.StructType(_SERIES.fields[1:])
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows if named else rows.withColumn("series_id", F.lit("total"))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


_METRICS = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("accuracy", "precision", "recall", "f1")]
    + [T.StructField(n, T.IntegerType()) for n in ("numTrees", "maxDepth")]
    + [T.StructField("trainingTimeSec", T.DoubleType()), T.StructField("iatUnit", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("rows", "testRows")]
)
_IMPORTANCE = T.StructType(
    [T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]
)


def _json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines below ``path``, every part file; empty if the path is missing."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_metrics(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored evaluation and feature importance."""
    return (
        _json_lines(spark, f"{folder}/evaluation.json", _METRICS),
        _json_lines(spark, f"{folder}/feature-importance.txt", _IMPORTANCE),
    )
