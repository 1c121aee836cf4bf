"""Session construction for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str, cpus: str = "*", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    cores = cpus if cpus.isdigit() else "8"
    settings = {
        "spark.sql.shuffle.partitions": cores,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a fresh
    temporary folder, which becomes the checkpoint folder too.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            folder = current.get()
        elif context.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="fluxwatch-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts the lineage and
    survives lost executors, and computes the rows once (a checkpoint does twice)."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
