"""What streams remember: totals and history carried from batch to batch, alerts merged live, messages told once.

The carried tables are rewritten under the number of each micro-batch. A batch that is replayed after a
failure starts again from the version before its own and overwrites what it had written, so every
result is the same as without the failure. A table holds one row a key (or a fixed number of rows), never the stream.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.operators.alerts import as_json, merge_alert_streams
from fluxwatch.operators.history import HISTORY, latest
from fluxwatch.operators.stats import running_rates, running_totals

Sink = Callable[[DataFrame, int], None]

# Versions kept: the newest, and the one a replay of it starts from.
KEPT = 2


class VersionedTable:
    """A small table in a shared folder, one version per micro-batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def versions(self) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        files, root = self._folder(self.path)
        if not files.exists(root):
            return []
        found = [re.fullmatch(r"version=(\d+)", s.getPath().getName()) for s in files.listStatus(root)]
        numbers = sorted(int(m[1]) for m in found if m)
        return [n for n in numbers if files.exists(self._folder(f"{self.path}/version={n}/_SUCCESS")[1])]

    def read(self, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={number}")

    def before(self, number: int) -> DataFrame | None:
        """The newest version that earlier batches left, none at the start."""
        earlier = [n for n in self.versions() if n < number]
        return self.read(earlier[-1]) if earlier else None

    def newest(self) -> DataFrame | None:
        numbers = self.versions()
        return self.read(numbers[-1]) if numbers else None

    def put(self, number: int, rows: DataFrame) -> None:
        """Writes the version of a batch (again) and drops the ones no replay can ask for."""
        rows.write.mode("overwrite").parquet(f"{self.path}/version={number}")
        for old in self.versions()[:-KEPT]:
            files, target = self._folder(f"{self.path}/version={old}")
            files.delete(target, True)


def running_rates_sink(
    path: str, time: str, by: list[str] | None = None, tie: list[str] | None = None, **columns: str
) -> Sink:
    """Running count and mean rates of every row in order of arrival, below ``path/rows``.

    Rows of one batch are ordered by ``time`` and ``tie``; totals of all earlier batches are
    carried per source in ``path/totals``.
    """

    def write(batch: DataFrame, number: int) -> None:
        table = VersionedTable(batch.sparkSession, f"{path}/totals")
        kept = batch.persist()
        try:
            carried = table.before(number)
            rows = running_rates(kept, time, by=by, tie=tie, carried=carried, **columns)
            rows.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
            table.put(number, running_totals(kept, by, carried, **columns))
        finally:
            kept.unpersist()

    return write


def history_sink(path: str, time: str, n: int = HISTORY, tie: list[str] | None = None) -> Sink:
    """Keeps the newest ``n`` rows of a stream; :func:`read_history` serves them."""

    def write(batch: DataFrame, number: int) -> None:
        table = VersionedTable(batch.sparkSession, path)
        earlier = table.before(number)
        rows = batch if earlier is None else earlier.unionByName(batch)
        table.put(number, latest(rows, time, n, tie))

    return write


def read_history(spark: SparkSession, path: str, time: str, n: int = HISTORY, tie: list[str] | None = None) -> DataFrame | None:
    """The newest rows, newest first, as of the last complete batch; none before the first."""
    rows = VersionedTable(spark, path).newest()
    return None if rows is None else latest(rows, time, n, tie)


# What makes two messages the same alert.
ALERT_KEY = ["flow_id", "attack_type", "timestamp_ms", "is_ml"]


def merge_live_alerts(rule: DataFrame, ml: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Two alert streams as one, in the normalised layout, each alert once.

    An alert that is sent again is dropped: while it is remembered by its key, and later because it is older than
    the newest alert by more than ``lateness``. A first alert that comes that late is dropped, too.
    """
    both = merge_alert_streams(rule, ml).withColumn("__at", F.timestamp_millis("timestamp_ms"))
    return both.withWatermark("__at", lateness).dropDuplicatesWithinWatermark(ALERT_KEY).drop("__at")


def keyed_messages(batch: DataFrame, number: int, stream: str) -> DataFrame:
    """Rows as messages (key, value) whose key is the same each time a batch is sent.

    The key names the stream, the batch, the row's content and, among equal rows of the batch, its
    count. Equal rows are counted before they meet, so a frequent row is no hot key.
    """
    counted = as_json(batch).groupBy("value").agg(F.count("*").alias("__n"))
    each = counted.select("value", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))).alias("__i"))
    key = F.concat_ws("-", F.lit(stream), F.lit(str(number)), F.substring(F.sha2("value", 256), 1, 32), F.col("__i").cast("string"))
    return each.select(key.alias("key"), "value")


def message_files(path: str, stream: str) -> Sink:
    """The file twin of a topic: every sending is appended, a batch that is sent again as well."""

    def write(batch: DataFrame, number: int) -> None:
        as_json(keyed_messages(batch, number, stream)).write.mode("append").text(path)

    return write


def told_once(messages: DataFrame, time: str | None = None, lateness: str = "10 minutes") -> DataFrame:
    """Messages without those sent again, told by their key.

    A stream forgets keys ``lateness`` after the ``time`` they came with (a topic's own timestamp);
    a batch reads all and needs no time.
    """
    if messages.isStreaming:
        if time is None:
            raise ValueError("a stream needs the time of its messages")
        return messages.withWatermark(time, lateness).dropDuplicatesWithinWatermark(["key"])
    return messages.dropDuplicates(["key"])
