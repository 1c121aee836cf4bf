"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.session import written

#: Words of the contracts: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: The same as a Java pattern between words, for split().
GAP = r"[\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drop_folder(df: DataFrame) -> None:
    """Deletes the scratch table ``df`` was read from (only tables made by ``written``)."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_KEPT: dict = {}


def _lasting() -> dict:
    """What lasts as long as this process. Task functions travel by value, and with them the globals they use: what
    those hold is made anew in each task, and what the driver's hold would be sent with every task."""
    return sys.modules.setdefault("_fluxwatch_kept", types.ModuleType("_fluxwatch_kept")).__dict__.setdefault("kept", {})


def kept(make: Callable, path: str, lasting: bool = False):
    """``make(path)``, kept for later calls in this task, or if ``lasting`` in later tasks of this worker too. Whatever was
    kept before is let go first: a reused worker would else hold the words of every vocabulary it has met."""
    key, held = (make.__qualname__, path), _lasting() if lasting else _KEPT
    if key not in held:
        let_go()
        held[key] = make(path)
    return held[key]


def let_go() -> None:
    """Frees what :func:`kept` holds, for work that needs no vocabulary."""
    _KEPT.clear()
    _lasting().clear()


@contextmanager
def batches_of(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Jobs inside hand rows to Python in batches of at most ``rows`` rows and about ``size`` bytes, and scan no more rows at a time;
    the session's settings come back."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size, "spark.sql.parquet.columnarReaderBatchSize": rows}
    before = {name: spark.conf.get(name) for name in limits}
    try:
        for name, limit in limits.items():
            spark.conf.set(name, str(limit))
        yield
    finally:
        for name, limit in before.items():
            spark.conf.set(name, limit)


def free(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores before it as it takes to differ from all the names ``taken``."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, group: list[str], name: str, rank: str) -> DataFrame:
    """``df`` with a gapless 0-based ``rank`` in each group, hot groups included.

    Rows are written once with the task that made them; a row's rank is its place
    among the group's rows of that task plus the group's rows of earlier tasks.
    No task orders more rows than an input task had.
    """
    marked = written(df.withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), name)
    sizes = marked.groupBy(*group, "_task").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*group, "_task").orderBy("_at")
    return (
        marked.join(starts, [*group, "_task"])
        .withColumn(rank, F.row_number().over(within) - 1 + F.col("_start"))
        .drop("_task", "_at", "_start")
    )


def utf8_bytes(text: str) -> F.Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, component), component the smallest node.

    Alternates large-star and small-star steps until no edge changes. A step is an
    aggregate of minima joined back, so a hub is never gathered in one task. Each
    round is written to the shared folder; the round before is then deleted.
    """
    def folded(pairs: DataFrame) -> DataFrame:
        return pairs.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def trace(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = written(folded(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    mark = trace(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = folded(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new = written(folded(small), "edges")
        seen, mark, old, now = mark, trace(new), now, new
        drop_folder(old)
        if seen == mark:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


class Groups:
    """Local union of linked rows: each row's label is the smallest row it is linked with."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (shorter := label[label] != label).any():
                label[shorter] = label[label[shorter]]
