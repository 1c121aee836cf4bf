"""Aggregations: window statistics, distributions, running rates, row counts."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from fluxwatch.config import ATTACKS
from fluxwatch.functions.rules import classify_rules, is_attack


def _histogram(count_of) -> Column:
    """Map of attack class to count, without the zero entries."""
    pairs = [c for name in ATTACKS for c in (F.lit(name), count_of(name))]
    return F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)


def stats_columns(total: Column | None = None) -> list[Column]:
    """Aggregates of classified flows; every average and the maximum is 0 on no rows.

    ``total`` counts the flows, where other rows (of nulls) are among them."""

    def mean(name: str) -> Column:
        return F.coalesce(F.avg(name), F.lit(0.0))

    total = F.count(F.lit(1)) if total is None else total
    attacks = F.count_if(is_attack())
    share = F.when(total > 0, attacks / total * F.lit(100.0)).otherwise(F.lit(0.0))
    return [
        total.alias("totalFlows"),
        attacks.alias("attackFlows"),
        (total - attacks).alias("normalFlows"),
        mean("flow_bytes_s").alias("avgBytesPerSec"),
        mean("flow_packets_s").alias("avgPacketsPerSec"),
        F.greatest(F.max("flow_bytes_s"), F.lit(0.0)).alias("maxBytesPerSec"),
        share.alias("attackRate"),
        mean("kem_handshake_ms").alias("avgKemHandshakeMs"),
        mean("sig_sign_ms").alias("avgSigSignMs"),
        _histogram(lambda name: F.count_if(F.col("attack_type") == name)).alias("attackTypes"),
    ]


def flow_stats(flows: DataFrame, by: list[str | Column] | None = None, total: Column | None = None) -> DataFrame:
    """Statistics of flows, over everything or per group."""
    labelled = flows if "attack_type" in flows.columns else classify_rules(flows)
    return labelled.groupBy(*(by or [])).agg(*stats_columns(total))


def merge_stats(stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Combines rows of :func:`flow_stats` into the statistics of their union."""
    total, attacks = F.sum("totalFlows"), F.sum("attackFlows")

    def mean(name: str) -> Column:
        return F.coalesce(
            F.try_divide(F.sum(F.col(name) * F.col("totalFlows")), total), F.lit(0.0)
        )

    def merged(name: str) -> Column:
        return F.sum(F.coalesce(F.try_element_at("attackTypes", F.lit(name)), F.lit(0).cast("long")))

    zero = F.lit(0).cast("long")
    return stats.groupBy(*(by or [])).agg(
        F.coalesce(total, zero).alias("totalFlows"),
        F.coalesce(attacks, zero).alias("attackFlows"),
        F.coalesce(F.sum("normalFlows"), zero).alias("normalFlows"),
        mean("avgBytesPerSec").alias("avgBytesPerSec"),
        mean("avgPacketsPerSec").alias("avgPacketsPerSec"),
        F.greatest(F.max("maxBytesPerSec"), F.lit(0.0)).alias("maxBytesPerSec"),
        F.coalesce(F.try_divide(attacks, total) * F.lit(100.0), F.lit(0.0)).alias("attackRate"),
        mean("avgKemHandshakeMs").alias("avgKemHandshakeMs"),
        mean("avgSigSignMs").alias("avgSigSignMs"),
        _histogram(merged).alias("attackTypes"),
    )


def windowed_stats(
    flows: DataFrame, time: str | Column, length: str = "10 seconds", total: Column | None = None
) -> DataFrame:
    """Statistics per tumbling window, bounds as epoch milliseconds.

    Works on batch and streaming input; the stream adds its watermark first.
    """
    return flow_stats(flows, [F.window(time, length).alias("window")], total).select(
        F.unix_millis("window.start").alias("windowStart"),
        F.unix_millis("window.end").alias("windowEnd"),
        *[F.col(c) for c in STATS_COLUMNS],
    )


STATS_COLUMNS = [
    "totalFlows", "attackFlows", "normalFlows", "avgBytesPerSec", "avgPacketsPerSec",
    "maxBytesPerSec", "attackRate", "avgKemHandshakeMs", "avgSigSignMs", "attackTypes",
]


def class_distribution(df: DataFrame, label: str = "attack_type") -> DataFrame:
    """Rows per class, most frequent first."""
    return df.groupBy(label).count().orderBy(F.desc("count"), label)


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(label, prediction).count()


def row_counts(df: DataFrame, by: str = "run_id") -> DataFrame:
    """Rows per run."""
    return df.groupBy(by).count()


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts rows as they pass, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


# Rows one ordered task should handle.
ROWS_PER_SLICE = 2_000_000


def time_slices(df: DataFrame, time: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Adds ``__slice``: contiguous time ranges of about equal row count.

    Two small jobs choose the bounds, a row count and a quantile sketch; only
    the bounds reach the driver. Equal counts, not equal widths, so a busy
    period is cut as finely as it needs.
    """
    parts = -(-df.count() // rows_per_slice)
    if parts <= 1:
        return df.withColumn("__slice", F.lit(0.0))
    numeric = df.withColumn("__t", F.col(time).cast("double"))
    points = [i / parts for i in range(1, parts)]
    cuts = sorted(set(numeric.approxQuantile("__t", points, 0.25 / parts)))
    splits = [float("-inf"), *cuts, float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="__t", outputCol="__slice")
    return cutter.transform(numeric).drop("__t")


def running_totals(
    flows: DataFrame,
    by: list[str] | None = None,
    carried: DataFrame | None = None,
    rate: str = "flow_bytes_s",
    packets: str = "flow_packets_s",
) -> DataFrame:
    """Count and sums of both rates per source (columns n, b, p), those ``carried`` from before included."""
    now = flows.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.sum(rate).alias("b"), F.sum(packets).alias("p"))
    if carried is None:
        return now
    return now.unionByName(carried).groupBy(*(by or [])).agg(*[F.sum(c).alias(c) for c in "nbp"])


def running_rates(
    flows: DataFrame,
    time: str,
    rate: str = "flow_bytes_s",
    packets: str = "flow_packets_s",
    by: list[str] | None = None,
    tie: list[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Running count and running mean rates in arrival order, per source.

    Totals of the earlier slices are added to a running sum inside each slice,
    so no task orders a whole source. A missing rate adds nothing. ``carried`` holds what came before these rows, one
    row a source as :func:`running_totals` gives it.
    """
    by = by or []
    sliced = time_slices(flows, time, rows_per_slice)
    inside = Window.partitionBy(*by, "__slice").orderBy(time, *(tie or [])).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        sliced.groupBy(*by, "__slice")
        .agg(F.count("*").alias("n"), F.sum(rate).alias("b"), F.sum(packets).alias("p"))
        .select(
            *by,
            "__slice",
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__{c}") for c in "nbp"],
        )
    )
    if carried is not None:
        # without a source there is one row of totals, joined on a constant
        keys = by or ["__one"]
        base = carried.select(*by, *[F.col(c).alias(f"__c{c}") for c in "nbp"])
        left, right = (totals, base) if by else (totals.withColumn("__one", F.lit(1)), base.withColumn("__one", F.lit(1)))
        sums = {f"__{c}": F.col(f"__{c}") + F.coalesce(f"__c{c}", F.lit(0)) for c in "nbp"}
        totals = left.join(right, keys, "left").withColumns(sums).select(*totals.columns)
    run = {
        "flow_count": F.count("*").over(inside),
        "__run_b": F.coalesce(F.sum(rate).over(inside), F.lit(0.0)),
        "__run_p": F.coalesce(F.sum(packets).over(inside), F.lit(0.0)),
    }
    # joined on (source, slice): the layout the running window needs anyway
    return (
        sliced.join(totals, [*by, "__slice"])
        .withColumns(run)
        .withColumn("flow_count", F.col("flow_count") + F.col("__n").cast("long"))
        .withColumns(
            {
                "avg_bytes_s": (F.col("__run_b") + F.col("__b")) / F.col("flow_count"),
                "avg_packets_s": (F.col("__run_p") + F.col("__p")) / F.col("flow_count"),
            }
        )
        .drop("__slice", "__n", "__b", "__p", "__run_b", "__run_p")
    )
