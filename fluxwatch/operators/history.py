"""Bounded looks at recent rows and rankings (top-k reports) and horizon views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwatch.functions.scalars import percent, short_number, spaced

# Sizes of the report views.
HISTORY, ALERTS_SHOWN, STATS_SHOWN, FEED_ROWS, CHART_POINTS, TOP_FEATURES = 200, 50, 20, 100, 60, 8

# Horizons of the flow view, and how often each moves on.
HORIZONS = {"30 seconds": "10 seconds", "60 seconds": "10 seconds", "300 seconds": "60 seconds"}


def latest(df: DataFrame, time: str, n: int = HISTORY, tie: list[str] | None = None) -> DataFrame:
    """The newest ``n`` rows, newest first; every task keeps at most ``n``."""
    return df.orderBy(F.desc(time), *[F.desc(c) for c in tie or []]).limit(n)


def chart_points(df: DataFrame, time: str, n: int = CHART_POINTS, tie: list[str] | None = None) -> DataFrame:
    """The newest ``n`` rows in time order."""
    return latest(df, time, n, tie).orderBy(time, *(tie or []))


def feature_ranking(importance: DataFrame, n: int | None = None) -> DataFrame:
    """Features by importance, all or the first ``n``."""
    ranked = importance.orderBy(F.desc("importance"), "feature")
    return ranked if n is None else ranked.limit(n)


def horizon_rates(flows: DataFrame, time: str, length: str, slide: str | None = None) -> DataFrame:
    """Flow count and mean rates over a trailing horizon.

    Rows are first summed per slide interval; only those sums are repeated for
    the horizons they belong to. ``length`` must be a multiple of ``slide``.
    """
    slide = slide or HORIZONS[length]
    parts = flows.groupBy(F.window(time, slide).alias("part")).agg(
        F.count("*").alias("n"), F.sum("flow_bytes_s").alias("b"), F.sum("flow_packets_s").alias("p")
    )
    begun = parts.select(F.col("part.start").alias("at"), "n", "b", "p")
    return begun.groupBy(F.window("at", length, slide).alias("window")).agg(
        F.sum("n").alias("flow_count"),
        (F.sum("b") / F.sum("n")).alias("avg_bytes_s"),
        (F.sum("p") / F.sum("n")).alias("avg_packets_s"),
    ).select(
        F.unix_millis("window.start").alias("window_start"),
        F.unix_millis("window.end").alias("window_end"),
        "flow_count", "avg_bytes_s", "avg_packets_s",
    )


def display_rates(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds short display texts: ``{output: numeric input}``."""
    return df.withColumns({out: short_number(F.col(src)) for out, src in columns.items()})


def display_metrics(metrics: DataFrame) -> DataFrame:
    """Classification metrics as percentages."""
    names = ["accuracy", "precision", "recall", "f1"]
    return metrics.select(*[percent(F.col(n)).alias(n) for n in names])


def display_features(importance: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """The leading features with readable names."""
    return feature_ranking(importance, n).select(spaced(F.col("feature")).alias("feature"), "importance")
