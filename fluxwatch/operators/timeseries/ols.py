"""Least squares per series as sums of products, in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxwatch.operators.timeseries.frame import KEY, join_series, lagged, train_rows


def line_fit(rows: DataFrame, y: Column, x: Column, by: list[str] | None = None) -> DataFrame:
    """Intercept and slope of ``y`` on ``x`` per series; null where x is constant."""
    pairs = rows.withColumns({"__y": y, "__x": x}).filter("__y IS NOT NULL AND __x IS NOT NULL")
    slope = F.try_divide(F.covar_pop("__y", "__x"), F.var_pop("__x"))
    return pairs.groupBy(*(by or KEY)).agg(
        F.count("*").alias("n"),
        slope.alias("slope"),
        (F.avg("__y") - slope * F.avg("__x")).alias("intercept"),
    )


def ar1_fit(frame: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """First-order autoregression on the training part."""
    by = by or KEY
    rows = lagged(train_rows(frame), {value: 1}, by)
    return line_fit(rows, F.col(value), F.col(f"{value}_1"), by)


def one_step(frame: DataFrame, fit: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """Adds ``yhat``, the one-step forecast of a first-order fit, and ``sigma``, its
    root mean squared error on the training part."""
    by = by or KEY
    ahead = F.col("intercept") + F.col("slope") * F.col(f"{value}_1")
    rows = join_series(lagged(frame, {value: 1}, by), fit.select(*by, "slope", "intercept"), by)
    rows = rows.withColumn("yhat", ahead).drop("slope", "intercept", f"{value}_1")
    gap = F.col(value) - F.col("yhat")
    spread = train_rows(rows).groupBy(*by).agg(F.sqrt(F.avg(gap * gap)).alias("sigma"))
    return join_series(rows, spread, by)


def centred(frame: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """Adds ``r``: deviation from the mean of the training part."""
    by = by or KEY
    means = train_rows(frame).groupBy(*by).agg(F.avg(value).alias("__mean"))
    rows = join_series(frame, means, by)
    return rows.withColumn("r", F.col(value) - F.col("__mean")).drop("__mean")


def arch1_fit(frame: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """Regression of squared deviations on their predecessor (a first ARCH estimate)."""
    by = by or KEY
    rows = lagged(train_rows(centred(frame, value, by)), {"r": 1}, by)
    square = F.col("r") * F.col("r")
    before = F.col("r_1") * F.col("r_1")
    return line_fit(rows, square, before, by)


def arch1_variance(frame: DataFrame, fit: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """Adds ``r`` and ``variance`` = intercept + slope * previous squared deviation."""
    by = by or KEY
    rows = lagged(centred(frame, value, by), {"r": 1}, by)
    rows = join_series(rows, fit.select(*by, "slope", "intercept"), by)
    ahead = F.col("intercept") + F.col("slope") * F.col("r_1") * F.col("r_1")
    return rows.withColumn("variance", ahead).drop("slope", "intercept", "r_1")
