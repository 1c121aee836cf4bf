"""Model comparison: fits, forecast errors, ranking and plot data."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxwatch.operators.timeseries.frame import BLOCK, KEY, test_rows, train_rows
from fluxwatch.operators.timeseries.linear import fit_arima, fit_arma, fit_sarima, fit_var, forecast
from fluxwatch.operators.timeseries.regimes import fit_switching
from fluxwatch.operators.timeseries.single import fit_single
from fluxwatch.operators.timeseries.volatility import fit_arch, fit_garch
from fluxwatch.session import shared_dir, written

FITS = {
    "ARMA(1,1)": fit_arma,
    "ARIMA(1,1,1)": fit_arima,
    "SARIMA": fit_sarima,
    "ARCH(1)": fit_arch,
    "GARCH(1,1)": fit_garch,
    "VAR": fit_var,
    "TAR": fit_switching,
}


def forecast_error(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """RMSE and MAE over the rows where both sides are numbers; null if there are none."""
    a, b = F.col(y).cast("double"), F.col(yhat).cast("double")
    known = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b)
    gap = F.when(known, a - b)
    return df.groupBy(*(by or [])).agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae")
    )


def fit_models(frame: DataFrame, names: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """One row per (series, model) with its criteria and ``fit_seconds``.

    Series of up to one block are fitted in one pass. Each model of the longer ones is a chain
    of jobs over blocks; the seconds are then those of the chain over all these series.
    """
    by = by or KEY
    names = names or list(FITS)
    kept = frame.persist(StorageLevel.MEMORY_AND_DISK)
    done = [written(fit_single(kept, names, by), "fit")]
    # a series that goes beyond its first block has exactly one training row at this position
    if not train_rows(kept).filter(F.col("idx") == BLOCK).isEmpty():
        wide = kept.filter(F.col("n_train") > BLOCK)
        shared_dir(frame.sparkSession)  # settled before the threads need it

        def fit(name: str) -> DataFrame:
            begun = time.monotonic()
            rows = written(FITS[name](wide, by=by), "fit")
            return rows.withColumn("fit_seconds", F.lit(time.monotonic() - begun))

        # a fit is a chain of small jobs: side by side they share the cores
        with ThreadPoolExecutor(max_workers=len(FITS)) as pool:
            done += pool.map(fit, names)
    kept.unpersist()
    return reduce(DataFrame.unionByName, done)


def actual_and_forecast(models: DataFrame, frame: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """Test rows with each model's forecast: ``by, step, time_bucket, y, model, yhat``."""
    by = by or KEY
    ahead = forecast(models, frame, by)
    rows = test_rows(frame).select(*by, "step", "time_bucket", F.col(value).alias("y"))
    return rows.join(ahead, [*by, "step"])


def model_table(models: DataFrame, compared: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The comparison table; models without forecast have no errors, fits that did not settle no criteria."""
    by = by or KEY
    errors = forecast_error(compared, "y", "yhat", [*by, "model"])
    return models.join(errors, [*by, "model"], "left").select(
        *by, "model", "k", "nobs", "aic", "bic", "llf", "rmse", "mae",
        *[c for c in ("converged", "fit_seconds") if c in models.columns],
    )


def rank_models(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Ranks per series by RMSE and by AIC, and marks the winner (smallest RMSE).

    The VAR criterion is on another scale, so it takes no part in the AIC rank.
    """
    by = by or KEY

    def place(column: Column) -> Column:
        order = Window.partitionBy(*by).orderBy(column.asc_nulls_last(), F.col("model"))
        return F.row_number().over(order)

    aic = F.when(F.col("model") != "VAR", F.col("aic"))
    return table.withColumns(
        {
            "rmse_rank": F.when(F.col("rmse").isNotNull(), place(F.col("rmse"))),
            "aic_rank": F.when(aic.isNotNull(), place(aic)),
        }
    ).withColumn("winner", F.coalesce(F.col("rmse_rank") == 1, F.lit(False)))


def plot_rows(compared: DataFrame, frame: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """Long table of the test part: the actual values and each forecast by step."""
    by = by or KEY
    actual = test_rows(frame).select(*by, "step", F.lit("Actual").alias("model"), F.col(value).alias("value"))
    return actual.unionByName(compared.select(*by, "step", "model", F.col("yhat").alias("value")))
