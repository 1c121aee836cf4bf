"""Traffic anomalies: far above the forecast, or with an extreme variance shock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def above_forecast(df: DataFrame, y: str, yhat: str, sigma: Column, k: float = 3.0) -> DataFrame:
    """Adds ``is_anomaly``: the value exceeds the forecast by more than k sigma."""
    limit = F.col(yhat) + F.lit(k) * sigma
    return df.withColumn("is_anomaly", F.coalesce(F.col(y) > limit, F.lit(False)))


def variance_shock(df: DataFrame, r: str = "r", variance: str = "variance", k: float = 9.0) -> DataFrame:
    """Adds ``is_shock``: the squared deviation exceeds k times its conditional variance."""
    square = F.col(r) * F.col(r)
    return df.withColumn("is_shock", F.coalesce(square > F.lit(k) * F.col(variance), F.lit(False)))
