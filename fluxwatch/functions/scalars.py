"""Small column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.config import MIN_DURATION_S


def guard_duration(duration: Column) -> Column:
    """Lower bound that keeps rates finite."""
    return F.greatest(duration, F.lit(MIN_DURATION_S))


def time_bucket(seconds: Column) -> Column:
    """One-second bucket; truncates toward zero, so -0.5 falls into bucket 0."""
    return seconds.cast("long")


def to_mega(value: Column) -> Column:
    return value / F.lit(1e6)


def zero_fill(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null and NaN become 0 in numeric columns (all of them by default)."""
    return df.na.fill(0.0, columns) if columns else df.na.fill(0.0)


def truthy_number(value: Column) -> Column:
    """The number, or null where it is 0 or NaN."""
    number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return F.nullif(number, F.lit(0.0))


def truthy_text(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit(""))


def present(df: DataFrame, names: list[str], dtype: str = "string") -> list[Column]:
    """Those of ``names`` that are columns of ``df``; a typed null if none is."""
    have = {c for c in df.columns}
    found = [F.col(n) for n in names if n in have]
    return found or [F.lit(None).cast(dtype)]


def rate_value(df: DataFrame, *names: str) -> Column:
    """First non-zero of the named columns that exist, else 0."""
    found = [truthy_number(c) for c in present(df, list(names), "double")]
    return F.coalesce(*found, F.lit(0.0))


def fixed_one(value: Column) -> Column:
    """One decimal, halves up. ``format_number`` rounds exact halves to even, and
    the only such half a double can hold that comes out different ends in .25."""
    nudged = F.when(F.abs(value) % 1 == 0.25, value + F.signum(value) * 0.01).otherwise(value)
    return F.call_function("format_number", nudged, F.lit("0.0"))


def short_number(value: Column) -> Column:
    """1234567 -> 1.2M, 1234 -> 1.2K, 999.4 -> 999."""
    return (
        # NaN is above every number here
        F.when(F.isnan(value.cast("double")), F.lit("NaN"))
        .when(value >= 1e6, F.concat(fixed_one(value / F.lit(1e6)), F.lit("M")))
        .when(value >= 1e3, F.concat(fixed_one(value / F.lit(1e3)), F.lit("K")))
        .otherwise(F.floor(value + F.lit(0.5)).cast("string"))
    )


def percent(value: Column) -> Column:
    """0.987 -> 98.7%, null -> an em dash."""
    shown = F.concat(fixed_one(value * F.lit(100.0)), F.lit("%"))
    return F.when(value.isNull(), F.lit("—")).otherwise(shown)


def spaced(name: Column) -> Column:
    """Underscores shown as spaces."""
    return F.translate(name, "_", " ")


def instant_ms(value: Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds of a timestamp given as number, text (digits or ISO) or timestamp."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_millis(value.cast("timestamp"))
    if isinstance(dtype, T.NumericType):
        return value.cast("long")
    digits = value.rlike(r"^\d+$")
    return F.when(digits, value.try_cast("long")).otherwise(
        F.unix_millis(value.try_cast("timestamp"))
    )
