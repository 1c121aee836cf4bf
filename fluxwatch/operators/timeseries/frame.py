"""Series in time order: positions, chronological split and lags.

Rows of a series may number in the billions, so none of this orders a whole
series in one task. Positions are counted inside bounded time slots and shifted
by the row count of the earlier slots; lags are taken inside bounded blocks of
positions that carry along the last rows of the block before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Time units per slot and positions per block.
BLOCK = 4096

KEY = ["series_id"]


def fill_gaps(series: DataFrame, values: list[str], by: list[str] | None = None, time: str = "time_bucket") -> DataFrame:
    """Adds the missing time buckets of every series with value 0.

    Buckets are generated slot by slot, so no task holds a whole series.
    """
    by = by or KEY
    slot = F.floor(F.col(time) / F.lit(BLOCK)).cast("long")
    ends = series.groupBy(*by).agg(F.min(time).alias("__lo"), F.max(time).alias("__hi"))
    slots = ends.withColumn(
        "__slot",
        F.explode(F.sequence(*[F.floor(F.col(c) / F.lit(BLOCK)).cast("long") for c in ("__lo", "__hi")])),
    )
    first = F.greatest(F.col("__slot") * BLOCK, F.col("__lo"))
    last = F.least(F.col("__slot") * BLOCK + (BLOCK - 1), F.col("__hi"))
    buckets = slots.select(*by, F.explode(F.sequence(first, last)).alias(time))
    return buckets.join(series, [*by, time], "left").na.fill(0.0, values)


def series_frame(
    series: DataFrame, by: list[str] | None = None, time: str = "time_bucket", train: float = 0.8
) -> DataFrame:
    """Adds ``idx`` (position from 0), ``n`` (length), ``n_train``, ``is_train``
    and ``step`` (1 for the first test row).

    The first ``int(n * train)`` rows of a series are its training part. Rows
    count as consecutive even where time buckets are missing.
    """
    by = by or KEY
    slotted = series.withColumn("__slot", F.floor(F.col(time) / F.lit(BLOCK)).cast("long"))
    earlier = Window.partitionBy(*by).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        slotted.groupBy(*by, "__slot")
        .agg(F.count("*").alias("__rows"))
        .select(
            *by,
            "__slot",
            F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"),
            F.sum("__rows").over(Window.partitionBy(*by)).alias("n"),
        )
    )
    inside = Window.partitionBy(*by, "__slot").orderBy(time)
    return (
        slotted.join(sizes, [*by, "__slot"])
        .withColumn("idx", F.col("__before") + F.row_number().over(inside) - 1)
        .withColumn("n_train", F.floor(F.col("n") * F.lit(train)).cast("long"))
        .withColumns(
            {
                "is_train": F.col("idx") < F.col("n_train"),
                "step": F.col("idx") - F.col("n_train") + 1,
            }
        )
        .drop("__slot", "__before")
    )


def lagged(frame: DataFrame, lags: dict[str, int], by: list[str] | None = None) -> DataFrame:
    """Adds ``<column>_<d>`` for d = 1..depth, for each ``{column: depth}``.

    The last rows of a block are copied into the next one, so every lag finds
    its row inside its own block.
    """
    by = by or KEY
    depth = max(lags.values())
    if depth >= BLOCK:
        raise ValueError(f"lags must be shorter than {BLOCK}")
    home = F.floor(F.col("idx") / F.lit(BLOCK)).cast("long")
    near_end = F.pmod(F.col("idx"), F.lit(BLOCK)) >= BLOCK - depth
    blocks = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    order = Window.partitionBy(*by, "__block").orderBy("idx")
    shifted = {
        f"{name}_{d}": F.lag(name, d).over(order) for name, n in lags.items() for d in range(1, n + 1)
    }
    return (
        frame.withColumn("__block", F.explode(blocks))
        .withColumns(shifted)
        .filter(F.col("__block") == home)
        .drop("__block")
    )


def join_series(frame: DataFrame, values: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Joins one-row-per-series values to the rows of a frame.

    Few series are broadcast by their measured size and the frame stays where it is; for many,
    Spark splits the rows of a series that is much longer than the others.
    """
    return frame.join(values, by or KEY)


def train_rows(frame: DataFrame) -> DataFrame:
    return frame.filter("is_train")


def test_rows(frame: DataFrame) -> DataFrame:
    return frame.filter(~F.col("is_train"))
