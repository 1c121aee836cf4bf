"""All models of series that fit one block: packed once, fitted in one pass of tasks.

A series of up to BLOCK training rows becomes one row of arrays, one copy for each model; copies are
dealt by series and model, and a task fits those of one model side by side. The numbers
are those of the fits one by one (``linear``, ``volatility``, ``regimes``), which longer series take.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.operators.timeseries import linear, recursion, regimes, volatility
from fluxwatch.operators.timeseries.blocks import CELLS, SETTLED, solved
from fluxwatch.operators.timeseries.frame import BLOCK, KEY, train_rows

VALUES = ("total", "tx", "rx")
#: The models fitted by likelihood rounds: number of parameters, where they and the likelihood lie, rounds.
ROUNDS = {
    "ARCH(1)": (3, slice(4, 7), volatility._LLF, 100),
    "GARCH(1,1)": (4, slice(4, 8), volatility._LLF, 200),
    "TAR": (7, slice(0, 7), regimes._LLF, 400),
}


def packed(frame: DataFrame, by: list[str]) -> DataFrame:
    """One row per series of at most one block: its training values in order, no number as NaN."""
    cells = F.struct("idx", *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in VALUES])
    rows = train_rows(frame).filter(F.col("n_train") <= BLOCK)
    packs = rows.groupBy(*by).agg(F.sort_array(F.collect_list(cells)).alias("rows"))
    return packs.select(*by, *[F.col(f"rows.{c}").alias(c) for c in VALUES])


def lag_row(y: np.ndarray, difference: bool) -> dict:
    """The sums of :func:`linear.lag_sums` of one series."""
    w = np.diff(y) if difference else y
    n, depth = len(w), linear.DEPTH
    return {
        "nobs": n, "unusable": int((~np.isfinite(w)).sum()), "total": float(w.sum()),
        "sums": [float(w[d:] @ w[: n - d]) if d < n else 0.0 for d in range(depth + 1)],
        "head": w[:depth], "tail": w[max(0, len(y) - 2 * depth - int(difference)) :], "last": float(y[-1]),
    }


def var_summary(x: np.ndarray, y: np.ndarray) -> dict:
    """The cross products of :func:`linear.var_sums` of one series."""
    n = len(x)
    pairs = np.stack([x, y], 1)
    z = np.concatenate([np.ones((max(n - 2, 0), 1)), pairs[2:], pairs[1:-1][: max(n - 2, 0)], pairs[:-2]], 1)
    return {
        "nobs": n, "unusable": int((~np.isfinite(x + y)).sum()), "products": (z.T @ z)[np.triu_indices(7)],
        "first": pairs[0], "second": pairs[min(1, n - 1)], "last": np.r_[pairs[-1], pairs[max(n - 2, 0)]],
    }


def _family(series: list[np.ndarray], name: str) -> list[dict]:
    _, free, difference = linear.FAMILY[name]
    rows = [lag_row(y, difference) for y in series]
    fits: list[int] = []
    starts: list[tuple[np.ndarray, float]] = []
    for i, row in enumerate(rows):
        row["p"] = None
        try:
            starts.append(linear.starting_point(row, name))
            fits.append(i)
        except (ArithmeticError, ValueError, np.linalg.LinAlgError):
            continue
    if fits:
        lags = [0, 1] + ([linear.SEASON, linear.SEASON + 1] if free == 3 else [])
        sizes = np.array([rows[i]["nobs"] for i in fits])
        w = [np.full((len(fits), int(sizes.max())), np.nan) for _ in lags]
        for at, i in enumerate(fits):
            values = np.diff(series[i]) if difference else series[i]
            for d, matrix in zip(lags, w):
                matrix[at, d : len(values)] = values[: max(len(values) - d, 0)]
        ok = np.arange(w[0].shape[1])[None, :] < sizes[:, None]
        points, means = np.array([p for p, _ in starts]), np.array([m for _, m in starts])
        for i, found in zip(fits, recursion.outcome(recursion.solved(w, ok, points, means, free, recursion.ROUNDS))):
            rows[i].update(found)
    return [_row(lambda: linear.arma_row(row, name), name, linear.FAMILY[name][0]) for row in rows]


def _row(fit, name: str, k: int) -> dict:
    try:
        return fit()
    except (ArithmeticError, ValueError, np.linalg.LinAlgError):
        return linear._failed(name, k)


def _likelihood(series: list[np.ndarray], name: str) -> list[dict]:
    k, place, llf_at, rounds = ROUNDS[name]
    out = [linear._failed(name, k) for _ in series]
    owner, extra, points = [], [], []
    for i, y in enumerate(series):
        try:
            if not np.isfinite(y).all():
                raise ValueError("values that are no numbers")
            backcast, starts = (0.0, regimes.starts_of(y)) if name == "TAR" else volatility.starts_of(y, k == 4)
        except ValueError:
            continue
        owner += [i] * len(starts)
        extra += [[backcast]] * len(starts)
        points += starts
    if not owner:
        return out
    model = regimes.Switching() if name == "TAR" else volatility.Garch(k == 4)
    chunk = pd.DataFrame({"y": [series[i] for i in owner], "before": np.nan, "extra": extra, "p": points})
    p = solved(chunk, model, rounds)
    owner = np.array(owner)
    for i in np.unique(owner):
        mine = p[owner == i]
        if name != "TAR":  # a start whose likelihood was never finite is no fit
            mine = mine[mine[:, llf_at] > -1e299]
        if not len(mine):
            continue
        best = max(mine, key=lambda q: (bool(q[-1] <= SETTLED), np.nan_to_num(q[llf_at], nan=-np.inf)))
        out[i]["params"] = best[place]
        if best[-1] <= SETTLED:
            nobs = len(series[i]) - (name == "TAR")
            out[i].update(nobs=nobs, converged=True, **linear.criteria(float(best[llf_at]), k, nobs))
    return out


def model_rows(batch: pd.DataFrame, name: str) -> list[dict]:
    """The rows of one model for packed series."""
    with np.errstate(all="ignore"):
        if name == "VAR":
            pairs = zip(batch["tx"], batch["rx"])
            return [_row(lambda: linear.var_row(var_summary(np.asarray(x), np.asarray(y))), "VAR", 2) for x, y in pairs]
        series = [np.asarray(y, float) for y in batch["total"]]
        return (_family if name in linear.FAMILY else _likelihood)(series, name)


def fit_single(frame: DataFrame, names: list[str], by: list[str] | None = None) -> DataFrame:
    """Model rows and ``fit_seconds`` (a series' share of the time its task took for the model) of all
    series with at most BLOCK training rows."""
    by = by or KEY
    packs = packed(frame, by)
    fields = linear.model_schema(packs, by).fields + [T.StructField("fit_seconds", T.DoubleType())]
    spark = frame.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    copies = packs.withColumn("model", F.explode(F.array(*[F.lit(n) for n in names])))
    dealt = copies.repartition(parts, *by, "model").sortWithinPartitions("model")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, same in batch.groupby("model", sort=False):
                most = max(1, CELLS // max(1, int(same["total"].map(len).max())) // 8)
                for at in range(0, len(same), most):
                    begun = time.monotonic()
                    part = same.iloc[at : at + most].reset_index(drop=True)
                    made = pd.DataFrame(model_rows(part, name), columns=[f.name for f in fields[len(by) : -1]])
                    yield part[by].join(made).assign(fit_seconds=(time.monotonic() - begun) / len(part))

    return dealt.mapInPandas(run, T.StructType(fields))
