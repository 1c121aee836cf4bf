"""Models that are linear in lagged values: ARMA, ARIMA, SARIMA and VAR.

The data is read once per model. What a fit needs of a series are sums of
products of lagged values and its first and last few rows; Spark aggregates
those (partial sums per task, a few dozen numbers per series), and a small
numpy step per series solves for the coefficients.

The ARMA family minimises the conditional sum of squares of the full residual
recursion (``recursion``). A good starting point is cheap: with coefficients ``pi`` of
the inverse filter, cut after ``DEPTH`` lags, the residual is a weighted sum of
lagged values and the sum of squares nearly the quadratic form ``pi' G pi``,
where ``G`` follows from the lagged sums and the last rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.operators.timeseries import recursion
from fluxwatch.operators.timeseries.frame import BLOCK, KEY, lagged, train_rows
from fluxwatch.session import written

# Lags of the inverse filter that a starting point looks at, and of the season.
DEPTH = 24
SEASON = 10

MODEL_FIELDS = (
    "model string, k int, nobs long, llf double, aic double, bic double, "
    "params array<double>, state array<double>, matrix array<double>, converged boolean"
)


def model_schema(rows: DataFrame, by: list[str]) -> T.StructType:
    keys = [rows.schema[c] for c in by]
    return T.StructType(keys + T._parse_datatype_string(MODEL_FIELDS).fields)


def lag_sums(frame: DataFrame, value: str, by: list[str], difference: bool = False) -> DataFrame:
    """One row per series: ``nobs``, ``total``, ``sums[d]`` of value times its d-th
    predecessor, the first DEPTH and last 2*DEPTH values, and the last raw value."""
    rows = lagged(train_rows(frame), {value: DEPTH + 1}, by)
    raw = [F.col(value)] + [F.col(f"{value}_{d}") for d in range(1, DEPTH + 2)]
    lag = [raw[d] - raw[d + 1] for d in range(DEPTH + 1)] if difference else raw[: DEPTH + 1]
    first = 1 if difference else 0
    position = F.col("idx") - first

    def some(condition: Column) -> Column:
        kept = F.collect_list(F.when(condition, F.struct("idx", lag[0].alias("v"))))
        return F.transform(F.sort_array(kept), lambda s: s["v"])

    return (
        rows.filter(position >= 0)
        .groupBy(*by)
        .agg(
            F.count("*").alias("nobs"),
            F.count_if(~F.coalesce(F.abs(lag[0].cast("double")) < float("inf"), F.lit(False))).alias("unusable"),
            F.sum(lag[0]).alias("total"),
            F.array(*[F.coalesce(F.sum(lag[0] * x), F.lit(0.0)) for x in lag]).alias("sums"),
            some(position < DEPTH).alias("head"),
            some(F.col("idx") >= F.col("n_train") - 2 * DEPTH).alias("tail"),
            F.max_by(raw[0], "idx").alias("last"),
        )
    )


def _quadratic(sums: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Sums over t of w[t-i] * w[t-j], taking values before the first as 0."""
    size = len(sums)
    w = np.concatenate([np.zeros(max(0, 2 * size - len(tail))), tail])[::-1]
    g = np.empty((size, size))
    for d in range(size):
        lost = np.cumsum(np.r_[0.0, w[: size - 1] * w[d : d + size - 1]])
        for i in range(size - d):
            g[i, i + d] = g[i + d, i] = sums[d] - lost[i]
    return g


def _centre(nobs: int, total: float, sums: np.ndarray, head: np.ndarray, tail: np.ndarray):
    """The same sums for the values minus their mean."""
    mean = total / nobs
    out = np.empty_like(sums)
    for d in range(len(sums)):
        first = head[:d].sum()
        last = tail[max(len(tail) - d, 0) :].sum()
        out[d] = sums[d] - mean * (2 * total - first - last) + max(nobs - d, 0) * mean * mean
    return mean, out, tail - mean


def _inverse_filter(phi: float, theta: float, seasonal: float) -> np.ndarray:
    ar = np.zeros(DEPTH + 1)
    ar[0], ar[1] = 1.0, -phi
    ar[SEASON] -= seasonal
    ar[SEASON + 1] += phi * seasonal
    for j in range(1, DEPTH + 1):
        ar[j] -= theta * ar[j - 1]
    return ar


def _least_squares(g: np.ndarray, free: int) -> tuple[np.ndarray, float]:
    """Coefficients in (-1, 1) with the smallest ``pi' G pi``; Levenberg-Marquardt
    from the best point of a coarse grid."""
    values, vectors = np.linalg.eigh(g)
    root = np.sqrt(np.clip(values, 0.0, None))[:, None] * vectors.T

    def filter_of(u: np.ndarray) -> np.ndarray:
        c = 0.999 * np.tanh(np.r_[u, np.zeros(3 - free)])
        return _inverse_filter(c[0], c[1], c[2])

    grid = np.arctanh([-0.7, -0.3, 0.05, 0.4, 0.8])
    points = np.stack(np.meshgrid(*[grid] * free), -1).reshape(-1, free)
    best = min(points, key=lambda p: float(np.sum((root @ filter_of(p)) ** 2)))
    residual = root @ filter_of(best)
    cost, damping = float(residual @ residual), 1e-3
    for _ in range(60):
        step = 1e-6
        jac = np.stack(
            [(root @ filter_of(best + step * e) - root @ filter_of(best - step * e)) / (2 * step) for e in np.eye(free)],
            1,
        )
        normal, slope = jac.T @ jac, jac.T @ residual
        move = np.linalg.solve(normal + damping * (np.diag(np.diag(normal)) + 1e-12 * np.eye(free)), -slope)
        trial = np.clip(best + move, -4.0, 4.0)
        r = root @ filter_of(trial)
        if r @ r < cost:
            gain = cost - float(r @ r)
            best, residual, cost, damping = trial, r, float(r @ r), max(damping / 5, 1e-12)
            if gain <= 1e-14 * cost:
                break
        else:
            damping *= 10
            if damping > 1e8:
                break
    coefficients = 0.999 * np.tanh(best)
    return np.r_[coefficients, np.zeros(3 - free)], cost


def criteria(llf: float, k: int, nobs: int) -> dict[str, float]:
    return {"llf": llf, "aic": 2 * k - 2 * llf, "bic": k * np.log(nobs) - 2 * llf}


def gaussian_llf(squares: float, nobs: int) -> float:
    return -0.5 * nobs * (np.log(2 * np.pi * squares / nobs) + 1)


def _arma_state(kind: str, phi, theta, seasonal, w: np.ndarray, mean: float, last: float, last_e: float):
    """First forecast and the linear recurrence that continues it.

    The forecast at step h is the first entry of ``matrix^(h-1) @ state``.
    """
    past = np.r_[w[::-1], np.zeros(DEPTH)][:DEPTH]
    ahead = float(phi * past[0] + seasonal * past[SEASON - 1] - phi * seasonal * past[SEASON] + theta * last_e)
    if kind == "arma":
        # (forecast, deviation from the mean, 1)
        return [mean + ahead, ahead, 1.0], [[0.0, phi, mean], [0.0, phi, 0.0], [0.0, 0.0, 1.0]]
    if seasonal == 0.0:
        # (level, change)
        return [last + ahead, ahead], [[1.0, phi], [0.0, phi]]
    # (level, change, earlier changes)
    size = SEASON + 2
    state = [last + ahead, ahead, *past[:SEASON]]
    matrix = np.zeros((size, size))
    step = np.zeros(size)
    step[1] += phi
    step[SEASON] += seasonal
    step[SEASON + 1] -= phi * seasonal
    matrix[1] = step
    matrix[0] = step
    matrix[0, 0] += 1.0
    for i in range(2, size):
        matrix[i, i - 1] = 1.0
    return state, matrix


def _failed(name: str, k: int) -> dict:
    nothing = dict.fromkeys(("nobs", "llf", "aic", "bic", "params", "state", "matrix"))
    return {"model": name, "k": k, **nothing, "converged": False}


def per_series(rows: DataFrame, by: list[str], fit: Callable[[dict], dict], name: str, k: int) -> DataFrame:
    """Applies a small fit to each one-row-per-series summary. A series it fails on
    gets a row of nulls, and the others go on."""
    columns = [c.name for c in model_schema(rows, by)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    result = fit(row)
                except (ArithmeticError, ValueError, np.linalg.LinAlgError):
                    result = _failed(name, k)
                out.append({**{c: row[c] for c in by}, **result})
            yield pd.DataFrame(out, columns=columns)

    return rows.mapInPandas(run, model_schema(rows, by))


#: Models of the ARMA family: number of parameters, free coefficients, fitted to differences.
FAMILY = {"ARMA(1,1)": (4, 2, False), "ARIMA(1,1,1)": (3, 2, True), "SARIMA": (4, 3, True)}


def _usable(row: dict, name: str) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean taken off, lagged sums and last values without it."""
    k, _, difference = FAMILY[name]
    nobs = int(row["nobs"])
    sums, head, tail = (np.asarray(row[c], float) for c in ("sums", "head", "tail"))
    if nobs < 4 + k or row["unusable"]:
        raise ValueError("series too short, or with values that are no numbers")
    mean, w = 0.0, tail
    if not difference:
        mean, sums, w = _centre(nobs, row["total"], sums, head, tail)
    if not sums[0] > 0:
        raise ValueError("constant series")
    return mean, sums, w


def starting_point(row: dict, name: str) -> tuple[np.ndarray, float]:
    """Where the fit of a series begins, and the mean to take off."""
    mean, lagged_sums, w = _usable(row, name)
    return _least_squares(_quadratic(lagged_sums, w), FAMILY[name][1])[0], mean


def arma_row(row: dict, name: str) -> dict:
    """The model row of a series from its sums and the fitted ``p, squares, last_e, converged``."""
    if row["p"] is None or not row["converged"]:
        raise ValueError("not fitted")
    k, free, difference = FAMILY[name]
    mean, _, w = _usable(row, name)
    nobs, squares, (phi, theta, seasonal) = int(row["nobs"]), row["squares"], row["p"]
    state, matrix = _arma_state("arima" if difference else "arma", phi, theta, seasonal, w, mean, row["last"], row["last_e"])
    found = [phi, theta] + ([seasonal] if free == 3 else []) + ([] if difference else [mean])
    return {
        "model": name, "k": k, "nobs": nobs,
        **criteria(gaussian_llf(squares, nobs), k, nobs),
        "params": [*found, squares / nobs],
        "state": list(state),
        "matrix": np.asarray(matrix).ravel().tolist(),
        "converged": True,
    }


def _fit_arma(frame: DataFrame, value: str, by: list[str] | None, name: str) -> DataFrame:
    by = by or KEY
    k, free, difference = FAMILY[name]
    sums = written(lag_sums(frame, value, by, difference), "sums")
    start_schema = T.StructType([sums.schema[c] for c in by] + T._parse_datatype_string("p array<double>, mean double").fields)

    def starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    point, mean = starting_point(row, name)
                except (ArithmeticError, ValueError, np.linalg.LinAlgError):
                    continue
                out.append({**{c: row[c] for c in by}, "p": point, "mean": mean})
            yield pd.DataFrame(out, columns=start_schema.names)

    points = written(sums.mapInPandas(starts, start_schema), "starts")
    season = SEASON if free == 3 else 0
    best = recursion.least_squares(frame, value, by, points, difference, season)
    return per_series(sums.join(best, by, "left"), by, lambda row: arma_row(row, name), name, k)


def fit_arma(frame: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """ARMA(1,1) around the training mean; params: phi, theta, mean, variance."""
    return _fit_arma(frame, value, by, "ARMA(1,1)")


def fit_arima(frame: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """ARIMA(1,1,1) without constant; params: phi, theta, variance."""
    return _fit_arma(frame, value, by, "ARIMA(1,1,1)")


def fit_sarima(frame: DataFrame, value: str = "total", by: list[str] | None = None) -> DataFrame:
    """SARIMA(1,1,1)x(1,0,0,10); params: phi, theta, seasonal phi, variance."""
    return _fit_arma(frame, value, by, "SARIMA")


# ---- vector autoregression -------------------------------------------------


def var_sums(frame: DataFrame, values: tuple[str, str], by: list[str]) -> DataFrame:
    """Cross products of (1, x, y and two lags of both) over the rows that have
    both lags, plus the first two rows, per series."""
    rows = lagged(train_rows(frame), dict.fromkeys(values, 2), by)
    x, y = values
    z = [F.lit(1.0), *[F.col(c) for c in (x, y, f"{x}_1", f"{y}_1", f"{x}_2", f"{y}_2")]]
    full = F.col("idx") >= 2
    products = [
        F.coalesce(F.sum(F.when(full, z[i] * z[j])), F.lit(0.0)) for i in range(7) for j in range(i, 7)
    ]

    def row_at(i: int) -> Column:
        return F.max(F.when(F.col("idx") == i, F.array(F.col(x), F.col(y))))

    return rows.groupBy(*by).agg(
        F.count("*").alias("nobs"),
        F.count_if(~F.coalesce(F.abs(F.col(x) + F.col(y)).cast("double") < float("inf"), F.lit(False))).alias("unusable"),
        F.array(*products).alias("products"),
        row_at(0).alias("first"),
        row_at(1).alias("second"),
        F.max_by(F.array(*z[1:5]), "idx").alias("last"),
    )


def _regress(g: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (one column per equation) and residual cross products."""
    pick = [0, *range(3, 3 + 2 * order)]
    xx, xy, yy = g[np.ix_(pick, pick)], g[np.ix_(pick, [1, 2])], g[1:3, 1:3]
    beta = np.linalg.solve(xx, xy)
    return beta, yy - xy.T @ beta


def var_row(row: dict, order: int | None = None) -> dict:
    """The model row of a series from its cross products."""
    g = np.zeros((7, 7))
    upper = np.triu_indices(7)
    g[upper] = np.asarray(row["products"], float)
    g = g + g.T - np.diag(np.diag(g))
    total = int(row["nobs"])
    if total < 8 or row["unusable"]:
        raise ValueError("series too short, or with values that are no numbers")
    first, second = (np.asarray(row[c], float) for c in ("first", "second"))

    def information(p: int, squares: np.ndarray, nobs: int) -> tuple[float, float, float]:
        sign, logdet = np.linalg.slogdet(squares / nobs)
        if sign <= 0:
            raise ValueError("singular residuals")
        free = 4 * p + 2
        llf = -nobs * np.log(2 * np.pi) - 0.5 * nobs * (logdet + 2)
        return logdet + 2 / nobs * free, logdet + np.log(nobs) / nobs * free, llf

    if order is None:
        p = min(range(3), key=lambda p: information(p, _regress(g, p)[1], total - 2)[0])
    else:
        p = order
    # rows before the third enter where the order allows
    if p < 2:
        z = np.zeros(7)
        z[[0, 1, 2, 3, 4]] = [1.0, *second, *first]
        g = g + np.outer(z, z)
    if p < 1:
        z = np.zeros(7)
        z[[0, 1, 2]] = [1.0, *first]
        g = g + np.outer(z, z)
    beta, squares = _regress(g, p)
    nobs = total - p
    aic, bic, llf = information(p, squares, nobs)
    # state: (sum of both, x, y, previous x, previous y, 1), one step ahead
    matrix = np.zeros((6, 6))
    matrix[1:3, 5] = beta[0]
    for j in range(p):
        matrix[1:3, 1 + 2 * j : 3 + 2 * j] = beta[1 + 2 * j : 3 + 2 * j].T
    matrix[0] = matrix[1] + matrix[2]
    matrix[3, 1] = matrix[4, 2] = matrix[5, 5] = 1.0
    x, y, x1, y1 = np.asarray(row["last"], float)
    state = matrix @ np.array([x + y, x, y, x1, y1, 1.0])
    return {
        "model": "VAR", "k": 4 * p + 2, "nobs": nobs, "llf": llf, "aic": aic, "bic": bic,
        "params": beta.ravel().tolist(), "state": state.tolist(), "matrix": matrix.ravel().tolist(),
        "converged": True,
    }


def fit_var(
    frame: DataFrame,
    values: tuple[str, str] = ("tx", "rx"),
    by: list[str] | None = None,
    order: int | None = None,
) -> DataFrame:
    """Two-variable VAR with constant; order 0..2 chosen by AIC on the rows all
    orders share, then fitted on all rows that order can use. The forecast is the
    sum of both variables. Params: constants, then lag matrices row by row."""
    by = by or KEY
    return per_series(var_sums(frame, values, by), by, lambda row: var_row(row, order), "VAR", 2 if order is None else 4 * order + 2)


# ---- forecasts --------------------------------------------------------------


def forecast(models: DataFrame, frame: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Forecasts at every test step of every series: ``by, model, step, yhat``.

    Long horizons are produced in parts of BLOCK steps; a part starts from a
    matrix power instead of the part before it.
    """
    by = by or KEY
    parts = (
        frame.filter(F.col("step") >= 1)
        .groupBy(*by, F.floor((F.col("step") - 1) / F.lit(BLOCK)).cast("long").alias("part"))
        .agg(F.max("step").alias("end"))
    )
    jobs = models.filter(F.col("state").isNotNull()).select(*by, "model", "state", "matrix").join(parts, by)
    schema = T.StructType(
        [jobs.schema[c] for c in by]
        + T._parse_datatype_string("model string, start long, path array<double>").fields
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # states of one size go on together, a step of all of them at a time
            for size, part in batch.groupby(batch["state"].map(len)):
                state = np.array(part["state"].tolist(), float)
                matrix = np.array(part["matrix"].tolist(), float).reshape(-1, size, size)
                start = part["part"].to_numpy(np.int64) * BLOCK
                for at in np.unique(start[start > 0]):
                    rows = np.flatnonzero(start == at)
                    state[rows] = np.einsum("nij,nj->ni", np.linalg.matrix_power(matrix[rows], int(at)), state[rows])
                sizes = part["end"].to_numpy(np.int64) - start
                paths = np.empty((len(part), int(sizes.max())))
                for i in range(paths.shape[1]):
                    paths[:, i] = state[:, 0]
                    state = np.einsum("nij,nj->ni", matrix, state)
                yield part[[*by, "model"]].assign(start=start, path=[p[:n] for p, n in zip(paths, sizes)])

    made = jobs.mapInPandas(run, schema)
    return made.select(*by, "model", "start", F.posexplode("path").alias("at", "yhat")).select(
        *by, "model", (F.col("start") + F.col("at") + 1).alias("step"), "yhat"
    )
