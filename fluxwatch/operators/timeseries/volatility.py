"""ARCH(1) and GARCH(1,1) with constant mean, normal likelihood, by scoring.

Variance: h[t] = omega + alpha * r[t-1]^2 + beta * h[t-1], r = y - mu. The run
starts from a back-cast: the mean of the first squared deviations with weights
falling by 0.94. Likelihoods are in the unit of the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.operators.timeseries.blocks import (
    Cells,
    _cells,
    _chunks,
    block_carries,
    chosen_start,
    fit_blocks,
    likelihood_rows,
    many_blocks,
    pack,
    per_block,
)
from fluxwatch.operators.timeseries.frame import BLOCK, KEY, train_rows

# Back-cast decay and the number of rows it looks at.
DECAY, DECAY_ROWS = 0.94, 75

# p: mu, omega, alpha, beta | last accepted mu..beta, its likelihood, step size
#    and the step | relative change
_MU, _OMEGA, _ALPHA, _BETA = range(4)
_GOOD, _LLF, _SIZE, _STEP, _CHANGE = slice(4, 8), 8, 9, slice(10, 14), 14


class Garch:
    """Scoring rounds with step halving; ``beta_free`` False gives ARCH."""

    def __init__(self, beta_free: bool):
        self.free = [0, 1, 2, 3] if beta_free else [0, 1, 2]

    # ---- carry: h and its derivatives by mu, omega, alpha, beta ----

    def enter(self, p: np.ndarray) -> np.ndarray:
        return np.zeros((len(p), 5))

    leave = enter

    def _run(self, p: np.ndarray, data: Cells, into: np.ndarray) -> np.ndarray:
        """Variance and its derivatives at every cell, [cell, block, 5]. Padding
        follows the last value of a block, so it only has to be ignored later."""
        mu, omega, alpha, beta = (p[:, i, None] for i in range(4))
        backcast = data.extra[:, :1]
        opening = np.zeros(data.y.shape, bool)
        opening[:, 0] = data.first
        r = np.where(opening, 0.0, data.x - mu)
        before = np.where(opening, backcast, r * r)
        # what enters each cell besides the state: all but the variance before
        enters = np.stack(
            [omega + alpha * before, -2 * alpha * r, np.ones_like(r), before, np.zeros_like(r)], 2
        ).transpose(1, 0, 2)
        state = into.copy()
        state[data.first, 0] = backcast[data.first, 0]
        out = np.empty(enters.shape)
        for t in range(len(out)):
            after = np.add(beta * state, enters[t], out=out[t])
            after[:, 4] += state[:, 0]
            state = after
        return out

    def advance(self, p: np.ndarray, data: Cells) -> np.ndarray:
        """Length and end state from a zero start; the first block starts the series."""
        length = data.ok.sum(1)
        path = self._run(p, data, self.enter(p))
        end = path[length - 1, np.arange(len(p))]
        return np.concatenate([length[:, None].astype(float), end], 1)

    def forward(self, p: np.ndarray, state: np.ndarray, m: np.ndarray) -> np.ndarray:
        beta, length = p[_BETA], m[0]
        out = m[1:] + beta**length * state
        out[4] += length * beta ** max(length - 1, 0) * state[0] if beta else float(length == 1) * state[0]
        return out

    def backward(self, p: np.ndarray, state: np.ndarray, m: np.ndarray) -> np.ndarray:
        return state

    def combine(self, p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.r_[a[0] + b[0], self.forward(p, a[1:], b)]

    # ---- one round ----

    def sums(self, p: np.ndarray, data: Cells, into: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Likelihood, rows, score (4) and information (10) of each block."""
        path = self._run(p, data, into).transpose(1, 0, 2)
        h = np.where(data.ok, path[:, :, 0], 1.0)
        r = np.where(data.ok, data.y - p[:, :1], 0.0)
        square = r * r / h
        llf = -0.5 * np.where(data.ok, np.log(2 * np.pi * h) + square, 0.0).sum(1)
        slope = path[:, :, 1:] / h[:, :, None] * data.ok[:, :, None]
        score = 0.5 * np.einsum("nt,nti->ni", square - 1, slope)
        score[:, _MU] += (r / h).sum(1)
        info = 0.5 * np.matmul(slope.transpose(0, 2, 1), slope)
        info[:, _MU, _MU] += np.where(data.ok, 1 / h, 0.0).sum(1)
        upper = np.triu_indices(4)
        rows = data.ok.sum(1).astype(float)
        return np.concatenate([llf[:, None], rows[:, None], score, info[:, upper[0], upper[1]]], 1)

    def update(self, p: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Accepts the last step if the likelihood rose and takes a scoring step;
        otherwise halves the step from the last accepted point."""
        out = p.copy()
        llf = s[:, 0]
        score = s[:, 2:6]
        info = np.zeros((len(p), 4, 4))
        upper = np.triu_indices(4)
        info[:, upper[0], upper[1]] = s[:, 6:16]
        info[:, upper[1], upper[0]] = s[:, 6:16]
        for i in range(len(p)):
            better = np.isfinite(llf[i]) and not llf[i] < p[i, _LLF]
            if better:
                out[i, _GOOD], out[i, _LLF], out[i, _SIZE] = p[i, :4], llf[i], 1.0
                move = np.zeros(4)
                # alpha and beta stay at zero where the likelihood falls away from it
                free = [j for j in self.free if j < _ALPHA or p[i, j] > 1e-12 or score[i, j] > 0]
                scale = np.sqrt(np.maximum(np.diag(info[i])[free], 1e-300))
                a = info[i][np.ix_(free, free)] / np.outer(scale, scale) + 1e-10 * np.eye(len(free))
                if np.all(np.isfinite(a)):
                    move[free] = np.linalg.lstsq(a, score[i, free] / scale, rcond=None)[0] / scale
                out[i, _STEP] = move
            else:
                out[i, _SIZE] = p[i, _SIZE] / 2
            point = self._inside(out[i, _GOOD] + out[i, _SIZE] * out[i, _STEP], out[i, _GOOD])
            unit = np.abs(point) + [np.sqrt(out[i, _OMEGA]), 0.0, 0.01, 0.01]
            # settled: neither the parameters move nor the likelihood rises
            gain = abs(llf[i] - p[i, _LLF]) / (1 + abs(llf[i])) if better else 0.0
            out[i, _CHANGE] = max(np.max(np.abs(point - p[i, :4]) / unit), gain)
            out[i, :4] = point
        return out

    def _inside(self, trial: np.ndarray, good: np.ndarray) -> np.ndarray:
        trial = np.where(np.isfinite(trial), trial, good)
        trial[_OMEGA] = max(trial[_OMEGA], good[_OMEGA] * 0.05)
        trial[_ALPHA] = min(max(trial[_ALPHA], 0.0), 0.9999)
        trial[_BETA] = min(max(trial[_BETA], 0.0), 0.9999) if 3 in self.free else 0.0
        total = trial[_ALPHA] + trial[_BETA]
        if total > 0.9999:
            trial[_ALPHA] *= 0.9999 / total
            trial[_BETA] *= 0.9999 / total
        return trial


# Starting (alpha, beta); omega follows from the variance.
_STARTS = {False: [(0.1, 0.0), (0.4, 0.0)], True: [(0.05, 0.9), (0.1, 0.6), (0.3, 0.2), (0.1, 0.0)]}


def opening_moments(frame: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Rows, mean, variance and back-cast of the training part of every series."""
    weight = F.when(F.col("idx") < DECAY_ROWS, F.pow(F.lit(DECAY), F.col("idx")))
    y = F.col(value).cast("double")
    mean, w = F.avg(y), F.sum(weight)
    backcast = (F.sum(weight * y * y) - 2 * mean * F.sum(weight * y)) / w + mean * mean
    return train_rows(frame).groupBy(*by).agg(
        F.count("*").alias("nobs"),
        mean.alias("mean"),
        F.var_pop(y).alias("variance"),
        F.greatest(backcast, F.lit(0.0)).alias("backcast"),
        F.count_if(~F.coalesce(F.abs(y) < float("inf"), F.lit(False))).alias("unusable"),
    )


def starts_of(y: np.ndarray, beta_free: bool) -> tuple[float, list[list[float]]]:
    """Back-cast and starting parameters of the training values of one series, as :func:`_fit` has them."""
    k = 4 if beta_free else 3
    variance = float(y.var()) if len(y) else 0.0
    if len(y) < 4 + k or not variance > 0:
        raise ValueError("series too short, constant, or with values that are no numbers")
    mean, early = float(y.mean()), y[:DECAY_ROWS]
    weight = DECAY ** np.arange(len(early))
    backcast = float((weight * early) @ early - 2 * mean * (weight @ early)) / float(weight.sum()) + mean * mean
    points = [[mean, variance * (1 - a - b), a, b, *[0.0] * 4, -1e300, 1.0, *[0.0] * 4, 1.0] for a, b in _STARTS[beta_free]]
    return max(backcast, 0.0), points


def _fit(frame: DataFrame, value: str, by: list[str] | None, beta_free: bool, rounds: int) -> DataFrame:
    by = by or KEY
    name, k = ("GARCH(1,1)", 4) if beta_free else ("ARCH(1)", 3)
    moments = opening_moments(frame, value, by)
    usable = moments.filter((F.col("nobs") >= 4 + k) & (F.col("variance") > 0) & (F.col("unusable") == 0))
    starts = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("start"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                for i, (a, b) in enumerate(_STARTS[beta_free])
            ]
        )
    ).alias("s")
    nothing = [F.lit(0.0)] * 4
    params = usable.select(*by, "mean", "variance", "backcast", starts).select(
        *by,
        "s.start",
        F.array("backcast").alias("extra"),
        F.array(
            F.col("mean"), F.col("variance") * (1 - F.col("s.a") - F.col("s.b")), F.col("s.a"), F.col("s.b"),
            *nothing, F.lit(-1e300), F.lit(1.0), *nothing, F.lit(1.0),
        ).alias("p"),
    )
    fitted = fit_blocks(frame, value, params, by, Garch(beta_free), rounds)
    # a start whose likelihood was never finite is no fit
    finite = fitted.filter(F.element_at("p", _LLF + 1) > -1e299)
    best = chosen_start(finite, by, _LLF)
    return likelihood_rows(moments, best, by, name, k, _LLF, F.col("nobs"), F.slice("p", 5, k))


def fit_arch(frame: DataFrame, value: str = "total", by: list[str] | None = None, rounds: int = 100) -> DataFrame:
    """ARCH(1); params: mu, omega, alpha. No forecast of the level."""
    return _fit(frame, value, by, False, rounds)


def fit_garch(frame: DataFrame, value: str = "total", by: list[str] | None = None, rounds: int = 200) -> DataFrame:
    """GARCH(1,1); params: mu, omega, alpha, beta. No forecast of the level."""
    return _fit(frame, value, by, True, rounds)


def variance_path(
    frame: DataFrame, params: DataFrame, value: str = "total", by: list[str] | None = None
) -> DataFrame:
    """Conditional variance at every row: ``by, idx, r, variance``.

    ``params`` has one row per series with ``params`` = mu, omega, alpha and
    optionally beta; the variance runs over training and test rows.
    """
    by = by or KEY
    model = Garch(True)
    full = params.filter(F.col("params").isNotNull()).select(
        *by, F.slice(F.concat("params", F.array(F.lit(0.0))), 1, 4).alias("p")
    )
    backcast = opening_moments(frame, value, by).select(*by, F.array("backcast").alias("extra"))
    given = full.join(backcast, by)
    schema = T.StructType(
        [given.schema[c] for c in by]
        + T._parse_datatype_string("seg long, r array<double>, variance array<double>").fields
    )

    def run(batches):
        for batch in batches:
            for chunk in _chunks(batch):
                data = _cells(chunk)
                p = np.asarray(chunk["p"].tolist(), float)
                into = np.asarray(chunk["into"].tolist(), float) if "into" in chunk else model.enter(p)
                path = model._run(p, data, into)[:, :, 0].T
                lengths = data.ok.sum(1)
                r = data.y - p[:, [0]]
                yield chunk[[*by, "seg"]].assign(
                    r=[v[:n] for v, n in zip(r, lengths)],
                    variance=[v[:n] for v, n in zip(path, lengths)],
                )

    # only series of several blocks have a state to carry between them
    brief = per_block(pack(frame.filter(F.col("n") <= BLOCK), value, by), given, by)
    made = brief.mapInPandas(run, schema)
    if not frame.filter(F.col("idx") == BLOCK).isEmpty():
        blocks = per_block(pack(frame.filter(F.col("n") > BLOCK), value, by), given.drop("p"), by)
        linked = blocks.join(block_carries(blocks, full, by, model, many_blocks(frame)), [*by, "seg"])
        made = made.unionByName(linked.mapInPandas(run, schema))
    return made.select(
        *by, "seg", F.posexplode(F.arrays_zip("r", "variance")).alias("at", "v")
    ).select(*by, (F.col("seg") * BLOCK + F.col("at")).alias("idx"), "v.r", "v.variance")
