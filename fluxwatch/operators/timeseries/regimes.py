"""Two-regime switching autoregression of order one, by expectation-maximisation.

y[t] - m[s] = f[s] * (y[t-1] - m[s']) + e, with regime s now, s' one row before,
one variance, and a Markov chain over the regimes that starts in its stationary
distribution. Seven parameters; the first row only serves as a predecessor.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwatch.operators.timeseries.blocks import Cells, chosen_start, fit_blocks, likelihood_rows
from fluxwatch.operators.timeseries.frame import KEY, lagged, train_rows

# p: P(0 to 0), P(1 to 0), m0, m1, f0, f1, variance, likelihood (of the p before),
#    relative change of the likelihood
_P00, _P10, _M, _F, _V, _LLF = 0, 1, slice(2, 4), slice(4, 6), 6, 7
_TINY = 1e-300


class Switching:
    def _chain(self, p: np.ndarray) -> np.ndarray:
        """[to, from] transition matrix of every set of parameters."""
        to0 = np.stack([p[..., _P00], p[..., _P10]], -1)
        return np.stack([to0, 1 - to0], -2)

    def enter(self, p: np.ndarray) -> np.ndarray:
        leave0, to0 = 1 - p[:, _P00], p[:, _P10]
        share = to0 / np.maximum(leave0 + to0, _TINY)
        return np.stack([share, 1 - share], 1)

    def leave(self, p: np.ndarray) -> np.ndarray:
        return np.ones((len(p), 2))

    def _weights(self, p: np.ndarray, data: Cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Transition times density at every cell, [cell, block, now, before], scaled,
        the log of the scale, and which cells count. Rows without a predecessor and
        padding change nothing."""
        m, f, v = p[:, _M], p[:, _F], p[:, _V, None]
        used = data.ok.copy()
        used[:, 0] &= ~data.first
        x = np.where(used, data.x, 0.0)
        plain = data.y[:, :, None] - f[:, None, :] * x[:, :, None] - m[:, None, :]
        e = plain[:, :, :, None] + (f[:, :, None] * m[:, None, :])[:, None]
        power = -0.5 * e * e / v[:, :, None, None]
        top = power.max((2, 3))
        dense = self._chain(p)[:, None] * np.exp(power - top[:, :, None, None])
        dense = np.where(used[:, :, None, None], dense, np.eye(2))
        scale = np.where(used, top - 0.5 * np.log(2 * np.pi * v), 0.0)
        return np.ascontiguousarray(dense.transpose(1, 0, 2, 3)), scale, used

    def advance(self, p: np.ndarray, data: Cells) -> np.ndarray:
        """Product of the block's weights, as four numbers of sum 1."""
        whole = np.tile(np.eye(2), (len(p), 1, 1))
        for w in self._weights(p, data)[0]:
            whole = np.matmul(w, whole)
            whole /= np.maximum(whole.sum((1, 2), keepdims=True), _TINY)
        return whole.reshape(len(p), 4)

    def forward(self, p, state, m):
        state = m.reshape(2, 2) @ state
        return state / max(state.sum(), _TINY)

    def backward(self, p, state, m):
        state = state @ m.reshape(2, 2)
        return state / max(state.sum(), _TINY)

    def combine(self, p, a, b):
        whole = b.reshape(2, 2) @ a.reshape(2, 2)
        return (whole / max(whole.sum(), _TINY)).ravel()

    def sums(self, p: np.ndarray, data: Cells, into: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Likelihood, then for every (now, before) pair the probability-weighted
        sums of 1, y, x, y^2, xy, x^2."""
        n, width = data.y.shape
        weights, scale, used = self._weights(p, data)
        alpha = np.empty((width + 1, n, 2, 1))
        mass = np.empty((width, n, 1, 1))
        alpha[0, :, :, 0] = into / into.sum(1, keepdims=True)
        for t in range(width):
            ahead = np.matmul(weights[t], alpha[t])
            mass[t] = np.maximum(ahead.sum(1, keepdims=True), _TINY)
            np.divide(ahead, mass[t], out=alpha[t + 1])
        llf = np.log(mass[:, :, 0, 0]).sum(0) + scale.sum(1)
        beta = np.empty((width, n, 1, 2))
        later = (out / out.sum(1, keepdims=True))[:, None, :]
        for t in range(width - 1, -1, -1):
            beta[t] = later
            later = np.matmul(later, weights[t])
            later /= np.maximum(later.sum(2, keepdims=True), _TINY)
        pair = beta.transpose(0, 1, 3, 2) * weights * alpha[:-1].transpose(0, 1, 3, 2)
        pair /= np.maximum(pair.sum((2, 3), keepdims=True), _TINY)
        y, x = np.where(used, data.y, 0.0), np.where(used, data.x, 0.0)
        terms = np.stack([used.astype(float), y, x, y * y, x * y, x * x], 2)
        found = np.matmul(pair.transpose(1, 2, 3, 0).reshape(n, 4, width), terms)
        return np.concatenate([llf[:, None], found.reshape(n, 24)], 1)

    def update(self, p: np.ndarray, s: np.ndarray) -> np.ndarray:
        n = len(p)
        out = p.copy()
        out[:, -1] = np.abs(s[:, 0] - p[:, _LLF]) / (1 + np.abs(s[:, 0]))
        out[:, _LLF] = s[:, 0]
        one, y, x, yy, xy, xx = np.moveaxis(s[:, 1:].reshape(n, 2, 2, 6), -1, 0)
        before = np.maximum(one.sum(1), _TINY)
        out[:, [_P00, _P10]] = np.clip(one[:, 0] / before, 1e-6, 1 - 1e-6)
        m, f = p[:, _M].copy(), p[:, _F].copy()
        for _ in range(8):
            # means for given slopes: two normal equations
            a, b = np.zeros((n, 2, 2)), np.zeros((n, 2))
            for i in range(2):
                for j in range(2):
                    d = np.zeros((n, 2))
                    d[:, i] += 1.0
                    d[:, j] -= f[:, i]
                    a += one[:, i, j, None, None] * d[:, :, None] * d[:, None, :]
                    b += d * (y[:, i, j] - f[:, i] * x[:, i, j])[:, None]
            det = a[:, 0, 0] * a[:, 1, 1] - a[:, 0, 1] ** 2
            new = np.stack(
                [a[:, 1, 1] * b[:, 0] - a[:, 0, 1] * b[:, 1], a[:, 0, 0] * b[:, 1] - a[:, 0, 1] * b[:, 0]], 1
            ) / np.where(det > _TINY, det, 1.0)[:, None]
            m = np.where((det > _TINY)[:, None], new, m)
            # slopes for given means
            now, past = m[:, :, None], m[:, None, :]
            top = (xy - now * x - past * y + now * past * one).sum(2)
            low = (xx - 2 * past * x + past * past * one).sum(2)
            f = np.where(low > _TINY, top / np.maximum(low, _TINY), f)
        now, past, slope = m[:, :, None], m[:, None, :], f[:, :, None]
        c = now - slope * past
        squares = yy + slope**2 * xx + c * c * one - 2 * slope * xy - 2 * c * y + 2 * slope * c * x
        rows = np.maximum(one.sum((1, 2)), _TINY)
        variance = squares.sum((1, 2)) / rows
        floor = 1e-8 * np.maximum(yy.sum((1, 2)) / rows - (y.sum((1, 2)) / rows) ** 2, _TINY)
        out[:, _M], out[:, _F], out[:, _V] = m, f, np.maximum(variance, floor)
        # settled: neither the likelihood rises nor the parameters move; near the top a move counts squared
        level = np.abs(m) + np.sqrt(out[:, _V])[:, None]
        scale = np.concatenate([np.ones((n, 2)), level, 1 + np.abs(f), out[:, [_V]]], 1)
        moved = (np.abs(out[:, :7] - p[:, :7]) / scale).max(1)
        out[:, -1] = np.maximum(out[:, -1], moved * moved)
        return out


def starts_of(y: np.ndarray) -> list[list[float]]:
    """Starting parameters of the training values of one series, as :func:`fit_switching` has them."""
    d = float(y.std()) if len(y) else 0.0
    if len(y) < 12 or not d > 0:
        raise ValueError("series too short, constant, or with values that are no numbers")
    now, before, m = y[1:], y[:-1], float(y.mean())
    spread = float(before.var())
    f = float(((now - now.mean()) * (before - before.mean())).mean()) / spread if spread > 0 else 0.0
    chosen = ((0.9, 0.1, -0.8, 0.8, f, f), (0.95, 0.3, -0.2, 1.5, f * 0.5, f), (0.8, 0.2, 0.0, 0.1, f - 0.4, f + 0.4))
    return [[stay, go, m + a * d, m + b * d, f0, f1, d * d * 0.5, -1e300, 1.0] for stay, go, a, b, f0, f1 in chosen]


def fit_switching(
    frame: DataFrame, value: str = "total", by: list[str] | None = None, rounds: int = 400
) -> DataFrame:
    """Switching autoregression; params: P(0 to 0), P(1 to 0), means, slopes, variance.
    No forecast of the level."""
    by = by or KEY
    y = F.col(value).cast("double")
    rows = lagged(train_rows(frame), {value: 1}, by)
    before = F.col(f"{value}_1").cast("double")
    slope = F.try_divide(F.covar_pop(y, before), F.var_pop(before))
    moments = rows.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.avg(y).alias("m"),
        F.stddev_pop(y).alias("d"),
        F.coalesce(slope, F.lit(0.0)).alias("f"),
    )
    usable = moments.filter((F.col("rows") >= 12) & (F.col("d") > 0))
    m, d, f = F.col("m"), F.col("d"), F.col("f")

    def start(i: int, stay0: float, go0: float, lift0: float, lift1: float, f0, f1) -> F.Column:
        return F.struct(
            F.lit(i).alias("start"),
            F.array(
                F.lit(stay0), F.lit(go0), m + lift0 * d, m + lift1 * d, f0, f1,
                d * d * 0.5, F.lit(-1e300), F.lit(1.0),
            ).alias("p"),
        )

    choices = F.array(
        start(0, 0.9, 0.1, -0.8, 0.8, f, f),
        start(1, 0.95, 0.3, -0.2, 1.5, f * 0.5, f),
        start(2, 0.8, 0.2, 0.0, 0.1, f - 0.4, f + 0.4),
    )
    params = (
        usable.select(*by, F.explode(choices).alias("s"))
        .select(*by, "s.*")
        .withColumn("extra", F.array(F.lit(0.0)))
    )
    fitted = fit_blocks(frame, value, params, by, Switching(), rounds)
    best = chosen_start(fitted, by, _LLF)
    return likelihood_rows(moments, best, by, "TAR", 7, _LLF, F.col("rows") - 1, F.slice("p", 1, 7))
