"""Residuals of the ARMA family by their full recursion, in blocks.

``e[t] = w[t] - phi w[t-1] - seasonal w[t-10] + phi seasonal w[t-11] - theta e[t-1]``, with values and
residuals before the first taken as 0. The residuals and their derivatives are linear in what a block
is handed, so a block is summed up once for all carries: six sequences (residual and its three
derivatives from nothing, and what a unit residual carried in adds to the residual and to the
derivative by theta), their products and their last entries. Two neighbouring summaries make one of
the same form, so a long series is combined in levels and no task holds more than FAN of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.operators.timeseries.blocks import CELLS, FAN
from fluxwatch.operators.timeseries.frame import BLOCK, lagged, train_rows
from fluxwatch.session import written

# Places in a summary: residual, derivatives by phi, seasonal and theta; responses to a unit carried in.
E, A, S, B, G, H = range(6)
#: Largest coefficient, relative gain at which a fit has settled, rounds until it counts as failed.
EDGE, GAIN, ROUNDS = 0.999, 1e-13, 400
# State of a fit: trial point, best point, its cost, damping, normal matrix, slope, status, last residual at the best point.
_TRIAL, _BEST, _COST, _DAMP, _NORMAL, _SLOPE, _DONE, _LAST = slice(0, 3), slice(3, 6), 6, 7, slice(8, 17), slice(17, 20), 20, 21
SIZE = 22


def pack_lags(frame: DataFrame, value: str, by: list[str], difference: bool, season: int) -> DataFrame:
    """One row per (series, block): the values and those 1, ``season`` and ``season + 1`` before."""
    depth = (season + 1 if season else 1) + difference
    rows = lagged(train_rows(frame), {value: depth}, by)

    def at(d: int):
        raw = F.col(value if d == 0 else f"{value}_{d}").cast("double")
        return raw - F.col(f"{value}_{d + 1}").cast("double") if difference else raw

    wanted = [0, 1] + ([season, season + 1] if season else [])
    cells = F.struct("idx", *[F.coalesce(at(d), F.lit(float("nan"))).alias(f"v{d}") for d in wanted])
    packed = (
        rows.filter(F.col("idx") >= int(difference))
        .groupBy(*by, F.floor(F.col("idx") / F.lit(BLOCK)).cast("long").alias("seg"))
        .agg(F.sort_array(F.collect_list(cells)).alias("rows"))
    )
    return packed.select(*by, "seg", *[F.col(f"rows.v{d}").alias(f"w{i}") for i, d in enumerate(wanted)])


def summaries(w: list[np.ndarray], ok: np.ndarray, p: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products (blocks, 6, 6) and last entries (blocks, 6) of the six sequences of each block."""
    phi, theta, seasonal = p.T[:, :, None]
    v = [np.nan_to_num(x - mean[:, None]) for x in w] + [np.zeros_like(w[0])] * (4 - len(w))
    drive = np.zeros((*ok.shape, 6))
    drive[:, :, E] = v[0] - phi * v[1] - seasonal * v[2] + phi * seasonal * v[3]
    drive[:, :, A] = seasonal * v[3] - v[1]
    drive[:, :, S] = phi * v[3] - v[2]
    now, products = np.zeros((len(p), 6)), np.zeros((len(p), 6, 6))
    now[:, G] = 1.0
    theta = theta[:, 0][:, None]
    for t in range(ok.shape[1]):
        new = drive[:, t] - theta * now
        new[:, B] -= now[:, E]
        new[:, H] -= now[:, G]
        now = np.where(ok[:, t, None], new, now)
        seen = np.where(ok[:, t, None], new, 0.0)
        products += seen[:, :, None] * seen[:, None, :]
    return products, now


def combined(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The summary of two neighbouring stretches."""
    (g1, end), (g2, last) = first, second
    m = np.zeros((6, 6))
    for k in (E, A, S, B):
        m[k, k], m[k, G] = 1.0, end[k]
    m[B, H] = end[E]
    m[G, G] = m[H, H] = end[G]
    m[H, G] = end[H]
    return g1 + m @ g2 @ m.T, m @ last


def stepped(state: np.ndarray, products: np.ndarray, last: np.ndarray, free: int) -> np.ndarray:
    """Levenberg-Marquardt on all fits at once: takes or refuses the trial point, makes the next.
    A fit that has settled is left as it is."""
    out = state.copy()
    cost = products[:, E, E]
    active = state[:, _DONE] == 0
    better = active & np.isfinite(cost) & (cost < state[:, _COST])
    gain = state[:, _COST] - cost
    pick = [A, B, S]  # derivatives in the order of the point: phi, theta, seasonal
    out[better, _BEST], out[better, _COST] = state[better, _TRIAL], cost[better]
    out[better, _NORMAL] = products[better][:, pick][:, :, pick].reshape(-1, 9)
    out[better, _SLOPE] = products[better][:, E][:, pick]
    out[better, _LAST] = last[better, E]
    out[better, _DAMP] = np.maximum(state[better, _DAMP] / 5, 1e-12)
    worse = active & ~better
    out[worse, _DAMP] = state[worse, _DAMP] * 10
    settled = (better & (gain <= GAIN * cost)) | (worse & (out[:, _DAMP] > 1e9))
    out[settled, _DONE] = 1.0
    for i in np.flatnonzero(active & ~settled):
        normal = out[i, _NORMAL].reshape(3, 3)[:free, :free]
        slope, best = out[i, _SLOPE][:free], out[i, _BEST][:free]
        # a coefficient at its edge that wants to go beyond is held there
        inside = ~((np.abs(best) >= EDGE) & (slope * best < 0))
        move = np.zeros(free)
        if inside.any():
            part = normal[np.ix_(inside, inside)]
            move[inside] = np.linalg.solve(part + out[i, _DAMP] * np.diag(np.diag(part)) + 1e-300 * np.eye(len(part)), -slope[inside])
        trial = np.clip(best + move, -EDGE, EDGE)
        if np.max(np.abs(trial - best)) <= 1e-12:
            out[i, _DONE] = 1.0
        out[i, _TRIAL] = np.r_[trial, np.zeros(3 - free)]
    return out


def _matrices(chunk: pd.DataFrame, names: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    sizes = chunk[names[0]].map(len).to_numpy()
    w = [np.zeros((len(chunk), int(sizes.max()))) for _ in names]
    for name, matrix in zip(names, w):
        for i, row in enumerate(chunk[name]):
            matrix[i, : len(row)] = row
    return w, np.arange(w[0].shape[1])[None, :] < sizes[:, None]


def _chunks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    most = max(1, CELLS // max(1, int(batch["w0"].map(len).max())) // 8)
    for at in range(0, len(batch), most):
        yield batch.iloc[at : at + most]


def starting(points: np.ndarray) -> np.ndarray:
    state = np.zeros((len(points), SIZE))
    state[:, _TRIAL], state[:, _BEST] = points, points
    state[:, _COST], state[:, _DAMP] = np.inf, 1e-3
    return state


def solved(w: list[np.ndarray], ok: np.ndarray, points: np.ndarray, mean: np.ndarray, free: int, rounds: int) -> np.ndarray:
    """States after all rounds of series of one block; each goes on until it has settled itself."""
    state = starting(points)
    for _ in range(rounds):
        open_ = np.flatnonzero(state[:, _DONE] == 0)
        if not len(open_):
            break
        with np.errstate(all="ignore"):
            found = summaries([x[open_] for x in w], ok[open_], state[open_, _TRIAL], mean[open_])
            state[open_] = stepped(state[open_], *found, free)
    return state


def outcome(state: np.ndarray) -> list[dict]:
    """``p, squares, last_e, converged`` of states."""
    return [{"p": s[_BEST], "squares": s[_COST], "last_e": s[_LAST], "converged": s[_DONE] == 1} for s in state]


def _in_task(blocks: DataFrame, by: list[str], names: list[str], free: int, rounds: int, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk in _chunks(batch) if len(batch) else ():
                w, ok = _matrices(chunk, names)
                mean = chunk["mean"].to_numpy(float)
                state = solved(w, ok, np.array(chunk["p"].tolist(), float), mean, free, rounds)
                yield chunk[by].reset_index(drop=True).assign(state=list(state))

    return blocks.mapInPandas(run, schema)


def _level(parts: DataFrame, by: list[str], schema: T.StructType) -> DataFrame:
    """Summaries of up to FAN neighbours combined into one."""
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("seg")
        whole = None
        for products, last in zip(ordered["products"], ordered["last"]):
            part = np.asarray(products).reshape(6, 6), np.asarray(last)
            whole = part if whole is None else combined(whole, part)
        return ordered[by].head(1).assign(seg=int(ordered["seg"].iloc[0]) // FAN, products=[whole[0].ravel()], last=[whole[1]])

    above = parts.withColumn("_above", F.floor(F.col("seg") / F.lit(FAN)))
    return above.groupBy(*by, "_above").applyInPandas(lambda group: merge(group), schema)


def least_squares(frame: DataFrame, value: str, by: list[str], points: DataFrame, difference: bool, season: int, rounds: int = ROUNDS) -> DataFrame:
    """``by, p, squares, last_e, converged`` of the least sum of squared residuals.

    ``points`` has a starting point ``p`` (phi, theta, seasonal) and the ``mean`` to take off, one
    row per series; series without one are left out.
    """
    free, names = (3 if season else 2), [f"w{i}" for i in range(4 if season else 2)]
    rows = train_rows(frame)
    keys = [rows.schema[c] for c in by]
    schema = T.StructType([*keys, T.StructField("state", T.ArrayType(T.DoubleType()))])
    packed = pack_lags(frame, value, by, difference, season)
    long_ones = rows.filter(F.col("idx") == BLOCK).select(*by)
    brief = packed.join(points, by)
    if long_ones.isEmpty():
        fitted = _in_task(brief, by, names, free, rounds, schema)
    else:
        fitted = _in_task(brief.join(long_ones, by, "left_anti"), by, names, free, rounds, schema)
        blocks = written(packed.join(points.select(*by, "mean").join(long_ones, by, "left_semi"), by), "blocks")
        deepest = blocks.agg(F.max("seg")).first()[0] or 0
        state = points.join(long_ones, by, "left_semi").select(*by, "p")

        def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch[by].assign(state=list(starting(np.array(batch["p"].tolist(), float).reshape(-1, 3))))

        state = written(state.mapInPandas(begin, schema), "round")
        parts_schema = T.StructType([*keys, *T._parse_datatype_string("seg long, products array<double>, last array<double>").fields])

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for chunk in _chunks(batch) if len(batch) else ():
                    w, ok = _matrices(chunk, names)
                    with np.errstate(all="ignore"):
                        products, last = summaries(w, ok, np.array(chunk["state"].tolist(), float)[:, _TRIAL], chunk["mean"].to_numpy(float))
                    yield chunk[[*by, "seg"]].reset_index(drop=True).assign(products=list(products.reshape(-1, 36)), last=list(last))

        def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                before, products, last = (np.array(batch[c].tolist(), float) for c in ("state", "products", "last"))
                with np.errstate(all="ignore"):
                    yield batch[by].assign(state=list(stepped(before, products.reshape(-1, 6, 6), last, free)))

        for _ in range(rounds):
            going = state.filter(F.element_at("state", _DONE + 1) == 0)
            parts = blocks.join(going, by).mapInPandas(sums, parts_schema)
            left = deepest
            while True:
                parts = _level(parts, by, parts_schema)
                left //= FAN
                if not left:
                    break
            moved = state.join(parts, by).mapInPandas(move, schema)
            state = written(moved.unionByName(state.filter(F.element_at("state", _DONE + 1) != 0)), "round")
            if state.filter(F.element_at("state", _DONE + 1) == 0).isEmpty():
                break
        fitted = fitted.unionByName(state)
    return fitted.select(
        *by, F.slice("state", 4, 3).alias("p"), F.element_at("state", _COST + 1).alias("squares"),
        F.element_at("state", _LAST + 1).alias("last_e"), (F.element_at("state", _DONE + 1) == 1).alias("converged"),
    )
