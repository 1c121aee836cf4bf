"""Maximum-likelihood rounds for models with a state that runs along the series.

A series is packed into rows of at most BLOCK consecutive values. Inside a block
numpy runs the recursion, over all blocks of an Arrow batch at once. What links
the blocks of a long series is the state carried from one to the next: each
block's effect on the state is a small linear map, the maps are combined in two
levels, and the resulting carries are joined back to the blocks. A series that
fits one block needs no carries, so all its rounds run in the task that holds it.

A model provides, on arrays with one entry per block:

``start(y)``               starting parameters, one set per start
``advance(p, data)``       parameters ``p`` -> the map of each block
``sums(p, data, i, o)``    sufficient statistics given the carries in and out
``update(p, sums)``        next parameters; their last entry is the relative change
and on single maps ``enter, leave, forward, backward, combine``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.operators.timeseries.frame import BLOCK, KEY, lagged, train_rows
from fluxwatch.session import written

# Maps one task combines at most.
FAN = 1024
# Relative change below which a series counts as fitted.
SETTLED = 1e-8
# Values of a block that one numpy pass holds at most, over all its blocks.
CELLS = 500_000


@dataclass
class Cells:
    """Blocks as a matrix, short ones padded: values, predecessors, validity."""

    y: np.ndarray
    x: np.ndarray
    ok: np.ndarray
    first: np.ndarray
    extra: np.ndarray


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.ArrayType(T.DoubleType())) for n in names]


def pack(frame: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """One row per (series, block): ``y`` the values in order, ``before`` the value
    ahead of the first (null at the start of the series), ``seg`` the block's number."""
    by = by or KEY
    rows = lagged(frame, {value: 1}, by)
    seg = F.floor(F.col("idx") / F.lit(BLOCK)).cast("long")
    packed = rows.groupBy(*by, seg.alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("idx", F.col(value).cast("double").alias("v")))).alias("rows"),
        F.min_by(F.col(f"{value}_1").cast("double"), "idx").alias("before"),
    )
    return packed.select(*by, "seg", "before", F.transform("rows", lambda r: r["v"]).alias("y"))


def _cells(batch: pd.DataFrame) -> Cells:
    lengths = batch["y"].map(len).to_numpy()
    width = int(lengths.max())
    y = np.zeros((len(batch), width))
    for i, values in enumerate(batch["y"]):
        y[i, : len(values)] = values
    before = batch["before"].to_numpy(float)
    x = np.concatenate([before[:, None], y[:, :-1]], 1)
    ok = np.arange(width)[None, :] < lengths[:, None]
    extra = np.asarray(batch["extra"].tolist(), float)
    return Cells(y, x, ok, np.isnan(before), extra)


def _chunks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Parts of a batch that are small enough, of similar lengths."""
    ordered = batch.iloc[np.argsort(batch["y"].map(len).to_numpy(), kind="stable")]
    begin = 0
    while begin < len(ordered):
        size = 1
        while begin + size < len(ordered) and (size + 1) * len(ordered["y"].iloc[begin + size]) <= CELLS:
            size += 1
        yield ordered.iloc[begin : begin + size]
        begin += size


def _map_chunks(rows: DataFrame, by: list[str], outputs: list[str], work) -> DataFrame:
    """Applies ``work(chunk) -> list of 2-d arrays`` to packed rows."""
    schema = T.StructType([rows.schema[c] for c in by] + _doubles(*outputs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk in _chunks(batch):
                with np.errstate(all="ignore"):
                    found = work(chunk)
                yield chunk[by].reset_index(drop=True).assign(
                    **{n: list(v) for n, v in zip(outputs, found)}
                )

    return rows.mapInPandas(run, schema)


def solved(chunk: pd.DataFrame, model, rounds: int) -> np.ndarray:
    """All rounds of series that are a single block, side by side: their parameters."""
    data = _cells(chunk)
    p = np.asarray(chunk["p"].tolist(), float)
    for _ in range(rounds):
        # a settled series stays as it is, whatever its neighbours in the batch need
        going = ~(p[:, -1] <= SETTLED)
        if not going.any():
            break
        moved = model.update(p, model.sums(p, data, model.enter(p), model.leave(p)))
        p = np.where(going[:, None], moved, p)
    return p


def _solve_in_task(blocks: DataFrame, by: list[str], model, rounds: int) -> DataFrame:
    """All rounds for series that are a single block: ``by, start, p``."""
    return _map_chunks(blocks, [*by, "start"], ["p"], lambda chunk: [solved(chunk, model, rounds)])


def carries(maps: DataFrame, by: list[str], model, grouped: bool) -> DataFrame:
    """Carry into and out of every block: ``by, seg, p, into, out``.

    ``maps`` holds one row per block. If some series has more than FAN blocks
    (``grouped``), groups of FAN blocks are combined first, the combined maps are
    run through per series, then each group is run through from its own carries.
    """
    keys = [maps.schema[c] for c in by]
    placed = maps.withColumn("grp", F.floor(F.col("seg") / F.lit(FAN)).cast("long"))
    wide = T.StructType([*keys, T.StructField("grp", T.LongType()), *_doubles("p", "map")])

    def combine(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("seg")
        p = np.asarray(part["p"].iloc[0])
        whole = None
        for m in part["map"]:
            whole = np.asarray(m) if whole is None else model.combine(p, whole, np.asarray(m))
        return part[[*by, "grp"]].head(1).assign(p=[p], map=[whole])

    def through(order: str, given: bool):
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(order)
            p = np.asarray(part["p"].iloc[0])
            steps = [np.asarray(m) for m in part["map"]]
            state = np.asarray(part["into"].iloc[0]) if given else model.enter(p[None])[0]
            into = []
            for m in steps:
                into.append(state)
                state = model.forward(p, state, m)
            state = np.asarray(part["out"].iloc[0]) if given else model.leave(p[None])[0]
            out = []
            for m in reversed(steps):
                out.append(state)
                state = model.backward(p, state, m)
            cols = [*by, order, "p"]
            return part[cols].assign(into=into, out=out[::-1])

        return run

    def schema(order: str) -> T.StructType:
        return T.StructType([*keys, T.StructField(order, T.LongType()), *_doubles("p", "into", "out")])

    if not grouped:
        return maps.groupBy(*by).applyInPandas(through("seg", False), schema("seg"))
    tops = placed.groupBy(*by, "grp").applyInPandas(combine, wide)
    top = tops.groupBy(*by).applyInPandas(through("grp", False), schema("grp"))
    joined = placed.join(top.drop("p"), [*by, "grp"])
    return joined.groupBy(*by, "grp").applyInPandas(through("seg", True), schema("seg"))


def per_block(blocks: DataFrame, params: DataFrame, by: list[str]) -> DataFrame:
    """Per-series values joined to blocks by (series, block), so that the blocks of
    one long series stay spread."""
    places = blocks.select(*by, "seg").join(params, by)
    return blocks.join(places, [*by, "seg"])


def many_blocks(frame: DataFrame) -> bool:
    """Whether some series has more than FAN blocks."""
    return not frame.filter(F.col("idx") == BLOCK * FAN).isEmpty()


def block_carries(
    blocks: DataFrame, params: DataFrame, by: list[str], model, grouped: bool
) -> DataFrame:
    """Carries of every block under given parameters (``by, p``)."""
    ready = per_block(blocks, params, by)

    def advance(chunk: pd.DataFrame) -> list[np.ndarray]:
        p = np.asarray(chunk["p"].tolist(), float)
        return [p, model.advance(p, _cells(chunk))]

    maps = _map_chunks(ready, [*by, "seg"], ["p", "map"], advance)
    return carries(maps, by, model, grouped)


def _round(blocks: DataFrame, params: DataFrame, by: list[str], model, grouped: bool) -> DataFrame:
    """One round over the blocks of long series."""
    linked = blocks.join(block_carries(blocks, params, by, model, grouped), [*by, "seg"])

    def work(chunk: pd.DataFrame) -> list[np.ndarray]:
        p, into, out = (np.asarray(chunk[c].tolist(), float) for c in ("p", "into", "out"))
        return [p, model.sums(p, _cells(chunk), into, out)]

    partial = _map_chunks(linked, by, ["p", "s"], work)
    summed = (
        partial.select(*by, "p", F.posexplode("s").alias("at", "v"))
        .groupBy(*by, "at")
        .agg(F.sum("v").alias("v"), F.any_value("p").alias("p"))
        .groupBy(*by)
        .agg(
            F.any_value("p").alias("p"),
            F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda r: r["v"]).alias("s"),
        )
    )
    schema = T.StructType([summed.schema[c] for c in by] + _doubles("p"))

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p, s = (np.asarray(batch[c].tolist(), float) for c in ("p", "s"))
            with np.errstate(all="ignore"):
                yield batch[by].assign(p=list(np.where(p[:, -1:] <= SETTLED, p, model.update(p, s))))

    return summed.mapInPandas(step, schema)


def chosen_start(fitted: DataFrame, by: list[str], llf_at: int) -> DataFrame:
    """Of the starts of a series the settled one of the largest likelihood: ``by, p, converged``.

    Where no start has settled within its rounds, the one that came furthest, not converged."""
    settled = F.coalesce(F.element_at("p", -1) <= SETTLED, F.lit(False))
    order = F.struct(settled, F.element_at("p", llf_at + 1))
    best = fitted.groupBy(*by).agg(F.max_by(F.struct("p", settled.alias("converged")), order).alias("best"))
    return best.select(*by, "best.p", "best.converged")


def likelihood_rows(moments: DataFrame, best: DataFrame, by: list[str], name: str, k: int, llf_at: int, nobs: Column, params: Column) -> DataFrame:
    """Model rows of fits by :func:`fit_blocks`. A series that could not be fitted, or whose fit has not
    settled, is not ``converged`` and has no criteria; ``params`` is then the point it had come to."""
    done = F.coalesce("converged", F.lit(False))
    llf = F.when(done, F.element_at("p", llf_at + 1))
    return moments.join(best, by, "left").select(
        *by,
        F.lit(name).alias("model"),
        F.lit(k).alias("k"),
        F.when(done, nobs).alias("nobs"),
        llf.alias("llf"),
        (2 * k - 2 * llf).alias("aic"),
        (k * F.log(nobs.cast("double")) - 2 * llf).alias("bic"),
        params.alias("params"),
        F.lit(None).cast("array<double>").alias("state"),
        F.lit(None).cast("array<double>").alias("matrix"),
        done.alias("converged"),
    )


def fit_blocks(
    frame: DataFrame, value: str, params: DataFrame, by: list[str], model, rounds: int
) -> DataFrame:
    """Fitted parameters ``by, start, p`` for the training rows of ``frame``.

    ``params`` holds the starting parameters ``p`` and the constants ``extra`` of
    the series, one row per (series, start).
    """
    keys = [*by, "start"]
    rows = train_rows(frame)
    # a series that goes beyond its first block has exactly one row at this position
    long_ones = rows.filter(F.col("idx") == BLOCK).select(*by)
    if long_ones.isEmpty():
        return _solve_in_task(per_block(pack(rows, value, by), params, by), by, model, rounds)
    brief, wide = rows.filter(F.col("n_train") <= BLOCK), rows.filter(F.col("n_train") > BLOCK)
    fitted = _solve_in_task(per_block(pack(brief, value, by), params, by), by, model, rounds)
    current = params.join(long_ones, by, "left_semi")
    blocks = per_block(pack(wide, value, by), current.drop("p"), by)
    kept = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    current = current.drop("extra")
    grouped = many_blocks(rows)
    for _ in range(rounds):
        # a written copy of a few numbers per series cuts the lineage each round
        current = written(_round(kept, current, keys, model, grouped), "round")
        if current.filter(F.element_at("p", -1) > SETTLED).isEmpty():
            break
    kept.unpersist()
    return fitted.unionByName(current)
