"""Packing by cutting-stock column generation.

Documents become pieces of at most one sequence. Piece lengths, rounded up to classes, give a
histogram; a linear program over patterns (how many pieces of each class share a sequence)
is solved by column generation, a knapsack dynamic program pricing new patterns against the
program's duals. Rounded patterns are dealt to the pieces by their rank in their class. Short pieces of one
length are packed as bundles, so that rounding costs a bundle a few tokens and not each piece. The driver sees
the histogram only, whose size is that of the sequence, not of the data.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import numbered, table
from fluxwatch.llm.tokens import encoder, vocabulary

CAPACITY, END_ID = 4096, 2
#: Tokens between two length classes.
STEP = 8
#: Shares of a sequence: pieces up to the first are bundled, a bundle holds up to the second.
SHORT, BUNDLE = 16, 4
#: The program counts as solved when no solution can be better by this share (Farley's bound).
GAP = 1e-3
STEPS, SHIFT = 12, 1e-3


def price(duals: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """The pattern of most worth: an unbounded knapsack of ``units`` over classes 1 .. units."""
    worth = np.zeros(units + 1)
    taken = np.zeros(units + 1, np.int64)
    reverse = np.maximum(duals, 0)
    for c in range(1, units + 1):
        gains = reverse[:c] + worth[c - 1::-1]
        best = int(gains.argmax())
        if gains[best] > worth[c - 1]:
            worth[c], taken[c] = gains[best], best + 1
        else:
            worth[c] = worth[c - 1]
    pattern = np.zeros(units, np.int64)
    c = units
    while c > 0:
        if taken[c]:
            pattern[taken[c] - 1] += 1
            c -= taken[c]
        else:
            c -= 1
    return float(worth[units]), pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination with row exchanges, in plain array operations.

    A threaded linear-algebra library may wait for ever in a process that has forked since it was
    loaded, as a driver has when it starts its session after numpy; so none is called here."""
    m = len(matrix)
    work = np.concatenate([matrix.astype(float), np.eye(m)], axis=1)
    for c in range(m):
        pivot = c + int(np.abs(work[c:, c]).argmax())
        if work[pivot, c] == 0:
            raise ValueError("singular basis")
        work[[c, pivot]] = work[[pivot, c]]
        work[c] /= work[c, c]
        others = np.flatnonzero(work[:, c])
        others = others[others != c]
        work[others] -= work[others, c, None] * work[c]
    return work[:, m:]


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", matrix, vector.astype(float))


def solve(demand: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows over the classes) and how often each is used, real numbers.

    Revised simplex on: every class is covered, fewest sequences. The demand is shifted by small
    uneven amounts, so that steps are not degenerate. Every basis covers the demand, so the
    search may end early: after ``STEPS`` steps a class, or when the bound proves it near enough.
    """
    units = len(demand)
    present = np.flatnonzero(demand)
    m = len(present)
    if not m:
        return np.zeros((0, units), np.int64), np.zeros(0)
    want = demand[present] + SHIFT * np.random.default_rng(m).uniform(0.5, 1, m)
    basis = np.zeros((m, units), np.int64)
    basis[np.arange(m), present] = units // (present + 1)
    inverse = np.diag(1.0 / basis[np.arange(m), present])
    amount = np.maximum(_times(inverse, want), 0)
    for step in range(1, STEPS * m + 1):
        full = np.zeros(units)
        full[present] = inverse.sum(axis=0)
        worth, pattern = price(full, units)
        if worth <= 1 + GAP:  # the bound is the present value over the best worth
            break
        column = _times(inverse, pattern[present])
        rising = np.flatnonzero(column > 1e-9)
        if not len(rising):
            break
        out = int(rising[(amount[rising] / column[rising]).argmin()])
        basis[out] = pattern
        row = inverse[out] / column[out]
        inverse -= column[:, None] * row
        inverse[out] = row
        if step % 100 == 0:  # rounding errors add up
            inverse = inverted(basis[:, present].T)
        amount = np.maximum(_times(inverse, want), 0)
    return basis, amount


def fitted(sizes: list[int], units: int) -> list[Counter]:
    """What rounding left over, best fit first: each piece in the fullest sequence that takes it."""
    open_by_room: dict[int, list[Counter]] = {}
    done: list[Counter] = []
    for size in sorted(sizes, reverse=True):
        room = next((r for r in range(size, units + 1) if open_by_room.get(r)), None)
        pattern = open_by_room[room].pop() if room is not None else Counter()
        pattern[size] += 1
        left = (room if room is not None else units) - size
        if left:
            open_by_room.setdefault(left, []).append(pattern)
        else:
            done.append(pattern)
    return done + [p for group in open_by_room.values() for p in group]


def plan(demand: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Whole patterns and their counts that cover the demand exactly: (class -> pieces, times)."""
    units = len(demand)
    patterns, amounts = solve(demand)
    rest = demand.astype(np.int64).copy()
    result: Counter = Counter()
    for floor in (True, False):  # whole parts, then one more of the largest fractions that fit
        for i in np.argsort(-(amounts - np.floor(amounts)) if not floor else -amounts):
            used = patterns[i] > 0
            times = int(amounts[i]) if floor else 1
            times = min(times, int((rest[used] // patterns[i][used]).min())) if used.any() else 0
            if times > 0:
                rest -= times * patterns[i]
                result[tuple((int(j) + 1, int(patterns[i][j])) for j in np.flatnonzero(used))] += times
    for pattern in fitted([j + 1 for j in range(units) for _ in range(rest[j])], units):
        result[tuple(sorted(pattern.items()))] += 1
    return [(dict(k), n) for k, n in sorted(result.items(), reverse=True)]


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents, one scan: a document's ids and the end id, cut at every ``capacity``.

    (doc_id, start, length, ids_crc32, doc_tokens) and, if asked for, ``ids`` (little-endian
    unsigned 32-bit). A null text counts as empty and gives its end id; repeated rows give their pieces again.
    """
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use, end = encoder(path), END_ID.to_bytes(4, "little")
        for frame in frames:
            rows = []
            for key, body in zip(frame["doc_id"], use.each(frame["text"])):
                ids = memoryview(body + end)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start:4 * (start + capacity)]
                    rows.append((key, start, len(part) // 4, zlib.crc32(part), total, *((bytes(part),) if keep_ids else ())))
            made = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else [])])
            yield made.astype({"doc_id": "Int64"})

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if keep_ids else "")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, schema)


def bundles(counts: dict[int, int], capacity: int, step: int) -> tuple[np.ndarray, dict[int, list[tuple[int, int, int, int]]]]:
    """Items per class, and where pieces become items.

    ``counts`` has the pieces of each class of long ones (positive) and of each length of short ones
    (negative). A short length's bundles are [(first rank, pieces each, class, first place in the class)]: the whole
    ones, then what is left as one.
    """
    items = np.zeros(-(-capacity // step), np.int64)
    for size, n in counts.items():
        if size > 0:
            items[size - 1] += n
    where: dict[int, list[tuple[int, int, int, int]]] = {}
    for size, n in sorted(counts.items()):
        if size > 0:
            continue
        each = max(1, capacity // BUNDLE // -size)
        for first, held, times in ((0, each, n // each), (n - n % each, n % each, 1)):
            if held and times:
                unit = -(-held * -size // step)
                where.setdefault(size, []).append((first, held, unit, int(items[unit - 1])))
                items[unit - 1] += times
    return items, where


def packed(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, step: int = STEP, keep_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and their gapless ``offset`` in it.

    A document of up to one sequence stays whole; a longer one fills sequences and its rest
    is packed. No sequence is above ``capacity``. An empty table packs to nothing.
    """
    length = F.col("length")
    kind = F.when(length <= capacity // SHORT, -length).otherwise(F.ceil(length / step)).cast("int")
    classed = pieces(docs, path, doc_id, text, capacity, keep_ids).withColumn("_class", kind)
    ranked = numbered(classed, ["_class"], "pieces", "_rank")
    counts = {r["_class"]: r["n"] for r in ranked.groupBy("_class").agg(F.count("*").alias("n")).collect()}  # at most one row a class
    demand, where = bundles(counts, capacity, step)
    # where a class's ranks go: from rank ``slot`` on to sequences from ``base`` on, ``each`` to a sequence
    routes: dict[int, list[tuple[int, int, int]]] = {}
    slots: Counter = Counter()
    base = 0
    for pattern, times in plan(demand):
        for size, each in pattern.items():
            routes.setdefault(size, []).append((slots[size], base, each))
            slots[size] += each * times
        base += times
    lookup = {size: tuple(np.array(x, np.int64) for x in zip(*route)) for size, route in routes.items()}

    @F.pandas_udf("long")
    def sequence(sizes: pd.Series, ranks: pd.Series) -> pd.Series:
        out = np.zeros(len(sizes), np.int64)
        size, rank = sizes.to_numpy().copy(), ranks.to_numpy().copy()
        for s in np.unique(size[size < 0]):
            rows = np.flatnonzero(size == s)
            old = rank[rows]
            for first, held, unit, base in where[int(s)]:
                mine = old >= first
                size[rows[mine]], rank[rows[mine]] = unit, base + (old[mine] - first) // held
        for s in np.unique(size):
            rows = np.flatnonzero(size == s)
            slot, first, each = lookup[int(s)]
            at = np.searchsorted(slot, rank[rows], "right") - 1
            out[rows] = first[at] + (rank[rows] - slot[at]) // each[at]
        return pd.Series(out)

    placed = ranked.withColumn("sequence_id", sequence("_class", "_rank"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "_rank")
    offset = F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("offset", offset).drop("_class", "_rank")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
