"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

A set's shingles are put in the order of their hashes. Two sets at 0.8 share more than their tails, so both have
one of the shingles they share among their first ``prefix(size)`` (a fifth of the set): sets meet that
share one of these, and no pair is missed. Sets that meet are candidates if their sizes allow 0.8 and their
SimHash bits, 256 over the distinct shingles, are close: the first 64, compared bit plane by bit plane
(``simhash.close_lanes``), within ``FIRST``, all within ``WHOLE``. At 0.8 these lie 9.7 and 39 bits apart on
average (small sets 12 and 48), unrelated ones 32 and 128; the radii are more than five standard deviations
above, so a pair at 0.8 fails them once in 100 million.

Candidates are never listed pair by pair: a bucket gives a spanning forest of them, the components of the forests
are groups, and each set goes to the tasks of its group once a cut. There the overlaps of whole sets are counted and the
links at 0.8 kept, a spanning forest again. So the rows grow with the texts and not with the pairs of a large group.
Buckets and groups above a size are cut, and all pairs of cuts compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import Groups, components, let_go
from fluxwatch.llm.simhash import BATCH, BITS, SEED, close_lanes, majority, shingles, transpose
from fluxwatch.session import written

WIDTH, WORDS = 5, 4
#: Bits by which candidates may differ: of the first 64, of all, of all if a set has fewer than ``SMALL`` shingles.
FIRST, WHOLE, WIDE, SMALL = 30, 72, 96, 64
#: Sets of one side of a comparison at most (on average over the cuts of a bucket), and rows compared at a time at least.
CUT, ROWS = 8192, 1 << 16
#: The same of a group of candidates: sets, and shingles in them.
PAIRS, SHINGLES = 4096, 1 << 20
#: Sets of which the keys are broadcast to the texts; more are joined by a shuffle.
FEW = 100_000
SKETCH, KEY = [f"f{i}" for i in range(WORDS)], ["bucket", "pair"]
ALL = ~np.uint64(0)


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted."""
    found = np.zeros(0, "<u8")
    for batch in shingles(text, WIDTH):
        found = np.union1d(found, batch)
    return found


def mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Another hash of each hash (splitmix64); word 0 leaves them as they are."""
    if not word:
        return hashes
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix(size: int) -> int:
    """How many first shingles of a set of ``size`` a set at 0.8 shares one of, whatever the order."""
    return size - (4 * size + 4) // 5 + 1 if size else 0


def sketch(found: np.ndarray) -> tuple:
    """(name of the set, its size, 256 bits in signed longs, its first shingles)."""
    name = xxhash.xxh64_intdigest(found.tobytes(), SEED)
    words = [mixed(found, i) for i in range(WORDS)]
    return (name - (1 << BITS) if name >> (BITS - 1) else name, len(found), *(majority(iter([w])) for w in words), found[:prefix(len(found))].view("<i8"))


def alike(both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes ``a`` and ``b`` with ``both`` shingles in common have a Jaccard similarity of 0.8."""
    return 5 * both >= 4 * (a + b - both)


def close_pairs(bits: np.ndarray, sizes: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs within the radii, each row compared with the rows from ``low`` to before ``high``."""
    blocks = -(-len(bits) // 64)
    filled = np.zeros(blocks * 64, "<u8")
    filled[:len(bits)] = bits[:, 0]
    planes = transpose(filled.reshape(blocks, 64))
    asks = np.where(high > low, (high - 1) // 64 - low // 64 + 1, 0)
    steps = np.cumsum(asks)
    for at in range(0, int(steps[-1]), BATCH // 4):
        flat = np.arange(at, min(at + BATCH // 4, int(steps[-1])))
        row = np.searchsorted(steps, flat, "right")
        block = low[row] // 64 + flat - (steps[row] - asks[row])
        # the lanes of the block that lie in the row's range
        below = np.clip(low[row] - 64 * block, 0, 63).astype(np.uint64)
        above = np.clip(64 * (block + 1) - high[row], 0, 63).astype(np.uint64)
        place, hits = close_lanes(planes, bits[row, 0], block, (ALL << below) & (ALL >> above), FIRST)
        found = np.flatnonzero(hits)
        pair, lane = np.nonzero(np.unpackbits(hits[found].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        a, b = row[place[found[pair]]], block[place[found[pair]]] * 64 + lane
        radius = np.where(np.minimum(sizes[a], sizes[b]) < SMALL, WIDE, WHOLE)
        near = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) <= radius
        yield a[near], b[near]


def runs(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """First places and sizes of the keys of sorted rows."""
    keys = rows[KEY].to_numpy(np.int64)
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    return first, np.diff(np.r_[first, len(rows)])


def compared(rows: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest (a, b) of the candidates inside each key, of rows sorted by key, side and size."""
    names, sizes, side = (rows[c].to_numpy(np.int64) for c in ("node", "size", "side"))
    at = np.arange(len(rows))
    first, held = runs(rows)
    key = np.repeat(np.arange(len(first)), held)
    # a row meets rows behind it: of side 1 those of side 2, of side 0 its own, as far as the larger size allows 0.8
    step = int(sizes.max()) + 1
    place = (2 * key + (side == 2)) * step
    low = np.where(side == 0, at + 1, np.searchsorted(place + sizes, place + step + (4 * sizes + 4) // 5))
    high = np.searchsorted(place + sizes, np.where(side == 0, place, place + step) + np.minimum(5 * sizes // 4, step - 1), "right")
    high = np.where(side == 2, low, high)
    groups = Groups(len(rows))
    for a, b in close_pairs(np.ascontiguousarray(rows[SKETCH].to_numpy(np.int64)).view(np.uint64), sizes, low, high):
        groups.link(a, b)
    joined = np.flatnonzero(groups.label != at)
    return pd.DataFrame({"a": names[groups.label[joined]], "b": names[joined]})


def linked(sets: list[np.ndarray], side: np.ndarray) -> np.ndarray:
    """For each set the place of one it is linked with, over any number of links at 0.8; only sets of the sides 1 and 2, or
    of side 0, are compared. A set that is linked asks those only that are not yet."""
    n, label, waiting = len(sets), np.arange(len(sets)), np.ones(len(sets), bool)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1
    code, owner = code[shared], owner[shared]
    codes = np.split(code, np.searchsorted(owner, np.arange(1, n)))
    order = np.argsort(code, kind="stable")
    lists, listed = owner[order], code[order]
    start, kept = np.searchsorted(listed, np.arange(len(times) + 1)), n
    for seed in range(n):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        asking = [seed]
        while asking and (left := int(waiting.sum())):
            if 2 * left <= kept:  # lists without the sets already linked
                those = waiting[lists]
                lists, listed, kept = lists[those], listed[those], left
                start = np.searchsorted(listed, np.arange(len(times) + 1))
            x = asking.pop()
            begin, long = start[codes[x]], start[codes[x] + 1] - start[codes[x]]
            met = lists[np.repeat(begin - np.cumsum(long) + long, long) + np.arange(long.sum())]
            both = np.bincount(met, minlength=n)
            apart = side != side[x] if side[x] else np.ones(n, bool)
            new = np.flatnonzero(waiting & apart & (both > 0) & alike(both, sizes[x], sizes))
            label[new], waiting[new] = seed, False
            asking.extend(new.tolist())
    return label


def confirmed_in(rows: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest (a, b) of the links inside each key, of rows sorted by key."""
    names, side = rows["node"].to_numpy(np.int64), rows["side"].to_numpy(np.int64)
    sets, label = [np.frombuffer(s, "<u8") for s in rows["set"]], np.arange(len(rows))
    for at, n in zip(*runs(rows)):
        if n > 1:
            label[at:at + n] = at + linked(sets[at:at + n], side[at:at + n])
    joined = np.flatnonzero(label != np.arange(len(rows)))
    return pd.DataFrame({"a": names[label[joined]], "b": names[joined]})


def whole_keys(batches: Iterator[pd.DataFrame], weight: Callable[[pd.DataFrame], int]) -> Iterator[pd.DataFrame]:
    """Sorted rows in parts that hold keys whole, of a weight of ``ROWS`` about; a key has two sides at most."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += weight(batch)
        if size < ROWS:
            continue
        rows = pd.concat(held, ignore_index=True)
        cut = int(runs(rows)[0][-1])
        if cut:
            yield rows.iloc[:cut].reset_index(drop=True)
        held = [rows.iloc[cut:]]
        size = weight(held[0])
    if sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def in_tasks(rows: DataFrame, cuts: Column, columns: list[str], order: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], weight: Callable[[pd.DataFrame], int] = len) -> DataFrame:
    """Pairs (a, b) that ``work`` finds in the rows of each ``bucket``, which is dealt in ``cuts``: each
    pair of cuts is the work of one task."""
    spread = rows.withColumn("_cuts", cuts.cast("long")).withColumn("_mine", F.pmod(F.xxhash64("node"), F.col("_cuts")))
    spread = spread.withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cuts") - 1)))
    # cut i goes to the tasks of all pairs (i, j): alone (side 0) as (i, i), else as the lower or upper side
    tasks = spread.select(
        "bucket", (F.least("_mine", "_with") * F.col("_cuts") + F.greatest("_mine", "_with")).alias("pair"),
        F.when(F.col("_mine") == F.col("_with"), 0).when(F.col("_mine") < F.col("_with"), 1).otherwise(2).alias("side"), *columns,
    )
    ordered = tasks.repartition(*KEY).sortWithinPartitions(*KEY, "side", *order)

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_keys(batches, weight):
            yield work(part)

    return ordered.mapInPandas(pairs, "a long, b long")


def candidates(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all candidates of ``sets`` (node, size, sketch, first): at most one a set and bucket."""
    met = sets.select("node", F.explode("first").alias("bucket"))
    met = met.join(met.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "bucket")
    rows = met.join(sets.select("node", "size", *SKETCH), "node")
    return in_tasks(rows, F.ceil(F.col("n") / CUT), ["node", "size", *SKETCH], ["size", "node"], compared)


def confirmed(groups: DataFrame, keyed: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all sets of one similarity group: of each of the ``groups`` (node, component) of candidates
    the whole sets are compared. ``named`` has the size and the keys of a document of each node."""
    @F.pandas_udf("binary")
    def set_of(column: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t).tobytes() for t in column], dtype=object)

    inside = named.join(groups.withColumnRenamed("component", "bucket"), "node")
    sizes = inside.groupBy("bucket").agg(F.greatest(F.ceil(F.count("*") / PAIRS), F.ceil(F.sum("size") / SHINGLES)).alias("cuts"))
    asked = written(inside.drop("size").join(sizes, "bucket"), "asked")
    few = F.broadcast(asked) if asked.count() <= FEW else asked
    texts = keyed.join(few, ["_keep_d", "_keep_h"]).dropDuplicates(["node"])
    rows = texts.select("bucket", "cuts", "node", set_of("_text").alias("set"))
    return in_tasks(rows, F.col("cuts"), ["node", "set"], ["node"], confirmed_in, lambda part: sum(map(len, part["set"])) >> 8)


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies, linked over any number of links: the one of
    the smallest id, of rows that share it the one of the smallest text hash, of rows equal in both the one
    whose other columns have the smallest hash. A null id counts as the largest. Texts without words are one
    group. Columns stay as they are.
    """
    @F.pandas_udf("node long, size long, " + ", ".join(f"{f} long" for f in SKETCH) + ", first array<long>")
    def sketched(column: pd.Series) -> pd.DataFrame:
        let_go()
        made = pd.DataFrame([sketch(shingle_set(t)) for t in column], columns=["node", "size", *SKETCH, "first"])
        return made.astype({c: "int64" for c in ["node", "size", *SKETCH]})

    keys = {"_keep_d": F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)), "_keep_h": F.xxhash64(F.col(text))}
    keyed = docs.withColumns(keys)
    marked = written(keyed.withColumn("_s", sketched(text)).select("_keep_d", "_keep_h", "_s.*"), "sketches")
    least = F.min(F.struct("_keep_d", "_keep_h")).alias("_least")
    sets = written(marked.groupBy("node", "size", *SKETCH, "first").agg(least), "sets")
    groups = components(candidates(sets))
    texts = keyed.select("_keep_d", "_keep_h", F.col(text).alias("_text"))
    links = confirmed(groups, texts, sets.select("node", "size", "_least.*"))
    final = sets.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    keep = final.groupBy("component").agg(F.min("_least").alias("_least")).select("_least.*")
    rest_of = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]  # maps have no hash
    one = Window.partitionBy("_keep_d", "_keep_h").orderBy(F.xxhash64(*rest_of) if rest_of else F.lit(0))
    kept = keyed.join(keep, ["_keep_d", "_keep_h"], "left_semi").withColumn("_keep_row", F.row_number().over(one)).where("_keep_row = 1")
    return kept.select(*docs.columns)
