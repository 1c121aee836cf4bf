"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine at least c lie within eps = sqrt(2 - 2c). Vectors are rotated so that their
principal dimensions lead, sorted by their cells of an eps grid on the leading dimensions, and the sorted
sequence is cut into intervals. Two intervals are joined only if their boxes in the leading
dimensions come within eps; the join halves both sequences, drops halves that are provably
distant, and at the leaves looks at full vectors only where the leading dimensions are near.
The rotation only decides how much is skipped: every pair is either skipped by a bound or measured.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import Groups, components, table
from fluxwatch.session import written

COSINE = 0.9
#: Leading dimensions of the grid, and of boxes and bounds.
GRID, LEAD = 6, 16
#: Vectors the rotation is fitted on; an interval's vectors; a leaf's.
SAMPLE, INTERVAL, LEAF = 20_000, 4096, 256
#: Bounds are widened by this much against rounding.
SLACK = 1e-6


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1. Each row is first scaled by a power of two, which is exact, so that
    squares of very large or small components stay numbers."""
    wide = vectors.astype(np.float64)
    wide = np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1, keepdims=True))[1])
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def rotation(count: int, total: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Principal dimensions of ``count`` unit vectors, the widest first, from their sum and cross products."""
    mean = total / count
    return np.linalg.eigh(products / count - np.outer(mean, mean))[1][:, ::-1]


def leading_dimensions(vectors: DataFrame, width: int) -> np.ndarray:
    """The first LEAD principal dimensions of at most SAMPLE hash-chosen vectors ``e`` of one length.

    The sample stays in one task, which adds up cross products batch by batch; the driver gets
    the dimensions only."""
    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total, products = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            if len(batch):
                part = unit(np.array(batch["e"].tolist(), np.float64))
                count, total, products = count + len(part), total + part.sum(axis=0), products + part.T @ part
        if count:
            yield pd.DataFrame({"turn": [rotation(count, total, products)[:, :LEAD].ravel()]})

    sample = vectors.select("e").orderBy(F.xxhash64("e")).limit(SAMPLE)
    return np.array(sample.mapInPandas(fit, "turn array<double>").first()["turn"]).reshape(width, -1)


def leads(units: np.ndarray, turns: dict[int, np.ndarray]) -> np.ndarray:
    """LEAD leading coordinates, zeros behind a shorter vector; lengths without a rotation keep their own dimensions."""
    turn = turns.get(units.shape[1])
    found = units[:, :LEAD] if turn is None else units @ turn
    return np.pad(found, ((0, 0), (0, LEAD - found.shape[1])))


class Side:
    """An interval ready to be joined: unit vectors and their leading coordinates, in grid order."""

    def __init__(self, flat: np.ndarray, n: int, turns: dict[int, np.ndarray]):
        self.vectors = unit(flat.reshape(n, -1))
        self.lead = leads(self.vectors, turns)

    def box(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        part = self.lead[a:b]
        return part.min(axis=0), part.max(axis=0)


def near_pairs(x: Side, y: Side, same: bool, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in x, in y) of pairs with at least the cosine; of one interval each pair once."""
    reach = 2 - 2 * cosine + SLACK
    work = [(0, len(x.vectors), 0, len(y.vectors))]
    while work:
        a, b, c, d = work.pop()
        if same and a >= d:
            continue  # the mirrored half
        low_x, high_x = x.box(a, b)
        low_y, high_y = y.box(c, d)
        apart = np.maximum(0, np.maximum(low_x - high_y, low_y - high_x))
        if apart @ apart > reach:
            continue
        if max(b - a, d - c) > LEAF:
            for p in ((a, (a + b) // 2), ((a + b) // 2, b)) if b - a > LEAF else ((a, b),):
                for q in ((c, (c + d) // 2), ((c + d) // 2, d)) if d - c > LEAF else ((c, d),):
                    work.append((*p, *q))
            continue
        p, q = x.lead[a:b], y.lead[c:d]
        gap = (p * p).sum(axis=1)[:, None] + (q * q).sum(axis=1) - 2 * (p @ q.T)
        i, j = np.nonzero(gap <= reach)
        if same:
            keep = a + i < c + j
            i, j = i[keep], j[keep]
        if not len(i):
            continue
        if 8 * len(i) > gap.size:
            exact = (x.vectors[a:b] @ y.vectors[c:d].T)[i, j]
        else:
            exact = np.einsum("ij,ij->i", x.vectors[a + i], y.vectors[c + j])
        hit = exact >= cosine
        if hit.any():
            yield a + i[hit], c + j[hit]


def _joined(batches: Iterator[pa.RecordBatch], turns: dict[int, np.ndarray], cosine: float) -> Iterator[pa.RecordBatch]:
    """Pairs of intervals to rows (node, links, root): links found, and a root each linked node hangs on."""
    for batch in batches:
        for row in range(batch.num_rows):
            value = {name: batch.column(k)[row] for k, name in enumerate(batch.schema.names)}
            same = value["i"].as_py() == value["j"].as_py()

            def array(name: str) -> np.ndarray:
                return value[name].values.to_numpy(zero_copy_only=False)

            ids, sizes = array("ids_x"), array("sizes_x")
            x = Side(array("flat_x"), len(ids), turns)
            n = len(ids)
            if same:
                y, shift = x, 0
            else:
                y, shift = Side(array("flat_y"), len(array("ids_y")), turns), n
                ids, sizes = np.r_[ids, array("ids_y")], np.r_[sizes, array("sizes_y")]
            links = np.zeros(len(ids), np.int64)
            groups = Groups(len(ids))
            for a, b in near_pairs(x, y, same, cosine):
                np.add.at(links, a, sizes[b + shift])
                np.add.at(links, b + shift, sizes[a])
                groups.link(a, b + shift)
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(links[found]), pa.array(ids[groups.label[found]])], ["node", "links", "root"])


def linked(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, interval: int = INTERVAL) -> DataFrame:
    """One row a vector: (vec_id, n_links, component_id, kept).

    Equal vectors are one vector with a count, so groups of copies cost nothing. Null, zero and
    non-finite vectors link with nothing, vectors of different lengths not with each other. Repeated ids
    are vectors of their own. Other columns are left out; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("e"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.coalesce(F.col("e").isNotNull() & finite & F.exists("e", lambda v: v != 0), F.lit(False))
    marked = named.withColumn("ok", sound)
    alone = marked.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    valid = marked.where("ok").select("vec_id", "e")
    classes = valid.groupBy("e").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    classes = written(classes.withColumns({"node": F.monotonically_increasing_id(), "d": F.size("e")}), "classes")
    counts = classes.groupBy("d").count().where(F.col("count") > interval).collect()  # lengths of more than one interval
    turns = {r["d"]: leading_dimensions(classes.where(F.col("d") == r["d"]), r["d"]) for r in counts}
    eps = math.sqrt(2 - 2 * cosine)

    @F.pandas_udf("array<double>")
    def leading(e: pd.Series) -> pd.Series:
        out = np.zeros((len(e), LEAD))
        sizes = e.map(len).to_numpy()
        for d in np.unique(sizes):
            rows = np.flatnonzero(sizes == d)
            out[rows] = leads(unit(np.array(e.iloc[rows].tolist(), np.float64)), turns)
        return pd.Series(list(out), dtype=object)

    placed = classes.withColumn("p", leading("e"))
    cells = [F.floor(F.col("p")[i] / eps).alias(f"c{i}") for i in range(GRID)]
    placed = written(placed.select("node", "size", "d", "e", "p", *cells), "vectors")
    order = ["d", *[f"c{i}" for i in range(GRID)], "node"]
    total = placed.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-total // 50_000))
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = written(ranged.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ordered")
    before = Window.partitionBy("d").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part", "d").agg(F.count("*").alias("n"), F.min("at").alias("first"))  # a row for each range and length
    starts = starts.select("part", "d", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.floor((F.col("start") + F.col("at") - F.col("first")) / interval)
    # an interval holds vectors of one length
    numbered = ranged.join(starts, ["part", "d"]).withColumn("interval", F.shiftleft(F.col("d").cast("long"), 36) + place)
    packs = numbered.groupBy("d", "interval").agg(
        F.sort_array(F.collect_list(F.struct("start", "at", "node", "size", "e"))).alias("rows"),
        F.array(*[F.min(F.col("p")[i]) for i in range(LEAD)]).alias("low"), F.array(*[F.max(F.col("p")[i]) for i in range(LEAD)]).alias("high"),
    )
    packs = written(packs.select("d", "interval", "low", "high", F.col("rows.node").alias("ids"), F.col("rows.size").alias("sizes"), F.flatten("rows.e").alias("flat")), "intervals")
    bounds = packs.select("d", "interval", "low", "high", F.explode(F.sequence(F.floor((F.col("low")[0]) / eps), F.floor(F.col("high")[0] / eps))).alias("cell"))
    # boxes within eps share a first cell or lie in neighbouring ones
    wide = bounds.select("d", F.col("interval").alias("j"), F.col("low").alias("low_y"), F.col("high").alias("high_y"), F.explode(F.array(F.col("cell") - 1, "cell", F.col("cell") + 1)).alias("cell"))
    met = bounds.withColumnRenamed("interval", "i").join(wide, ["d", "cell"]).where("i <= j")
    gaps = F.transform(F.sequence(F.lit(0), F.lit(LEAD - 1)), lambda k: F.greatest(F.lit(0.0), F.col("low")[k] - F.col("high_y")[k], F.col("low_y")[k] - F.col("high")[k]))
    distance = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = met.where(distance <= 2 - 2 * cosine + SLACK).select("i", "j").distinct()
    x = packs.select(F.col("interval").alias("i"), F.col("ids").alias("ids_x"), F.col("sizes").alias("sizes_x"), F.col("flat").alias("flat_x"))
    y = packs.select(F.col("interval").alias("j"), F.col("ids").alias("ids_y"), F.col("sizes").alias("sizes_y"), F.col("flat").alias("flat_y"))
    tasks = pairs.join(x, "i").join(y, "j").repartition("i", "j")
    found = written(tasks.select("i", "j", "ids_x", "sizes_x", "flat_x", "ids_y", "sizes_y", "flat_y").mapInArrow(lambda b: _joined(b, turns, cosine), "node long, links long, root long"), "links")
    joined = components(found.select("node", "root"), "node", "root")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = classes.join(sums, "node", "left").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    named_classes = grouped.join(least, "component").select("e", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    rows = valid.join(named_classes, "e").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return rows.unionByName(alone)


def op10_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return linked(table(spark, folder, "embeddings"))
