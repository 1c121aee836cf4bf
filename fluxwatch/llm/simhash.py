"""SimHash near-duplicates: 64-bit fingerprints, compared bit plane by bit plane.

Two fingerprints at most ``radius`` bits apart agree on one of ``radius + 1`` parts of the 64
bits (more parts: on all but ``radius`` of them), so each goes into one bucket per choice of
agreeing parts. A bucket's fingerprints are stored as 64 vertical planes, 64 fingerprints to a
machine word. One query against such a block takes one XOR a plane; carry-save counters sum
the differing planes for all 64 lanes at once, and a block is abandoned as soon as all its
lanes are beyond the radius. Buckets above a size are cut, and pairs of cuts compared, so that a
task's work is bounded; equal fingerprints are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import WORD_BYTES, Groups, components, table
from fluxwatch.session import written

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Bytes of text, and shingles, that are held at a time.
PART_BYTES, PART_SHINGLES = 1 << 20, 1 << 16
#: Fingerprints of one bucket that a cut holds, and that are compared in one go.
CUT, ROWS = 2048, 1 << 16
#: Query-block pairs in flight.
BATCH = 1 << 14


def word_parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in parts of bounded size, cut at white space."""
    start = 0
    while start < len(text):
        end = min(len(text), start + PART_BYTES)
        if end < len(text) and (m := WORD_BYTES.match(text, end)):
            end = m.end()
        yield text[start:end].split()
        start = end


def shingles(text: str | None, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of the shingles of ``width`` words, repeats included, in batches of bounded size; a text of
    fewer words is one shingle, one without words none."""
    total = 0
    carry: list[bytes] = []

    def hashed(spans: list[bytes]) -> Iterator[np.ndarray]:
        nonlocal total
        digest = xxhash.xxh64_intdigest
        for i in range(0, len(spans), PART_SHINGLES):
            total += len(spans[i:i + PART_SHINGLES])
            yield np.array([digest(s, SEED) for s in spans[i:i + PART_SHINGLES]], "<u8")

    for words in word_parts((text or "").encode().lower()):
        words = carry + words
        if len(words) >= width:
            yield from hashed([b" ".join(s) for s in zip(*(words[i:] for i in range(width)))])
            carry = words[-(width - 1):] if width > 1 else []
        else:
            carry = words
    if not total and carry:
        yield from hashed([b" ".join(carry)])


def majority(batches: Iterator[np.ndarray]) -> int:
    """A bit is 1 if it is set in over half of the hashes; no hashes: zero."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in batches:
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits((2 * ones > total).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The fingerprint: a bit is 1 if it is set in over half of the shingles' hashes, repeats included."""
    return majority(shingles(text, width))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed long; no words: zero."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.withColumn(out, of(F.col(text)))


def bucket_masks(parts: int, radius: int = RADIUS) -> list[int]:
    """Bits that must agree, one mask for each choice of ``parts - radius`` parts."""
    edges = np.linspace(0, BITS, parts + 1).round().astype(int)
    part = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(part[i] for i in chosen) for chosen in combinations(range(parts), parts - radius)]


def transpose(values: np.ndarray) -> np.ndarray:
    """Bit planes: (blocks, 64) fingerprints to (64 planes, blocks) words, lane j in bit j."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(*values.shape, 8), axis=2, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little").transpose(2, 0, 1)).view("<u8")[:, :, 0]


def close_lanes(planes: np.ndarray, query: np.ndarray, block: np.ndarray, lanes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Of query-block pairs: the pairs' places and the lanes within the radius.

    ``lanes`` has the lanes each pair asks for. Bit counters are words, one for each binary
    digit up to the radius and one that stays set once a lane is beyond it.
    """
    digits = max(1, int(radius).bit_length())
    place = np.arange(len(query))
    counter = [np.zeros(len(query), np.uint64) for _ in range(digits)]
    over = ~lanes
    one, none = np.uint64(1), np.uint64(0)

    def carried(extra: np.ndarray, at: int) -> np.ndarray:
        for j in range(at, digits):
            counter[j], extra = counter[j] ^ extra, counter[j] & extra
        return extra

    for plane in range(0, BITS, 2):
        a = planes[plane, block] ^ (none - ((query >> np.uint64(plane)) & one))
        b = planes[plane + 1, block] ^ (none - ((query >> np.uint64(plane + 1)) & one))
        # carry-save: three words of weight 1 become a sum of weight 1 and a carry of weight 2
        half = counter[0] ^ a
        carry = (counter[0] & a) | (half & b)
        counter[0] = half ^ b
        over |= carried(carry, 1) if digits > 1 else carry
        if (radius + 1) & radius:  # not all counter values are within the radius
            beyond = np.zeros_like(over)
            equal = ~beyond
            for j in reversed(range(digits)):
                if radius >> j & 1:
                    equal &= counter[j]
                else:
                    beyond |= equal & counter[j]
                    equal &= ~counter[j]
            over |= beyond
        if plane % 8 == 6:
            alive = np.flatnonzero(~over)
            if len(alive) < 0.8 * len(over):
                place, query, block, over = place[alive], query[alive], block[alive], over[alive]
                counter = [c[alive] for c in counter]
            if not len(place):
                break
    return place, ~over


def linked(keys: np.ndarray, values: np.ndarray, side: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows sorted by key: each row's label, links taken inside a key.

    ``side`` 0: compared with all rows of the key; 1 and 2: rows of two cuts, only compared
    with the other side (each side is compared by itself elsewhere).
    """
    n = len(keys)
    groups = Groups(n)
    start = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (side[1:] != side[:-1])])
    size = np.diff(np.r_[start, n])
    first = np.repeat(start, size)
    rank = np.arange(n) - first
    # blocks of 64 rows of one key and side
    count = (size + 63) // 64
    base = np.r_[0, np.cumsum(count)]
    mine = np.repeat(base[:-1], size) + rank // 64
    lane = (rank % 64).astype(np.uint64)
    filled = np.zeros((int(base[-1]), 64), "<u8")
    filled[mine, rank % 64] = values
    row_at = np.full((int(base[-1]), 64), -1, np.int64)
    row_at[mine, rank % 64] = np.arange(n)
    full = np.zeros(int(base[-1]), np.uint64)
    np.bitwise_or.at(full, mine, np.uint64(1) << lane)
    planes = transpose(filled)
    # a row asks the lanes behind it in its own block and all later blocks; on side 1 the blocks of side 2
    run = np.repeat(np.arange(len(start)), size)
    begin, end = mine.copy(), base[run + 1]
    other = side == 1
    follows = np.r_[(keys[start[1:]] == keys[start[:-1]]), False] if len(start) > 1 else np.zeros(len(start), bool)
    begin[other] = base[run[other] + 1]
    end = np.where(other, np.where(follows[run], base[np.minimum(run + 2, len(base) - 1)], begin), end)
    begin = np.where(side == 2, end, begin)
    asks = end - begin
    values = values.astype(np.uint64)
    at = 0
    steps = np.cumsum(asks)
    while at < n:
        stop = max(at + 1, int(np.searchsorted(steps, (steps[at - 1] if at else 0) + BATCH, "right")))
        rows = np.repeat(np.arange(at, stop), asks[at:stop])
        at = stop
        if not len(rows):
            continue
        offset = np.arange(len(rows)) - np.repeat(np.cumsum(asks[rows[0]:stop]) - asks[rows[0]:stop], asks[rows[0]:stop])
        block = begin[rows] + offset
        want = full[block]
        own = block == mine[rows]
        behind = ~((np.uint64(2) << lane[rows]) - np.uint64(1))  # lane 63: 2 << 63 wraps to 0, so nothing is behind
        want = np.where(own, want & behind, want)
        asked = np.flatnonzero(want)
        place, hits = close_lanes(planes, values[rows[asked]], block[asked], want[asked], radius)
        found = np.flatnonzero(hits)
        place, hits = asked[place[found]], hits[found]
        bits = np.unpackbits(hits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pair, bit = np.nonzero(bits)
        groups.link(rows[place[pair]], row_at[block[place[pair]], bit])
    return groups.label


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, side) to links (a, b) of a spanning forest of each key."""
    def flush(chunk: pa.Table) -> pa.RecordBatch:
        bucket, pair = chunk["bucket"].to_numpy(), chunk["pair"].to_numpy()
        mask, side = chunk["mask"].to_numpy(), chunk["side"].to_numpy()
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1]) | (mask[1:] != mask[:-1])]
        key = np.cumsum(new)
        value = chunk["fp"].to_numpy()
        label = linked(key, value.view(np.uint64), side, radius)
        joined = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(value[joined]), pa.array(value[label[joined]])], ["a", "b"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < ROWS:
            continue
        rows = pa.Table.from_batches(held)
        # keep the last key for the next round; a key has at most two cuts of rows
        last = [rows[c][-1].as_py() for c in ("mask", "bucket", "pair")]
        same = np.ones(rows.num_rows, bool)
        for c, v in zip(("mask", "bucket", "pair"), last):
            same &= rows[c].to_numpy() == v
        cut = int(rows.num_rows - same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield flush(rows.slice(0, cut))
        held, size = rows.slice(cut).to_batches(), rows.num_rows - cut
    if size:
        yield flush(pa.Table.from_batches(held))


def links(distinct: DataFrame, fp: str = "fp", radius: int = RADIUS, parts: int | None = None, cut: int = CUT) -> DataFrame:
    """Links (a, b) between distinct fingerprints: a spanning forest of each bucket, so copies
    and dense groups give no more links than members. ``parts`` is how many parts the bits are
    dealt in (more: smaller buckets, more copies of each fingerprint); by default it grows with
    the number of fingerprints. All choices find the same components."""
    if parts is None:
        n, parts = distinct.count(), radius + 1
        while n >> (BITS * (parts - radius) // parts) > 1024 and parts < 2 * radius + 2:
            parts += 1
    masks = bucket_masks(parts, radius)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    dealt = distinct.select(F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col(fp).bitwiseAND(F.lit(m)).alias("bucket"), F.col(fp).alias("fp")) for i, m in enumerate(signed)])).alias("x")).select("x.*")
    sizes = dealt.groupBy("mask", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    sized = dealt.join(sizes, ["mask", "bucket"])
    cuts = F.ceil(F.col("n") / cut)
    mine = F.pmod(F.xxhash64("fp"), cuts)
    # cut i goes to the tasks of all pairs (i, j): alone (side 0) as (i, i), else as the lower or upper side
    spread = sized.withColumns({"_cuts": cuts, "_mine": mine}).withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cuts") - 1)))
    tasks = spread.select(
        "mask", "bucket", (F.least("_mine", "_with") * F.col("_cuts") + F.greatest("_mine", "_with")).alias("pair"),
        F.when(F.col("_mine") == F.col("_with"), 0).when(F.col("_mine") < F.col("_with"), 1).otherwise(2).alias("side"), "fp",
    )
    ordered = tasks.repartition("mask", "bucket", "pair").sortWithinPartitions("mask", "bucket", "pair", "side")
    return ordered.mapInArrow(lambda batches: _compare(batches, radius), "a long, b long")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row a document: (doc_id, fp, component_id), component_id the smallest doc_id linked to it
    by fingerprints at most ``radius`` bits apart, over any number of links.

    Null ids never name a component unless all of it are null; repeated rows come back
    repeated; an empty table gives an empty result. Other columns are left out.
    """
    marked = written(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text").select("doc_id", "fp"), "fingerprints")
    lookup = _members(marked, F.min("doc_id").alias("component_id"), radius)
    return marked.join(lookup.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _members(marked: DataFrame, least: Column, radius: int) -> DataFrame:
    """Each distinct fingerprint with its component and the aggregate ``least`` over the component's rows."""
    name = "_least"
    distinct = written(marked.groupBy("fp").agg(least.alias(name)), "distinct")
    joined = components(links(distinct, radius=radius))
    named = distinct.join(joined, distinct["fp"] == joined["node"], "left").select("fp", name, F.coalesce("component", "fp").alias("component"))
    return named.join(named.groupBy("component").agg(F.min(name).alias("component_id")), "component")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group of linked fingerprints: the one of the smallest id,
    of rows that share it the one of the smallest text hash. A null id counts as the largest.
    Columns stay as they are; texts move once, to meet the list of those that stay.
    """
    keys = {"_keep_d": F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)), "_keep_h": F.xxhash64(F.col(text))}
    keyed = docs.withColumns(keys)
    marked = written(fingerprints(keyed.select("_keep_d", "_keep_h", F.col(text).alias("_text")), "_text").select("_keep_d", "_keep_h", "fp"), "fingerprints")
    named = _members(marked, F.min(F.struct("_keep_d", "_keep_h")), radius)
    keep = named.select("component_id.*").distinct()
    first = Window.partitionBy("_keep_d", "_keep_h").orderBy(F.lit(0))
    kept = keyed.join(keep, ["_keep_d", "_keep_h"], "left_semi").withColumn("_keep_row", F.row_number().over(first)).where("_keep_row = 1")
    return kept.select(*docs.columns)


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
