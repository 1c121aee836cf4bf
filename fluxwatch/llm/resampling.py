"""Importance resampling towards a target: documents are drawn by how much more likely the
target's hashed word runs are than the corpus's own.

A feature is a run of one to three words; its bucket is the CRC-32 of its bytes, modulo the buckets. CRCs are
computed for many features at once: the words of a batch are grouped by length into
matrices of bytes, one row per byte position, and each step updates the CRCs of a whole matrix by one byte.
The CRC of a run goes on from that of the run without its last word. The results are scattered back to the
places of their features.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import free, table
from fluxwatch.session import written

BUCKETS, LONGEST_RUN = 10_000, 3
#: Of the documents with at least this many words, this many in a hundred are drawn.
LEAST_WORDS, PERCENT, SEED = 20, 5, "42"
#: Words handled at once; a longer text is handled alone.
CHUNK_WORDS = 1 << 18
#: Words of more bytes are rare and would be a matrix each: zlib takes them.
WIDEST = 256

#: A-Z to a-z, digits and bytes beyond ASCII as they are, anything else to a blank.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _crc_table() -> np.ndarray:
    rows = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rows = np.where(rows & 1, (rows >> 1) ^ np.uint32(0xEDB88320), rows >> 1).astype(np.uint32)
    return rows


CRC = _crc_table()


def matrices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """The slices ``data[start : start + length]`` by length: which they are, and their bytes, a row per position (none above WIDEST)."""
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        length, at = int(lengths[rows[0]]), starts[rows]
        yield rows, None if length > WIDEST else np.array([data[at + k] for k in range(length)], np.uint8)


def stepped(crc: np.ndarray, byte: np.ndarray | np.uint8) -> np.ndarray:
    """Inverted CRCs, one byte further."""
    return CRC[(crc ^ byte) & 0xFF] ^ (crc >> np.uint32(8))


def crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, before: np.ndarray | None = None, parts: list | None = None) -> np.ndarray:
    """CRC-32 of the slices ``data[start : start + length]``, by matrices of equal length (``parts``, if they are made already),
    each going on from the CRC ``before`` it."""
    result = np.zeros(len(starts), np.uint32) if before is None else before.copy()
    for rows, matrix in matrices(data, starts, lengths) if parts is None else parts:
        if matrix is None:
            result[rows] = [zlib.crc32(data[s:s + n], c) for s, n, c in zip(starts[rows].tolist(), lengths[rows].tolist(), result[rows].tolist())]
            continue
        crc = ~result[rows]
        for column in matrix:
            crc = stepped(crc, column)
        result[rows] = ~crc
    return result


def features(texts: list[bytes], longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For run lengths 1, 2, ..: the bucket of each run of that many words, and the text it is in (ascending)."""
    data = np.frombuffer(b" %b " % b" ".join(texts), np.uint8)
    edges = np.flatnonzero(np.diff(data == 32)) + 1
    begins, ends = edges[::2], edges[1::2]
    borders = np.cumsum([1, *[len(t) + 1 for t in texts]])
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(begins, borders)))
    parts = list(matrices(data, begins, ends - begins))
    crc = None
    for size in range(1, longest + 1):
        if size > 1:  # the run one word shorter that ends a word before, and a blank
            crc[1:] = ~stepped(~crc[:-1], np.uint8(32))
        crc = crcs(data, begins, ends - begins, crc, parts)  # of the runs that end with each word
        lasts = np.flatnonzero(owner[size - 1:] == owner[:max(len(owner) - size + 1, 0)]) + size - 1
        yield (crc[lasts] % np.uint32(buckets)).astype(np.int64), owner[lasts]


def chunks(texts: Iterator[bytes | None]) -> Iterator[list[bytes]]:
    """Texts as words between blanks, in groups of bounded size."""
    held, size = [], 0
    for body in texts:
        plain = body.translate(PLAIN) if body else b""
        words = plain.count(b" ") + 1  # at most
        if held and size + words > CHUNK_WORDS:
            yield held
            held, size = [], 0
        held.append(plain)
        size += words
    if held:
        yield held


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any.

    A task adds up its own rows first and hands on at most one row per bucket."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in chunks(v.as_py() for v in batch.column(0)):
                for bucket, _ in features(texts, longest, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(added, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket: thousandths of the log of its share in the target by that in the corpus, both
    with one feature more in every bucket."""
    def side(counts: DataFrame, here: Column, there: Column) -> DataFrame:
        return counts.select("bucket", here.alias("in_corpus"), there.alias("in_target"))

    none = F.lit(0).cast("long")
    every = side(corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket"), none, none)
    rows = side(corpus, F.col("n"), none).union(side(target, none, F.col("n"))).union(every)
    counts = rows.groupBy("bucket").agg(F.sum("in_corpus").cast("double").alias("s"), F.sum("in_target").cast("double").alias("t"))
    whole = Window.partitionBy()  # one row a bucket
    all_s, all_t = F.sum("s").over(whole), F.sum("t").over(whole)
    ratio = (F.col("t") + 1) * (all_s + buckets) / ((F.col("s") + 1) * (all_t + buckets))
    return counts.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weighted(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", longest: int = LONGEST_RUN, buckets: int = BUCKETS, out: str = "importance") -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_features and weight (the sum of its features' gains).

    The corpus is counted in one pass, the table of gains (one number a bucket) goes to every task, and a
    second pass adds them up. Words are runs of digits, letters (A-Z as a-z) and anything beyond ASCII; null and
    empty texts have none and weigh 0. Other columns are untouched and one named ``out`` is replaced.
    """
    table_of = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    gain = np.zeros(buckets, np.int64)
    for row in table_of.collect():  # one row a bucket
        gain[row["bucket"]] = row["gain"]

    @F.pandas_udf("n_words long, n_features long, weight long")
    def measured(bodies: pd.Series) -> pd.DataFrame:
        made = []
        for texts in chunks(bodies):
            found, weight = [], np.zeros(len(texts), np.int64)
            for bucket, owner in features(texts, longest, buckets):
                found.append(np.bincount(owner, minlength=len(texts)))
                total = np.concatenate(([0], np.cumsum(gain[bucket])))
                weight += np.diff(total[np.concatenate(([0], np.cumsum(found[-1])))])
            made.append(np.column_stack([found[0], np.sum(found, axis=0), weight]))
        return pd.DataFrame(np.concatenate(made) if made else np.zeros((0, 3), np.int64), columns=["n_words", "n_features", "weight"])

    return docs.withColumn(out, measured(F.col(text).cast("binary")))


def noise(doc_id: str, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, decided by the seed and the id; a null id counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def drawn(rows: DataFrame, score: str, may: Column, percent: int = PERCENT, doc_id: str = "doc_id", out: str = "rank") -> DataFrame:
    """``rows`` with ``out`` (a column of that name is replaced): 1, 2, 3, .. for the highest scores of the rows that ``may`` be drawn, down to
    ``percent`` of a hundred of them (rounded down); null for all others.

    Ties go to the smaller id, a null id last; rows equal in both are interchangeable. All rows are written once, so that
    sampling for the ranges does not make them again. Score and id of those that may be drawn are sorted by ranges and
    written with their range; a rank is the place in the range plus the rows of the ranges before, so no task
    orders more than one range.
    """
    able, spread, part, start, whole, place = (free(name, rows.columns) for name in ("_able", "_spread", "_range", "_start", "_all", "_place"))
    marked = written(rows.withColumns({able: may, spread: F.monotonically_increasing_id()}), "scored")
    order = [F.desc(score), F.asc_nulls_last(doc_id), F.col(spread)]
    kept = written(marked.where(able).select(score, doc_id, spread).repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    sizes = kept.groupBy(part).agg(F.count("*").alias("_n"))
    # one row a range: as many as partitions
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(start), F.sum("_n").over(Window.partitionBy()).alias(whole))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    ranked = kept.join(F.broadcast(starts), part).withColumn(place, (inside + F.col(start)).cast("long"))
    chosen = ranked.where(F.col(place) <= F.floor(F.col(whole) * percent / 100)).select(spread, place)
    return marked.join(chosen, spread, "left").withColumn(out, F.col(place)).drop(able, spread, place)


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "importance") -> DataFrame:
    """The drawn documents only, with ``out`` (n_words, n_features, weight, score, rank): what a training run takes."""
    scored = weighted(docs, target, text, out=out)
    score, rank = free("_score", scored.columns), free("_rank", scored.columns)
    scored = scored.withColumn(score, F.col(out)["weight"] + noise(doc_id))
    ranked = drawn(scored, score, F.col(out)["n_words"] >= LEAST_WORDS, doc_id=doc_id, out=rank).where(F.col(rank).isNotNull())
    full = F.struct(F.col(out)["n_words"].alias("n_words"), F.col(out)["n_features"].alias("n_features"), F.col(out)["weight"].alias("weight"), F.col(score).alias("score"), F.col(rank).alias("rank"))
    return ranked.withColumn(out, full).drop(score, rank)


def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = weighted(docs, table(spark, folder, "benchmark")).select("doc_id", "importance.*")
    scored = rows.withColumn("score", F.col("weight") + noise("doc_id"))
    return drawn(scored, "score", F.col("n_words") >= LEAST_WORDS).drop("n_words")
