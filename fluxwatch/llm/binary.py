"""Token ids as binary blocks: every document compressed by itself with a shared dictionary.

A zstandard dictionary is trained on the serialized ids of a bounded sample. Each document is one
frame, so one short document can be read without its neighbours. A block holds consecutive
documents in ascending id order:

    magic "FXID" | version u1 | bytes per id u1 | documents u4 | dictionary hash 16 bytes
    | offset index: documents + 1 times u8, from the first frame | frames

All numbers are little-endian. Blocks lie as rows of a Parquet table beside the first and last id
they hold, so any store that Spark writes to will do, and a look-up skips other blocks by these columns.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import batches_of, let_go, table
from fluxwatch.llm.packing import END_ID
from fluxwatch.llm.tokens import encoder, vocabulary
from fluxwatch.session import run_dir, written

MAGIC, VERSION, HEAD = b"FXID", 1, "<4sBBI16s"
#: Documents the dictionary is trained on, bytes taken of each, and the dictionary's size.
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 8192, 65536
BLOCK_BYTES, LEVEL = 1 << 20, 3
#: Documents scanned and compressed before their frames go on, bytes of texts or frames handed to Python at a time, and bytes of frames of one range of ids, about.
ROWS, BATCH_BYTES, RANGE_BYTES = 500, 4 << 20, 8 << 20
#: Words a worker remembers (twice, see tokens): about 250 bytes each, beside an executor that sorts frames.
WORDS = 300_000
#: Frames are compressed already: a codec would only hold each page of them twice more, in buffers outside the heap that stay.
PLAIN = {"compression": "none"}


def packed_ids(ids: bytes, width: int) -> bytes:
    """32-bit ids as they are stored: two bytes each where the vocabulary allows."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def unpacked_ids(stored: bytes, width: int) -> np.ndarray:
    return np.frombuffer(stored, "<u2" if width == 2 else "<u4").astype("<u4")


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()[:16]


def train(samples: list[bytes]) -> bytes:
    """The dictionary; too few or too even samples give an empty one, and frames without."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def sample_of(stored: bytes, width: int) -> bytes:
    """At most SAMPLE_BYTES in a row of a document's stored ids, from a place its content chooses."""
    places = max(0, len(stored) - SAMPLE_BYTES) // width + 1
    start = zlib.crc32(stored) % places * width
    return stored[start:start + SAMPLE_BYTES]


def _shared(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_shared(dictionary), write_dict_id=False)


def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_shared(dictionary))


def block(frames: list[bytes], width: int, digest: bytes) -> bytes:
    index = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8")
    return struct.pack(HEAD, MAGIC, VERSION, width, len(frames), digest) + index.tobytes() + b"".join(frames)


def open_block(data: bytes, digest: bytes) -> tuple[int, np.ndarray, memoryview]:
    """(bytes per id, offset index, frames) of a block; refuses another format or dictionary."""
    magic, version, width, n, written_with = struct.unpack_from(HEAD, data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of this format")
    if written_with != digest:
        raise ValueError("the block was written with another dictionary")
    index = np.frombuffer(data, "<u8", n + 1, struct.calcsize(HEAD))
    return width, index, memoryview(data)[struct.calcsize(HEAD) + 8 * (n + 1):]


def read_frame(data: bytes, place: int, dictionary: bytes) -> np.ndarray:
    """The ids of one document of a block, other frames untouched."""
    width, index, frames = open_block(data, dictionary_hash(dictionary))
    frame = bytes(frames[int(index[place]):int(index[place + 1])])
    return unpacked_ids(decompressor(dictionary).decompress(frame), width)


def write_ids(docs: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of all documents, each with the end id, to ``folder`` in ascending doc_id order.

    ``folder/dictionary`` has the dictionary, ``folder/blocks`` the blocks. A null text counts as empty;
    null ids come first; rows of one id lie side by side. Encoding is one scan; compressed frames
    are sorted by ranges of ids, so no task holds more than its range.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    width = 2 if encoder(path, WORDS, lasting=True).library.get_vocab_size() <= 1 << 16 else 4
    end = END_ID.to_bytes(4, "little")

    @F.pandas_udf("binary")
    def sampled(texts: pd.Series) -> pd.Series:
        use = encoder(path, WORDS, lasting=True)
        return pd.Series([sample_of(packed_ids(use.ids(t or "") + end, width), width) for t in texts])

    chosen = named.select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(SAMPLE)
    rows = named.join(F.broadcast(chosen), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id")).limit(SAMPLE)
    with batches_of(spark, ROWS, BATCH_BYTES):
        dictionary = train([bytes(r[0]) for r in rows.select(sampled("text")).collect()])
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    digest = dictionary_hash(dictionary)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, tool = encoder(path, WORDS, lasting=True), compressor(dictionary)
        for batch in batches:
            # a few rows at a time: the text of one row is held, not of the batch
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                sizes, ties, made = [], [], []
                for body in use.each(body.as_py() for body in part.column(1)):
                    ids = body + end
                    sizes.append(len(ids) // 4)
                    ties.append(zlib.crc32(ids))
                    made.append(tool.compress(packed_ids(ids, width)))
                lengths = pa.array([len(frame) for frame in made], pa.int64())
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(ties, pa.int64()), lengths, pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "tie", "size", "frame"])

    # the ranges are sampled and then dealt: written first, or every text would be encoded twice
    with batches_of(spark, ROWS, BATCH_BYTES):
        encoded = written(named.mapInArrow(compress, "doc_id long, n long, tie long, size long, frame binary"), "frames", **PLAIN)
    size = encoded.agg(F.sum(F.col("size") + 64)).first()[0] or 0  # a row has its keys too
    parts = max(1, -(-size // RANGE_BYTES), spark.sparkContext.defaultParallelism)
    ties = encoded.drop("size").withColumn("_again", F.monotonically_increasing_id())
    ordered = ties.repartitionByRange(parts, "doc_id", "tie", "_again").sortWithinPartitions("doc_id", "tie", "_again")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "n", "frame")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # the words of the tasks before
        frames: list[bytes] = []
        ids: list[int | None] = []
        total = size = number = 0

        def flush(part: int) -> pa.RecordBatch:
            columns = [[part], [number], [ids[0]], [ids[-1]], [ids], [len(ids)], [total], [block(frames, width, digest)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, BLOCKS.types)], schema=BLOCKS)

        part = 0
        for batch in batches:
            for part, key, n, frame in (tuple(batch.column(i)[row].as_py() for i in range(4)) for row in range(batch.num_rows)):
                frames.append(frame)
                ids.append(key)
                total, size = total + n, size + len(frame)
                if size >= BLOCK_BYTES:
                    yield flush(part)
                    frames, ids, total, size, number = [], [], 0, 0, number + 1
        if ids:
            yield flush(part)

    with batches_of(spark, ROWS, BATCH_BYTES):
        ordered.mapInArrow(blocks, BLOCKS_DDL).write.options(**PLAIN).parquet(f"{folder}/blocks")


BLOCKS = pa.schema([
    ("part", pa.int32()), ("number", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary()),
])
BLOCKS_DDL = "part int, number int, first_id long, last_id long, doc_ids array<long>, n_docs long, n_ids long, data binary"


def dictionary_of(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.parquet(f"{folder}/dictionary").first()[0])


def read_ids(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """Documents from the files: (doc_id, start, n_tokens, ids_crc32) and, if asked for, ``ids``.

    ``start`` is the number of ids before the document: ids of earlier parts, of earlier blocks
    of the part, of earlier documents of the block.
    """
    dictionary = dictionary_of(spark, folder)
    stored = spark.read.schema(BLOCKS_DDL).parquet(f"{folder}/blocks")
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("_n"))  # a row for each writing task
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_part"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.select("part", "number", "n_ids").withColumn("_block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    starts = counts.join(parts, "part").select("part", "number", (F.col("_part") + F.col("_block")).alias("start"))
    # a row for each block, not its data
    placed = stored.join(F.broadcast(starts), ["part", "number"]).select("start", "doc_ids", "data")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # the words of the tasks before
        digest, tool = dictionary_hash(dictionary), decompressor(dictionary)
        for batch in batches:
            for start, keys, data in zip(*(batch.column(i) for i in range(3))):
                start, data = start.as_py(), data.as_py()
                width, index, frames = open_block(data, digest)
                ids = [unpacked_ids(tool.decompress(bytes(frames[a:b])), width) for a, b in zip(index[:-1].tolist(), index[1:].tolist())]
                sizes = np.array([len(i) for i in ids], np.int64)
                columns = [
                    keys.values, pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    columns, names = [*columns, pa.array([i.tobytes() for i in ids], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else ""))


def lookup(spark: SparkSession, folder: str, doc_id: int) -> np.ndarray | None:
    """The ids of one document: one block is read, one frame of it decompressed."""
    found = spark.read.schema(BLOCKS_DDL).parquet(f"{folder}/blocks").where((F.col("first_id").isNull() | (F.col("first_id") <= doc_id)) & (F.col("last_id") >= doc_id))
    row = found.where(F.array_contains("doc_ids", doc_id)).select("doc_ids", "data").first()
    return None if row is None else read_frame(bytes(row["data"]), row["doc_ids"].index(doc_id), dictionary_of(spark, folder))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = run_dir(spark, "token-files")
    write_ids(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), target)
    return read_ids(spark, target)
