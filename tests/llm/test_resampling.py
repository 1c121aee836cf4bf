"""Importance resampling against a plain Python version."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fluxwatch.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def contract(docs, items):
    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(buckets_of(text)[1])
    for _, text in items:
        t.update(buckets_of(text)[1])
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        n, found = buckets_of(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:5 * len(able) // 100], 1):
        r.append(rank)
    return [tuple(r[:4] + [r[5] if len(r) > 5 else None]) for r in rows]


def _rows():
    pick = random.Random(4)
    names = ["Alpha", "beta", "g7", "été", "ÉTÉ", "x" * 300, "delta", *[f"w{i}" for i in range(90)]]
    rows = [(None, None), (1, None), (2, ""), (3, "!! -- ??"), (4, "One,two.THREE"), (5, "Éa\x00b\x7fc\tD"), (6, "long " * 9000)]
    for i in range(10, 260):
        rows.append((i, pick.choice([" ", ". ", "\n-"]).join(pick.choice(names) for _ in range(pick.randint(1, 90)))))
    copy = rows[-1][1]
    rows += [(1000 + i, copy) for i in range(150)] + [(None, copy), (1000, copy)]
    return rows


ITEMS = [(0, "alpha beta delta w1 w2 w3"), (1, None), (2, "été w5 w6 w7 w5 w6 w7"), (None, "")]


def _tables(spark, folder, docs, items):
    spark.createDataFrame(docs, "doc_id long, text string").repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


@pytest.mark.parametrize("chunk", [1 << 18, 64])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(resampling, "CHUNK_WORDS", chunk)
    rows = _rows()
    _tables(spark, tmp_path, rows, ITEMS)
    got = resampling.op13_resampling(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    found = [tuple(r) for r in got.collect()]
    assert sorted(map(str, found)) == sorted(map(str, contract(rows, ITEMS)))
    assert sum(r[4] is not None for r in found) >= 10


def test_matrices_equal_zlib():
    pick = random.Random(5)
    data = bytes(pick.randrange(256) for _ in range(5000))
    starts = [pick.randrange(4000) for _ in range(300)] + [0, 0]
    lengths = [pick.choice([0, 1, 2, 3, 17, 255, 256, 257, 900]) for _ in range(300)] + [5000, 0]
    got = resampling.crcs(np.frombuffer(data, np.uint8), np.array(starts), np.array(lengths))
    assert got.tolist() == [zlib.crc32(data[s:s + n]) for s, n in zip(starts, lengths)]
    assert resampling.crcs(np.zeros(0, np.uint8), np.zeros(0, int), np.zeros(0, int)).tolist() == []


def test_crcs_of_runs_go_on_from_shorter_ones():
    data = b"one two" + b"x" * 300 + b"three"
    starts, lengths = np.array([0, 4, 7, 307, 2]), np.array([3, 3, 300, 5, 0])
    before = [zlib.crc32(b"run %d " % i) for i in range(5)]
    got = resampling.crcs(np.frombuffer(data, np.uint8), starts, lengths, np.array(before, np.uint32))
    assert got.tolist() == [zlib.crc32(data[s:s + n], c) for s, n, c in zip(starts, lengths, before)]


@pytest.mark.parametrize("longest", [1, 3, 5])
def test_runs_stay_inside_their_text(longest):
    texts = ["", "  a", "b", "--", "a,, b\x7fc " + "y" * 257 + " d", "É  é", ""]
    plain = [t.encode().translate(resampling.PLAIN) for t in texts]
    got = [list(zip(owner.tolist(), bucket.tolist())) for bucket, owner in resampling.features(plain, longest)]
    words = [p.split() for p in plain]
    assert got == [[(k, zlib.crc32(b" ".join(w[i:i + n])) % 10_000) for k, w in enumerate(words) for i in range(len(w) - n + 1)] for n in range(1, longest + 1)]
    assert all(len(b) == len(o) == 0 for b, o in resampling.features([b"", b" "], longest))


def test_texts_are_read_twice(spark, tmp_path, monkeypatch):
    """Once to count the corpus and once to weigh it, not again to choose the ranges of ranks."""
    rows = _rows()
    _tables(spark, tmp_path, rows, ITEMS)
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def told(texts: pd.Series) -> pd.Series:
        seen.add(len(texts))
        return texts

    plain = resampling.table
    monkeypatch.setattr(resampling, "table", lambda spark, folder, name: plain(spark, folder, name).withColumn("text", told("text")) if name == "documents" else plain(spark, folder, name))
    found = [tuple(r) for r in resampling.op13_resampling(spark, str(tmp_path)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, contract(rows, ITEMS)))
    assert seen.value == 2 * len(rows)


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    _tables(spark, tmp_path, [], [])
    assert resampling.op13_resampling(spark, str(tmp_path)).count() == 0
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"importance": F.lit(1), "rank": F.lit("r"), "n": F.lit(2), "score": F.lit("s"), "bucket": F.lit("b")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("n", F.lit(3))
    got = resampling.resampled(docs, items)
    assert set(got.columns) == set(docs.columns)
    want = {(r[0], r[3], r[4]) for r in contract(rows, ITEMS) if r[4]}
    assert {(r["doc_id"], r["importance"]["score"], r["importance"]["rank"]) for r in got.collect()} == want
    # without a target every document is as likely as any other: the gains are those of an empty one
    assert resampling.resampled(docs, items.limit(0)).count() == len(want)


def test_ranks_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("score"), F.lit("x").alias("rank"))
    kept = {}
    for n in (1, 9):
        ranked = resampling.drawn(rows.repartition(n), "score", F.col("doc_id") % 2 == 0, 10)
        kept[n] = sorted((r["rank"], r["doc_id"]) for r in ranked.where("rank IS NOT NULL").collect())
    best = sorted(((-(i % 7), i) for i in range(0, 5000, 2)))[:250]
    assert kept[1] == kept[9] == [(k + 1, i) for k, (_, i) in enumerate(best)]
