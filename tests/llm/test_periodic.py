"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluxwatch.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words, least=6, exponent=4):
    """Every stretch that repeats at some lag and is not extended, under its smallest period."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(words, doc_id):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def contract(doc_id, text):
    words = planted(WORD.findall(text or ""), doc_id)
    runs = runs_of(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, collapsed(words, runs))]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests)


@pytest.mark.parametrize("exponent", [3, 4, 5])
def test_runs_of_many_texts_at_once(exponent):
    pick = random.Random(exponent)
    for _ in range(60):
        texts = []
        for _ in range(pick.randint(1, 5)):
            top = pick.choice([0, 1, 2, 60])
            words = [pick.randint(0, top) for _ in range(pick.randint(0, 250))]
            if pick.random() < 0.7:
                period = [pick.randint(0, top) for _ in range(pick.randint(1, 90))]
                again = (period * 9)[:pick.randint(2 * len(period), 6 * len(period) + 9)]
                at = pick.randint(0, len(words))
                words[at:at] = again
            texts.append(words)
        ids = np.array([x for i, t in enumerate(texts) for x in [*t, -1 - i]], np.int64)
        got = periodic.find_runs(ids, np.array([len(t) for t in texts], np.int64), 6, exponent)
        assert [tuple(r) for r in got.tolist()] == [(i, *r) for i, t in enumerate(texts) for r in runs_of(t, 6, exponent)]


def test_seeds_need_three_periods():
    with pytest.raises(ValueError, match="three periods"):
        periodic.find_runs(np.array([1, -1]), np.array([1]), 6, 2)


def _rows():
    pick = random.Random(3)
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n"), (None, "x " * 9), (4, "one"), (5, "a b a b a b a b"), (5, "a b a b a b a b"), (6, "é\x1cß é\x1cß\té\x1cß\r\né\x1cß é\x1cß é\x1cß")]
    long = [f"w{i}" for i in range(700)]
    rows += [(7, " ".join(["start", *long * 5, "end"])), (8, " ".join(f"v{i}" for i in range(2_000)))]
    for i in range(10, 120):  # every tenth has a period planted
        rows.append((i, "\n".join(f"t{pick.randint(0, 400)}" for _ in range(pick.randint(1, 260)))))
    return rows


def test_query_against_brute_force(spark, tmp_path):
    rows = _rows()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic.op11_periodic(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for n, t in got.dtypes if "sha256" not in n} == {"bigint"}
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(contract(*r)) for r in rows)
    assert any(r["period"] == 700 for r in got.collect())


def test_struct_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 50)  # several chunks, and texts longer than one
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"periodic": F.lit("old"), "runs": F.lit("clash"), "_words": F.lit(1)})
    got = periodic.with_runs(docs)
    assert got.columns == ["doc_id", "text", "periodic", "runs", "_words"]
    for r in got.collect():
        words = WORD.findall(r["text"] or "")
        assert r["periodic"]["n_words"] == len(words) and r["periodic"]["collapsed"] == collapsed(words, runs_of(words))
        assert [tuple(x) for x in r["periodic"]["runs"]] == runs_of(words)
    assert periodic.with_runs(docs.limit(0)).count() == 0
