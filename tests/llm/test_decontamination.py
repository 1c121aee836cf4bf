"""Decontamination against a plain search for every item in every document."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from fluxwatch.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_force(docs, items, span=10):
    spans = {}
    for item, text in items:
        w = words_of(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            spans.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    rows = []
    for doc_id, text in docs:
        w, hit, names = words_of(text), set(), set()
        for n in {len(s) for s in spans}:
            for i in range(len(w) - n + 1):
                if (s := tuple(w[i:i + n])) in spans:
                    hit.update(range(i, i + n))
                    names |= spans[s]
        rows.append((doc_id, len(w), sorted(hit), sorted(names)))
    return rows


def contract(docs, items):
    return [
        (d, n, len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
        for d, n, hit, names in brute_force(docs, items)
    ]


def _rows(short):
    pick = random.Random(6)
    items = [(i, " ".join(f"q{pick.randint(0, 30)}" for _ in range(pick.randint(10, 40)))) for i in range(30)]
    items += [(30, items[3][1]), (31, items[4][1] + " more"), (None, items[5][1].upper()), (3, "Same id, another text of ten words or more than that, É été"), (32, None), (33, ""), (34, "...")]
    if short:
        items += [(40, "tiny item"), (41, "Solo"), (42, "a a a"), (43, "seven words are in this short item")]
    docs = [(None, None), (1, None), (2, ""), (3, "?!"), (4, "solo"), (5, "a a a a a"), (6, "TINY--ITEM tiny item"), (None, items[0][1]), (None, items[0][1])]
    for i in range(10, 200):
        w = [f"q{pick.randint(0, 30)}" for _ in range(pick.randint(1, 60))]
        for _ in range(pick.randint(0, 3)):
            text = pick.choice(items)[1] or ""
            part = text.split()
            a = pick.randint(0, max(0, len(part) - 9))
            w[pick.randint(0, len(w)):0] = part[a:a + pick.randint(8, 25)]
        docs.append((i, pick.choice([" ", ", ", "\n"]).join(w).swapcase() if i % 3 else " ".join(w)))
    docs += [(300 + i, "copy " + items[7][1]) for i in range(40)] + [(300, "copy " + items[7][1])]
    docs.append((900, " ".join(f"z{i}" for i in range(20_000)) + " " + items[8][1]))
    return docs, items


def _frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("short", [False, True])
def test_query_against_brute_force(spark, tmp_path, short):
    docs, items = _rows(short)
    for frame, name in zip(_frames(spark, docs, items), ("documents", "benchmark")):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    got = decontamination.op12_decontamination(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, contract(docs, items)))


@pytest.mark.parametrize("sent", [0, 100_000])
@pytest.mark.parametrize("span", [10, 4])
def test_spans_items_and_clashing_columns(spark, sent, span):
    """Also by shuffled windows, as for a benchmark that is too large to send."""
    docs, items = _rows(True)
    left, right = _frames(spark, docs, items)
    clash = {"contamination": F.lit("old"), "_d": F.lit(0), "mark": F.lit("m"), "length": F.lit(9), "at": F.lit(8), "_words": F.lit("w"), "item_set": F.lit("i")}
    got = decontamination.marked(left.withColumns(clash), right.withColumns({"at": F.lit(1), "item": F.lit("x")}), span=span, sent=sent)
    assert got.columns == ["doc_id", "text", *clash] and got.where("_d = 0 AND length = 9 AND _words = 'w'").count() == len(docs)
    found = [(r["doc_id"], r["contamination"]["n_words"], [i for a, b in r["contamination"]["spans"] for i in range(a, b)], r["contamination"]["items"]) for r in got.collect()]
    assert sorted(map(str, found)) == sorted(map(str, brute_force(docs, items, span)))


def test_empty_tables(spark):
    docs, items = _rows(True)
    left, right = _frames(spark, docs, items)
    assert decontamination.marked(left.limit(0), right).count() == 0
    none = decontamination.marked(left, right.limit(0))
    assert none.where("contamination.n_hit = 0 AND size(contamination.items) = 0").count() == len(docs)
    assert decontamination.marked(left, right.where("text IS NULL")).where("contamination.n_hit > 0").count() == 0


def test_no_python_on_the_way(spark):
    plan = decontamination.op12_decontamination(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
