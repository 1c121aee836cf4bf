"""Near copies by five-word shingle sets, against brute force."""

import numpy as np
from pyspark.sql import functions as F

from fluxwatch.llm import common, near

WORDS = [f"word{i}" for i in range(3000)]


def brute(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def similarity(a, b):
    return len(a & b) / len(a | b)


def planted(pick, low, high, n):
    """A text and a copy with words replaced until the similarity is in the range."""
    while True:
        words = list(pick.choice(WORDS, n))
        copy = list(words)
        for i in pick.permutation(n):
            copy[i] = "changed"
            found = similarity(brute(" ".join(words)), brute(" ".join(copy)))
            if found < high:
                break
        if found >= low:
            return " ".join(words), " ".join(copy)


def kept_ids(rows):
    """The smallest id of each group linked at 0.8 or more."""
    label = {i: i for i, _ in rows}
    sets = [(i, brute(t)) for i, t in rows]
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if similarity(a, b) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return set(label.values())


def corpus():
    pick = np.random.default_rng(11)
    pairs = [planted(pick, 0.8, 0.85, int(n)) for n in pick.integers(60, 400, 60)]
    pairs += [planted(pick, 0.7, 0.8, int(n)) for n in pick.integers(60, 400, 20)]
    rows = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    base = list(pick.choice(WORDS, 300))
    for i in range(40):  # copies of a text with one more changed word each: a chain
        base[7 * i] = f"x{i}"
        rows.append((1000 + i, " ".join(base)))
    return rows + [(2000, "a b"), (2001, "A  b"), (2002, "c d e"), (2003, rows[0][1])]


def test_pairs_just_above_the_similarity_are_linked(spark):
    rows = corpus()
    want = kept_ids(rows)
    assert len(want) < len(rows) - 60
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("x"))
    found = near.representatives(frame)
    assert found.columns == frame.columns
    assert {r["doc_id"] for r in found.collect()} == want


def test_small_cuts_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(near, "CUT", 16)
    monkeypatch.setattr(near, "PAIRS", 3)
    rows = corpus()
    found = near.representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in found.collect()} == kept_ids(rows)


def test_awkward_rows(spark):
    rows = [(None, "only words here now and then"), (3, None), (4, ""), (5, "one two three four five six"), (5, "one two three four five six")]
    found = near.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1) for r in found) == [-1, 3, 5]
    assert near.representatives(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def without_least(pick, n):
    """A text, and a near copy that lacks its least shingle under each of the four orders of ``mixed``."""
    words = list(pick.choice(WORDS, n))
    hashes = np.concatenate(list(near.shingles(" ".join(words), 5)))
    copy = list(words)
    for order in range(4):
        copy[int(near.mixed(hashes, order).view("<i8").argmin()) + 2] = f"other{order}"
    return " ".join(words), " ".join(copy)


def test_pairs_that_share_no_least_shingle_are_linked(spark):
    pick = np.random.default_rng(5)
    pairs = [without_least(pick, int(n)) for n in pick.integers(250, 500, 20)]
    assert all(similarity(brute(a), brute(b)) >= 0.8 for a, b in pairs)
    rows = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    found = near.representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in found.collect()} == {2 * i for i in range(len(pairs))}


def test_short_pairs_are_linked(spark):
    pick = np.random.default_rng(6)
    texts = [" ".join(pick.choice(WORDS, int(n))) for n in pick.integers(8, 30, 300)]
    rows = [(2 * i + k, t + end) for i, t in enumerate(texts) for k, end in enumerate(("", " end"))]
    found = near.representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in found.collect()} == {2 * i for i in range(len(texts))}


def test_a_large_group_is_not_listed_pair_by_pair(spark, monkeypatch):
    pick, sizes = np.random.default_rng(7), {}
    base = list(pick.choice(WORDS, 400))
    rows = []
    for i in range(150):  # each two share about 0.7
        copy = list(base)
        for at in pick.permutation(400)[:8]:
            copy[at] = f"own{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, f"{t} end") for i, t in rows[:20]]
    write = near.written

    def counted(df, name):
        made = write(df, name)
        sizes[name] = max(sizes.get(name, 0), made.count())
        return made

    monkeypatch.setattr(near, "written", counted)
    monkeypatch.setattr(common, "written", counted)
    found = {r["doc_id"] for r in near.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == kept_ids(rows) and len(found) > 100
    assert max(sizes.values()) <= 10 * len(rows)
