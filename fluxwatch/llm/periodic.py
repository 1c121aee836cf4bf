"""Periodic runs: stretches of words that repeat themselves, found by multi-scale minimizers.

A batch of texts becomes one array of word numbers with a mark of its own after every text. Short
periods are read off direct lag scans. A longer period q belongs to the scale P (a power of two, P <= q < 2P):
there the words are taken in grams of 2P, which are all different within a period, and the least gram hash
of every window of words is kept. Inside a run the window least repeats q words further on, so two neighbouring
minimizers of equal hash at a distance of q are the seed of the run, which is extended word by
word to its exact ends. Every long enough run has such a seed; seeds that lead to none cost only their extension.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.llm.common import WORD, table

#: A run holds at least this many words and this many periods.
LEAST, EXPONENT = 6, 4
#: Periods below this are scanned for lag by lag; the first scale begins here.
FIRST_SCALE = 16
#: Words handled at once; a longer text is handled alone.
CHUNK_WORDS = 1 << 18

SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _window(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over ``values[i : i + width]`` for every i that has that many."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def _lag_runs(ids: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of at least ``least`` words that repeat at ``lag``."""
    if len(ids) <= lag:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(ids) - lag + 2, np.int8)
    same[1:-1] = ids[lag:] == ids[:-lag]
    turns = np.flatnonzero(np.diff(same))
    starts, lengths = turns[::2], turns[1::2] - turns[::2] + lag
    long = lengths >= least
    return starts[long], lengths[long]


def _reach(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The ends [a, b) of the stretch around word ``at`` whose words equal those ``lag`` further on."""
    b, step = at, 64
    while b + lag < len(ids):
        same = ids[b:b + step][: len(ids) - lag - b] == ids[b + lag:b + lag + step]
        if not same.all():
            b += int(same.argmin())
            break
        b, step = b + len(same), step * 2
    a, step = at, 64
    while a:
        low = max(0, a - step)
        same = (ids[low:a] == ids[low + lag:a + lag])[::-1]
        if not same.all():
            a -= int(same.argmin())
            break
        a, step = low, step * 2
    return a, b + lag


def find_runs(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """All runs of texts of ``sizes`` words each, one after the other in ``ids``: rows (text, start, length, period).

    In order of text, start and period; ``start`` counts from the text's first word. ``ids`` has, after every text, one more
    number that is nowhere else. A run's period is its smallest, and no neighbouring word extends it.
    """
    if exponent < 3:
        raise ValueError("seeds are certain for runs of three periods or more")
    firsts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    found = []
    for lag in range(1, FIRST_SCALE):
        starts, lengths = _lag_runs(ids, lag, max(least, exponent * lag))
        found.append(np.stack([starts, lengths, np.full(len(starts), lag)], 1))
    scale, part, place = FIRST_SCALE, ids, np.arange(len(ids))
    gram, held = _mixed(ids.astype(np.uint64) * _ODD + _MIX), sizes
    width = 1
    while True:
        long = held >= exponent * scale  # texts too short for this scale have no part in the later ones
        if not long.any():
            break
        if not long.all():
            keep = np.repeat(long, held + 1)
            part, place, gram, held = part[keep], place[keep], gram[keep], held[long]
        while width < 2 * scale:  # grams of twice the width from two neighbours
            further = np.zeros_like(gram)
            further[:-width] = gram[width:]
            gram, width = _mixed(gram * _ODD + further), width * 2
        window = min(scale, (exponent - 3) * scale + 1)
        lows = _window(gram, window, np.minimum)
        # the largest window least over the windows that hold a gram equals its hash if one of them keeps it
        padded = np.concatenate([np.zeros(window - 1, np.uint64), lows, np.zeros(window - 1, np.uint64)])
        spots = np.flatnonzero(_window(padded, window, np.maximum) == gram)
        order = spots[np.argsort(gram[spots], kind="stable")]
        lags = np.diff(order)
        seeds = np.flatnonzero((gram[order[1:]] == gram[order[:-1]]) & (lags >= scale) & (lags < 2 * scale))
        at, lag = order[seeds], lags[seeds]
        done: dict[int, int] = {}
        for i in np.lexsort((at, lag)):
            q, x = int(lag[i]), int(at[i])
            if x < done.get(q, 0):  # within the stretch of the seed before
                continue
            a, b = _reach(part, x, q)
            done[q] = b - q
            if b - a >= max(least, exponent * q):
                found.append(np.array([[place[a], b - a, q]]))
        scale *= 2
    rows = np.concatenate(found).astype(np.int64)
    # a stretch with a period of several times its smallest comes up for both; of the two the smallest holds
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[fresh]
    text = np.searchsorted(firsts, rows[:, 0], "right") - 1
    rows = np.column_stack([text, rows[:, 0] - firsts[text], rows[:, 1:]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _handled(texts: list[list[bytes]], least: int, exponent: int) -> Iterator[tuple]:
    """(words, runs, text without repetitions) of each text, given as its words."""
    numbers = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.empty(int(sizes.sum()) + len(texts), np.int64)
    at = 0
    for i, words in enumerate(texts):
        ids[at:at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        ids[at + len(words)] = -1 - i
        at += len(words) + 1
    rows = find_runs(ids, sizes, least, exponent)
    bounds = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    for i, words in enumerate(texts):
        runs = rows[bounds[i]:bounds[i + 1], 1:].tolist()
        if runs:
            cover = np.zeros(len(words) + 1, np.int64)
            for start, length, period in runs:
                cover[start + period] += 1
                cover[start + length] -= 1
            words = [words[j] for j in np.flatnonzero(np.cumsum(cover)[:-1] == 0)]
        yield int(sizes[i]), [{"start": a, "length": n, "period": q} for a, n, q in runs], b" ".join(words).decode()


def with_runs(docs: DataFrame, text: str = "text", least: int = LEAST, exponent: int = EXPONENT, out: str = "periodic") -> DataFrame:
    """``docs`` with a struct ``out``: n_words, runs (start, length, period in words) and ``collapsed``,
    the words that no run holds after its first period, joined by one space.

    A run is a stretch of at least ``least`` words and ``exponent`` times its smallest period that no
    neighbouring word extends; its period is found whatever its length. Runs are in order of start and period. Words are
    what lies between blanks (space, tab, line ends). A null or empty text has no words, no runs and collapses to the empty
    text; equal rows get equal results; other columns are untouched and one named ``out`` is replaced. Rows do not
    meet, so nothing is shuffled; a task holds ``CHUNK_WORDS`` words at once, or one longer text.
    """
    @F.pandas_udf(SCHEMA)
    def measured(texts: pd.Series) -> pd.DataFrame:
        made, held, size = [], [], 0
        for body in texts:
            words = body.encode().split() if body else []  # bytes split at the same six blanks
            if held and size + len(words) > CHUNK_WORDS:
                made += _handled(held, least, exponent)
                held, size = [], 0
            held.append(words)
            size += len(words)
        made += _handled(held, least, exponent) if held else []
        return pd.DataFrame(made, columns=["n_words", "runs", "collapsed"])

    return docs.withColumn(out, measured(F.col(text)))


def strongest(runs: str) -> F.Column:
    """Of an array of runs the one of the greatest length by period, exactly; the first of equals."""
    better = lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)
    return F.when(F.size(runs) > 0, F.reduce(F.col(runs), F.element_at(F.col(runs), 1), better))


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of the contract: in every tenth, by a hash of its id, a period is repeated to the end.

    A row without an id keeps its text."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g, n = F.floor(h / 10).cast("long"), F.size("_words")
    begin = F.pmod(g, n).cast("int")
    left = n - begin
    period = (1 + F.floor(left / (3 + F.pmod(g, F.lit(8))))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("_words", begin + 1, period), F.ceil(left / period).cast("int")))
    body = F.array_join(F.concat(F.slice("_words", F.lit(1), begin), F.slice(again, F.lit(1), left)), " ")
    words = F.when(F.pmod(h, F.lit(10)) == 0, F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1)))
    return docs.withColumn("_words", words).withColumn(text, F.when(n > 0, body).otherwise(F.col(text))).drop("_words")


def op11_periodic(spark: SparkSession, folder: str) -> DataFrame:
    found = with_runs(planted(table(spark, folder, "documents").select("doc_id", "text")))
    runs = F.col("periodic.runs")
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    digests = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), runs.alias("_runs"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"))
    best = digests.withColumn("_best", strongest("_runs"))
    return best.select(
        "doc_id", "n_runs", "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
