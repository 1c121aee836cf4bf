"""Line dedup: repeated runs of lines, found by a suffix array over line ids; later copies go.

Documents are sequences of line ids, in order of doc_id. A line that occurs once cannot lie
in a repeat, so the suffix array holds the other positions only, cut into stretches of
neighbouring lines. Prefix doubling sorts their suffixes: a position's rank at depth 2^k is the
place in the suffix array where the interval of its 2^k-line prefix begins, and the ranks of the next
depth order each interval by the ranks 2^k lines further on. Two ranks, one at either end,
name the interval of any length between. An interval with an earlier member is a repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import WORD, drop_folder, table
from fluxwatch.session import written

MIN_WORDS = 50
#: Ranks in one window task: a wider interval is ordered in slices of this many ranks.
SLICE = 1 << 20
LAST = (1 << 63) - 1

STRETCH = ["d", "h", "run"]


def _identity(docs: DataFrame, doc_id: str, text: str) -> tuple[Column, Column]:
    """What names a document: its id (null: the largest long) and a hash of its text."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)), F.xxhash64(F.col(text))


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    d, h = _identity(docs, doc_id, text)
    lines = docs.select(d.alias("d"), h.alias("h"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("at", "line"))
    return lines.select("d", "h", "at", F.xxhash64("line").alias("a"), F.xxhash64("line", F.lit("second")).alias("b"), F.regexp_count("line", F.lit(WORD)).cast("long").alias("words"))


def _ranks(counts: DataFrame, group: list[str], order: list[str], slot: Column, out: str) -> DataFrame:
    """``counts`` (one row a value, with ``n`` members) plus the members of smaller values in
    the group. Values are summed inside slices and slices before one another, so no task
    orders a whole hot group."""
    sliced = counts.withColumn("_slot", slot)
    sums = sliced.groupBy(*group, "_slot").agg(F.sum("n").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*group, "_slot", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = sliced.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return summed.join(starts, [*group, "_slot"]).withColumn(out, F.col("_start") + F.col("_inside")).drop("_slot", "_start", "_inside")


def suffix_ranks(lines: DataFrame, depth_words: int) -> tuple[DataFrame, int]:
    """Positions of repeated lines with ranks ``r0 .. rK`` and the windows each begins and ends.

    ``first`` and ``last`` bound the shortest window of at least ``depth_words`` words that begins
    (``last``) or ends (``first``) at the line, null where the stretch is too short. Doubling stops
    at the longest of these windows: deeper ranks would not be looked at.
    """
    counts = lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    ranked = _ranks(counts.withColumn("_all", F.shiftright("a", 52)), ["_all"], ["a", "b"], F.shiftright("a", 40), "_r")
    blocks = counts.groupBy(F.shiftright("a", 52).alias("_all")).agg(F.sum("n").alias("_n"))
    # 4,096 blocks of the hash space: the one window without a key has a row for each
    blocks = blocks.select("_all", F.coalesce(F.sum("_n").over(Window.orderBy("_all").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    names = ranked.join(F.broadcast(blocks), "_all").select("a", "b", (F.col("_base") + F.col("_r")).alias("r0"))
    # a document that is there twice is one document
    held = lines.join(names, ["a", "b"]).groupBy("d", "h", "at").agg(F.first("r0").alias("r0"), F.first("words").alias("words"))
    row = Window.partitionBy("d", "h").orderBy("at")
    spot = Window.partitionBy(*STRETCH).orderBy("at")
    held = held.withColumn("run", F.col("at") - F.row_number().over(row))
    held = held.withColumn("end", F.sum("words").over(spot.rowsBetween(Window.unboundedPreceding, 0)))
    held = held.withColumn("begin", F.col("end") - F.col("words"))
    whole = Window.partitionBy(*STRETCH)
    held = held.withColumns({"low": F.min("at").over(whole), "high": F.max("at").over(whole), "total": F.sum("words").over(whole)})
    # of equal begins the lowest line, of equal ends the highest: shortest windows may then hold blank lines at one edge only
    behind = F.min("at").over(Window.partitionBy(*STRETCH).orderBy(F.desc("begin")).rangeBetween(Window.unboundedPreceding, -depth_words))
    ahead = F.max("at").over(Window.partitionBy(*STRETCH).orderBy("end").rangeBetween(Window.unboundedPreceding, -depth_words))
    held = held.withColumn("last", F.coalesce(behind - 1, F.when(F.col("total") - F.col("begin") >= depth_words, F.col("high"))))
    held = held.withColumn("first", F.when(F.col("end") >= depth_words, F.coalesce(ahead + 1, F.col("low"))))
    now = written(held.drop("low", "high", "total", "begin", "end", "words"), "suffixes")
    longest = now.agg(F.max(F.greatest(F.col("last") - F.col("at"), F.col("at") - F.col("first"))) + 1).first()[0] or 1
    k = 0
    while (1 << (k + 1)) <= longest:
        rank, step = f"r{k}", 1 << k
        moved = now.withColumn("_next", F.lead(rank, step).over(spot))
        pairs = moved.where(F.col("_next").isNotNull()).groupBy(rank, "_next").agg(F.count("*").alias("n"))
        # suffixes that end before the step sort first in their interval
        short = moved.where(F.col("_next").isNull()).groupBy(rank).agg(F.count("*").alias("n")).select(rank, F.lit(-1).cast("long").alias("_next"), "n")
        ordered = _ranks(pairs.unionByName(short), [rank], ["_next"], F.shiftright("_next", 20), "_r")
        ordered = ordered.select(F.col(rank).alias("_rank"), F.col("_next").alias("_after"), "_r")
        joined = moved.join(ordered, (moved[rank] == ordered["_rank"]) & (F.coalesce(moved["_next"], F.lit(-1)) == ordered["_after"]), "left")
        new = written(joined.withColumn(f"r{k + 1}", F.col(rank) + F.col("_r")).drop("_next", "_rank", "_after", "_r"), "suffixes")
        drop_folder(now)
        now, k = new, k + 1
    return now, k


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Lines to delete: (d, h, at), those in a run of at least ``min_words`` words that an
    earlier place (by doc_id, then line) holds too."""
    now, depth = suffix_ranks(line_table(docs, doc_id, text), min_words)
    windows = now.where("last IS NOT NULL").select(*STRETCH, F.col("at").alias("from"), F.col("last").alias("to"))
    windows = windows.union(now.where("first IS NOT NULL").select(*STRETCH, F.col("first").alias("from"), F.col("at").alias("to"))).distinct()
    size = F.col("to") - F.col("from") + 1
    level = sum(((size >= (1 << j)).cast("int") for j in range(1, depth + 1)), F.lit(0))
    ranks = F.array(*[F.col(f"r{j}") for j in range(depth + 1)])
    windows = windows.withColumns({"size": size, "level": level})
    front = now.select(*STRETCH, F.col("at").alias("from"), ranks.alias("_front"))
    back = now.select(*STRETCH, F.col("at").alias("_back_at"), ranks.alias("_back"))
    named = windows.join(front, [*STRETCH, "from"]).withColumn("_back_at", F.col("to") + 1 - F.expr("cast(power(2, level) as long)"))
    named = named.join(back, [*STRETCH, "_back_at"])
    named = named.select(*STRETCH, "from", "to", "size", F.col("_front")[F.col("level")].alias("x"), F.col("_back")[F.col("level")].alias("y"))
    firsts = named.groupBy("size", "x", "y").agg(F.min(F.struct("d", "h", "from")).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = named.join(firsts, ["size", "x", "y"]).where(F.struct("d", "h", "from") > F.col("_first"))
    # a line is in a copy if a copy begins at or before it and reaches it
    reach = copies.groupBy("d", "h", "from").agg(F.max("to").alias("to"))
    return reach.select("d", "h", F.explode(F.sequence("from", "to")).alias("at")).distinct()


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, out: str = "line_dedup") -> DataFrame:
    """``docs`` without later copies of repeated line runs in ``text``, and a struct ``out``
    (n_lines, n_removed_lines, n_words, n_removed_words).

    A run is repeated if its lines occur in the same order at an earlier place, a place in the
    same document included; the earliest place stays. Lines are what lies between \\n; equal means
    equal byte for byte. Runs below ``min_words`` words stay. A null text stays null, an empty one
    empty; rows equal in id and text count as one document and lose the same lines; a null id
    comes last. Other columns are untouched. Nothing but texts with something to delete is rebuilt.
    """
    d, h = _identity(docs, doc_id, text)
    gone = repeated_lines(docs, doc_id, text, min_words)
    gaps = gone.groupBy("d", "h").agg(F.sort_array(F.collect_list("at")).alias("_gone"))
    gaps = gaps.withColumnRenamed("d", "_d").withColumnRenamed("h", "_h")
    keyed = docs.drop(out).withColumns({"_doc": d, "_hash": h})
    both = keyed.join(gaps, (F.col("_doc") == F.col("_d")) & (F.col("_hash") == F.col("_h")), "left")
    lines = F.split(F.col(text), "\n", -1)
    # what stays are the stretches between deleted lines, so the work is linear in the lines
    marks = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size(lines)))
    kept = F.expr("filter(transform(sequence(1, size(_marks) - 1), i -> struct(_marks[i - 1] + 2 AS at, _marks[i] - _marks[i - 1] - 1 AS n)), s -> s.n > 0)")
    parts = F.transform(F.col("_kept"), lambda s: F.array_join(F.slice(F.col("_lines"), s["at"], s["n"]), "\n"))
    built = both.withColumn("_lines", F.when(F.col("_gone").isNotNull(), lines)).withColumn("_marks", F.when(F.col("_gone").isNotNull(), marks))
    built = built.withColumn("_kept", F.when(F.col("_gone").isNotNull(), kept))
    built = built.withColumn("_new", F.when(F.col("_gone").isNotNull(), F.array_join(parts, "\n")).otherwise(F.col(text)))

    def words(column: str) -> Column:
        return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")

    summary = F.struct(
        F.coalesce(F.length(text) - F.length(F.translate(text, "\n", "")) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed_lines"),
        words(text).alias("n_words"),
        F.when(F.col("_gone").isNotNull(), words(text) - words("_new")).otherwise(F.lit(0)).cast("long").alias("n_removed_words"),
    )
    built = built.withColumn(out, summary).withColumn(text, F.col("_new"))
    return built.select(*[c for c in docs.columns if c != out], out)


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "line_dedup.*", "text")


OP7_SQL = r"""
WITH docs AS (
  SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs
), counted AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines
), summed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS e, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) - words AS b FROM counted
), arrays AS (
  SELECT doc_id, list(md5(line) ORDER BY pos) AS ids FROM lines GROUP BY doc_id
), windows AS (
  SELECT s.doc_id, s.pos AS lo, min(t.pos) AS hi FROM summed s JOIN summed t ON s.doc_id = t.doc_id AND t.pos >= s.pos AND t.e >= s.b + 50 GROUP BY ALL
  UNION
  SELECT s.doc_id, max(t.pos) AS lo, s.pos AS hi FROM summed s JOIN summed t ON s.doc_id = t.doc_id AND t.pos <= s.pos AND t.b <= s.e - 50 GROUP BY s.doc_id, s.pos
), named AS (
  SELECT w.*, md5(array_to_string(list_slice(a.ids, lo + 1, hi + 1), '')) AS name FROM windows w JOIN arrays a USING (doc_id)
), copies AS (
  SELECT doc_id, lo, hi FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id, lo) AS place FROM named) WHERE place > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM copies
), kept AS (
  SELECT c.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed_lines, sum(words) AS n_words,
    coalesce(sum(words) FILTER (g.pos IS NOT NULL), 0) AS n_removed_words,
    coalesce(string_agg(line, chr(10) ORDER BY c.pos) FILTER (g.pos IS NULL), '') AS text
  FROM counted c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.pos = g.pos GROUP BY c.doc_id
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed_lines AS BIGINT) AS n_removed_lines, CAST(n_words AS BIGINT) AS n_words,
  CAST(n_removed_words AS BIGINT) AS n_removed_words, text FROM kept
"""
