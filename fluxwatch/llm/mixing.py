"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import GAP, table

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
SEED = "mix"


def word_count(text: str) -> F.Column:
    """Number of words of a text; null has none. Counts the starts of words."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def rates(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """Target of every source, from one row (source, source_size) per source.

    Sources in code-point order, null last, weigh ``weights`` in turn. They share
    ``share`` times the whole size; a target is at most ``most`` times its source, and what
    lies above goes to the others by weight until none is above. That fixed point is
    ``min(most * size, level * weight)``: with the sources ordered by the level at which they
    are full, the level follows from running sums. Windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    pick = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")
    weighed = sizes.withColumn("_w", pick).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    full = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    rest = total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    left = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    level = weighed.withColumn("_level", rest / left).withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_w"))
    # the first source that is not full sets the level of all behind it
    first = F.min(F.when(~F.col("_full"), F.struct((F.col("_cap") / F.col("_w")).alias("a"), F.col("source").isNull().alias("n"), F.col("source").alias("s"), F.col("_level").alias("level")))).over(whole)
    target = F.least(F.col("_cap"), F.coalesce(first.getField("level") * F.col("_w"), F.col("_cap")))
    return level.select("source", "source_size", target.alias("target"))


def copies(size: str, source_size: str, target: str, key: F.Column, seed: str = SEED) -> F.Column:
    """floor(rate) copies and one more where the key's draw, seeded by the seed, lies below the fraction."""
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    draw = F.conv(digits, 16, 10).cast("bigint").cast("double") / float(1 << 52)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def planned(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS, prefix: str = "") -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``, each name behind ``prefix``; columns
    of these names are replaced.

    Rows are counted twice from the scan: once summed per source with partial sums, once
    joined with the one row per source. No document moves unless the sources outgrow a
    broadcast; the join is then split by Spark where a source is hot. Repeated rows of one
    key get the same draw; an empty table gives an empty result.
    """
    size, whole, target, times = (prefix + name for name in ("size", "source_size", "target", "copies"))
    named = docs.drop(size, whole, target, times).withColumn(size, word_count(text))
    sums = named.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    plan = rates(sums, share, most, weights).select(F.col("source").alias("_source"), F.col("source_size").alias(whole), F.col("target").alias(target))
    joined = named.join(plan, named[source].eqNullSafe(plan["_source"]), "left").drop(plan["_source"])
    return joined.withColumn(times, copies(size, whole, target, F.col(key)))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as the plan says, in the columns of ``docs``."""
    plan = planned(docs, **options, prefix="_mix_")
    again = F.expr("sequence(1L, _mix_copies)")
    return plan.where("_mix_copies > 0").withColumn("_mix_copy", F.explode(again)).select(*docs.columns)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return planned(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w,
    source_size * 2.0::DOUBLE AS cap FROM sums
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sums) * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / ((SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed
), bound AS (
  SELECT level FROM levels WHERE cap > level * w ORDER BY cap / w, source NULLS LAST LIMIT 1
), plan AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM bound) * w, cap)) AS target FROM levels
), rated AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
