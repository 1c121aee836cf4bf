"""Benchmark decontamination by winnowing: which words of a document lie in a passage of a benchmark item.

Both sides hash every run of ``GRAM`` words and keep the least hash of each window of runs, so a shared span
of a window's words always keeps a common fingerprint. Fingerprints are joined first; only where
they meet, the span is extended to the words of the whole window and compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwatch.llm.common import free, table
from fluxwatch.session import written

#: Words of a window, and of the runs whose hashes are winnowed inside it.
SPAN, GRAM = 10, 5
#: Up to this many distinct windows (about 100 bytes each) a benchmark is sent to every task; a larger one is shuffled.
SENT = 100_000
#: Parts a frequent window is split into when windows are shuffled.
SALT = 16
#: What lies between words; words are digits, letters and anything beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

KEY = ["_d", "_h"]


def _words(text: str) -> Column:
    """The words of a text, A-Z as a-z and other letters as they are."""
    plain = F.octet_length(F.col(text)) == F.char_length(F.col(text))
    lowered = F.when(plain, F.lower(F.col(text))).otherwise(F.translate(F.col(text), UPPER, LOWER))
    return F.array_remove(F.split(lowered, BETWEEN, -1), "")


def _count(text: str) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(F.col(text), BETWEEN, -1), "")), F.lit(0)).cast("long")


def _windows(rows: DataFrame, words: str, length: int, out: str) -> DataFrame:
    """Adds ``out``: for each window of ``length`` words the least hash of its runs of words, in order; null where none fits."""
    gram = min(GRAM, length)
    many = length - gram + 1
    # elements are named one by one: a slice would copy them for every position
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - gram), lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(gram)])
    )
    held = rows.withColumn("_grams", F.when(F.size(words) >= length, hashes))
    if many == 1:
        return held.withColumnRenamed("_grams", out)
    least = F.transform(
        F.sequence(F.lit(0), F.size("_grams") - many), lambda i: F.least(*[F.get(F.col("_grams"), i + k) for k in range(many)])
    )
    return held.withColumn(out, F.when(F.size("_grams") >= many, least)).drop("_grams")


def _spans(rows: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    """One row per window: its first word ``at`` (from 0), its ``length`` and fingerprint ``mark``, beside the columns of ``rows``."""
    plain = rows.columns
    for length in lengths:
        rows = _windows(rows, words, length, f"_marks{length}")
    each = F.array(*[F.struct(F.lit(n).alias("length"), F.col(f"_marks{n}").alias("marks")) for n in lengths])
    opened = rows.select(*plain, F.explode(each).alias("_each")).select(*plain, F.col("_each.length").alias("length"), F.col("_each.marks").alias("_marks"))
    return opened.select(*plain, "length", F.posexplode("_marks").alias("at", "mark"))


def _span_text(words: str) -> Column:
    return F.array_join(F.slice(F.col(words), F.col("at") + 1, F.col("length")), " ")


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", span: int = SPAN) -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct windows (span_text, length, mark, item_set), items of each set (item_set, items), and the lengths there are.

    An item of fewer words than ``span``, but not none, is one window. Windows of the same items
    share a set, so that later steps carry a number instead of a list. An item without an id counts under the empty id.
    """
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), _words(text).alias("_words"))
    items = written(items.where(F.size("_words") > 0), "items")
    sizes = items.select(F.least(F.size("_words"), F.lit(span)).alias("n")).distinct()
    lengths = sorted(r["n"] for r in sizes.collect())  # at most ``span`` rows
    parts = [
        _spans(items.where(F.size("_words") == n) if n < span else items.where(F.size("_words") >= n), "_words", [n]).select("item", "length", "mark", _span_text("_words").alias("span_text"))
        for n in lengths
    ]
    if not parts:
        none = items.select("item", F.lit(span).alias("length"), F.lit(0).cast("long").alias("mark"), F.lit("").alias("span_text"))
        parts = [none]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    grouped = rows.groupBy("span_text", "length", "mark").agg(F.sort_array(F.collect_set("item")).alias("items"))
    grouped = written(grouped.withColumn("item_set", F.sha2(F.array_join(F.transform("items", lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)), ","), 256)), "windows")
    return grouped.drop("items"), grouped.select("item_set", "items").dropDuplicates(["item_set"]), lengths


def _identity(docs: DataFrame, doc_id: str, text: str) -> dict[str, Column]:
    """What names a document: its id (any type, as text) and a hash of its text; rows equal in both have equal results."""
    return {"_d": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "_h": F.xxhash64(F.col(text), F.col(doc_id).isNull())}


def hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, sent: int = SENT) -> tuple[DataFrame, DataFrame]:
    """Occurrences of benchmark windows in documents (_d, _h, at, length, item_set), and the items of each set.

    With up to ``sent`` distinct windows nothing but occurrences is shuffled: fingerprints are looked up in the scan. With more, the
    distinct fingerprints of a document are shuffled first, and then the windows of the documents that have a common one.
    """
    windows, sets, lengths = benchmark_windows(benchmark, item_id, item_text, span)
    small = windows.count() <= sent
    sides = docs.select(*[c.alias(n) for n, c in _identity(docs, doc_id, text).items()], _words(text).alias("_words"))
    sides = sides.where(F.size("_words") >= (lengths[0] if lengths else 1))
    marks = windows.select("mark").distinct()
    spans = _spans(sides, "_words", lengths or [span])
    if small:
        met = spans.join(F.broadcast(marks), "mark", "left_semi").withColumn("span_text", _span_text("_words")).drop("_words", "mark")
        found = met.join(F.broadcast(windows.drop("mark")), ["span_text", "length"])
    else:
        slim = spans.select(*KEY, "mark")
        some = slim.distinct().join(marks, "mark", "left_semi").select(*KEY).distinct()
        again = _spans(sides.join(some, KEY, "left_semi"), "_words", lengths)
        named = again.select(*KEY, "at", "length", _span_text("_words").alias("span_text"), F.pmod(F.xxhash64(*KEY), F.lit(SALT)).alias("_salt"))
        salted = windows.drop("mark").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
        found = named.join(salted, ["span_text", "length", "_salt"])
    # rows equal in id and text say the same: each task hands on one of them
    return found.select(*KEY, "at", "length", "item_set").distinct(), sets


def marked(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, out: str = "contamination", sent: int = SENT) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, spans (first word and the word after the last of each stretch of hit words), items.

    A word is hit if a window of ``span`` consecutive words of an item (the whole item, if it is shorter)
    occurs around it. Words are runs of digits, letters (A-Z as a-z) and anything beyond ASCII. Null and empty texts have
    no words; an empty benchmark hits nothing; equal rows get equal results; items are in order of their id as text. Other columns
    are untouched, whatever their names, and one named ``out`` is replaced.
    """
    found, sets = hits(docs, benchmark, doc_id, text, item_id, item_text, span, sent)
    # a document's occurrences in order: a stretch of hit words ends where the next begins beyond it
    order = Window.partitionBy(*KEY).orderBy("at", "length")
    reach = F.max(F.col("at") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    chained = found.withColumn("_new", F.coalesce((F.col("at") > reach).cast("int"), F.lit(1)))
    chained = chained.withColumn("_stretch", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = chained.groupBy(*KEY, "_stretch").agg(F.min("at").cast("long").alias("first"), F.max(F.col("at") + F.col("length")).cast("long").alias("end"), F.collect_set("item_set").alias("_sets"))
    per_doc = stretches.groupBy(*KEY).agg(
        F.sum(F.col("end") - F.col("first")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("_sets")))).alias("_sets"),
    )
    per_doc = written(per_doc.withColumn("_class", F.sha2(F.array_join("_sets", ","), 256)), "hit-documents")
    # documents of the same sets of items, such as copies of a passage, have their items listed once
    classes = per_doc.groupBy("_class").agg(F.first("_sets").alias("_sets"))
    listed = classes.select("_class", F.explode("_sets").alias("item_set")).join(sets, "item_set").select("_class", F.explode("items").alias("item"))
    listed = listed.groupBy("_class").agg(F.sort_array(F.collect_set("item")).alias("items"))
    d, h, n, hit, rd, rh = (free(name, docs.columns) for name in (*KEY, "_n", "_hit", "_rd", "_rh"))
    results = per_doc.join(listed, "_class").select(F.col("_d").alias(rd), F.col("_h").alias(rh), F.struct("n_hit", "spans", "items").alias(hit))
    names = _identity(docs, doc_id, text)
    keyed = docs.withColumns({d: names["_d"], h: names["_h"], n: _count(text)})
    joined = keyed.join(results, (F.col(d) == F.col(rd)) & (F.col(h) == F.col(rh)), "left")
    summary = F.struct(
        F.col(n).alias("n_words"),
        F.coalesce(F.col(hit)["n_hit"], F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.col(hit)["spans"], F.array().cast("array<struct<first: long, end: long>>")).alias("spans"),
        F.coalesce(F.col(hit)["items"], F.array().cast("array<string>")).alias("items"),
    )
    return joined.withColumn(out, summary).drop(d, h, n, hit, rd, rh)


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = marked(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    c = F.col("contamination")
    return found.select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"),
    )


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(greatest(len(w), 10) - 9), lambda i: array_to_string(w[i + 1:i + 10], ' '))) AS gram FROM items WHERE len(w) > 0
), docs AS (
  SELECT DISTINCT doc_id, w FROM words WHERE len(w) > 0
), spans AS (
  SELECT doc_id, n, unnest(range(len(w) - n + 1)) AS pos, unnest(list_transform(range(len(w) - n + 1), lambda i: array_to_string(w[i + 1:i + n], ' '))) AS gram
  FROM docs JOIN (SELECT DISTINCT n FROM grams) ON len(w) >= n
), hits AS (
  SELECT doc_id, item, pos, s.n FROM spans s JOIN grams g ON s.gram = g.gram AND s.n = g.n
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS place FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""
