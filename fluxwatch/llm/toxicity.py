"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct lower-cased words and their first four and five letters, so that
inflected forms share a term. They are hashed, the hashes that tell toxic from other texts best
(chi-square over a bounded labelled sample) become features, and a factorization machine learns a
weight for each and the interaction of every pair. Text is the only input of a score.
"""

from __future__ import annotations

from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.llm.common import table
from fluxwatch.session import written

#: Labelled rows the model learns from (the smallest by hash), hash buckets, features kept.
SAMPLE, BUCKETS, FEATURES = 16_000, 1 << 22, 256
FACTORS, ROUNDS, STEP_SIZE, PENALTY, SEED = 4, 80, 0.1, 1e-3, 7
#: Documents of the sample a feature must occur in.
LEAST_DOCUMENTS = 5
FOLDS = 5


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo the folds; fold 0 is held out. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS, F.lit(0))


def hashed_terms(text: str) -> Column:
    """The distinct buckets of a text's terms; null and empty texts have none."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{M}]+"), lambda w: w != ""))
    heads = [F.transform(words, lambda w, n=n: F.pmod(F.xxhash64(F.substring(w, 1, n), F.lit(n)), F.lit(BUCKETS))) for n in (4, 5)]
    whole = F.transform(words, lambda w: F.pmod(F.xxhash64(w, F.lit(0)), F.lit(BUCKETS)))
    return F.array_distinct(F.concat(whole, *heads))


def telling(sample: DataFrame, most: int = FEATURES) -> list[int]:
    """The buckets of the highest chi-square between occurrence and label (ties: the smaller bucket).

    Counts are partial sums; the driver gets ``most`` rows."""
    totals = sample.agg(F.count("*").alias("n"), F.sum("label").alias("p")).first()
    n, p = float(totals["n"] or 0), float(totals["p"] or 0)
    if not 0 < p < n:
        return []
    counts = sample.select("label", F.explode("terms").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("d"), F.sum("label").alias("t"))
    d, t = F.col("d").cast("double"), F.col("t").cast("double")
    chi = F.pow(t * n - d * p, F.lit(2)) * n / (d * (n - d) * p * (n - p))
    ranked = counts.where((d >= LEAST_DOCUMENTS) & (d < n)).withColumn("chi", chi)
    return [r["bucket"] for r in ranked.orderBy(F.desc("chi"), "bucket").limit(most).collect()]


def with_features(df: DataFrame, buckets: list[int]) -> DataFrame:
    """``df`` with the vector of which buckets occur, in place of the terms."""
    known = F.array(*[F.lit(b).cast("long") for b in buckets])
    # one-element array: what occurs is computed once a row, not once a bucket
    found = F.array(F.array_intersect("terms", known))
    flags = F.transform(found, lambda f: F.transform(known, lambda b: F.array_contains(f, b).cast("double")))[0]
    return df.withColumn("features", array_to_vector(flags)).drop("terms")


class Model:
    """Buckets and the machine over them; without usable labels, the share of toxic ones."""

    def __init__(self, buckets: list[int], machine: FMClassificationModel | None, share: float):
        self.buckets, self.machine, self.share = buckets, machine, share

    def scores(self, docs: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
        """``docs`` with a score from 0 to 1; existing columns ``out, terms, features`` are replaced."""
        if self.machine is None:
            return docs.withColumn(out, F.lit(float(self.share)))
        plain = with_features(docs.drop(out, "features").withColumn("terms", hashed_terms(text)), self.buckets)
        scored = self.machine.transform(plain)
        return scored.withColumn(out, vector_to_array("_odds")[1]).drop("features", "_raw", "_odds", "_class")


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "label", sample: int = SAMPLE) -> Model:
    """The model from at most ``sample`` labelled rows; rows with a null label are left out."""
    named = labelled.where(F.col(label).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(label).cast("double").alias("label"))
    chosen = named.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "label").limit(sample)
    rows = written(chosen.select("label", hashed_terms("text").alias("terms")), "labelled")
    share = rows.agg(F.avg("label")).first()[0]
    buckets = telling(rows)
    if not buckets:
        return Model([], None, share or 0.0)
    ready = written(with_features(rows, buckets), "features")
    machine = FMClassifier(
        featuresCol="features", labelCol="label", rawPredictionCol="_raw", probabilityCol="_odds", predictionCol="_class",
        factorSize=FACTORS, maxIter=ROUNDS, stepSize=STEP_SIZE, regParam=PENALTY, solver="adamW", seed=SEED,
    )
    return Model(buckets, machine.fit(ready), share)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # one label a document, whatever the table repeats
    labels = table(spark, folder, "labels").where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = labels.where(fold("doc_id") != 0)
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)  # texts of the sample alone are read into the join
    model = fit(docs.join(ids, "doc_id"))
    scored = model.scores(docs.withColumn("held_out", fold("doc_id") == 0))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
