"""The corpus pipeline: from raw documents to packed sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) and works on all that its predecessor
kept, written as Parquet and read again. All but the last keep the columns of their input,
whatever these are. The stages are exact except where tokenizers and fingerprints decide, so no
SQL states the whole; the tests run each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.llm import lines, mixing, near, packing, quality
from fluxwatch.llm.common import table
from fluxwatch.llm.tokens import vocabulary
from fluxwatch.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    judged = quality.judged(docs, vocabulary("piece_bpe_32k.model"), out="_quality_rules")
    return judged.where("_quality_rules.kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out; documents of which no word is left go.

    ``n_chars``, where there is such a column, follows a changed text."""
    out = lines.deduplicated(docs, out="_line_dedup")
    left = out.where(~((F.col("_line_dedup.n_removed_words") > 0) & (F.col("_line_dedup.n_removed_words") == F.col("_line_dedup.n_words"))))
    if "n_chars" in docs.columns:
        changed = F.col("_line_dedup.n_removed_lines") > 0
        left = left.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word similarity of 0.8 or more) stays: the one of the smallest id."""
    return near.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources come near their targets."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4,096 tokens."""
    return packing.packed(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
