"""Registered queries against their oracles, and the pipeline's stages on small tables."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import differences, oracle_rows
from fluxwatch.llm.queries import ORACLES, QUERIES
from fluxwatch.session import written

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    found = QUERIES[name](spark, FOLDER)
    names, rows, _ = oracle_rows(ORACLES[name], FOLDER)
    assert differences(found.columns, [tuple(r) for r in found.collect()], names, rows) is None


@needs_tables
@pytest.mark.parametrize("name", ["op1_sharding", "op7_line_dedup", "op9_mixing"])
def test_native_plans_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


VOCABULARY = """about after again animal answer around because before between bridge brother carry children city
clear close country course cross different during early earth enough every example family father field figure final
follow forest friend garden general gold great green ground group happen heavy history horse hour house hundred idea
inside island kind king knowledge land language large laugh letter light listen little machine measure middle minute
money morning mother mountain music nation near never night north notice number object ocean often order other paper
pattern people perhaps picture place plain plant point power present problem produce question quick rain reason record
river road rock round school science season second sentence ship short silver simple slow small sound south special
spring stand star stone story street strong summer surface system table teach thousand through together toward travel
tree under until valley village voice warm watch water weather west wheel white whole winter wonder world write yellow
young""".split()


def prose(i: int, n: int = 60) -> str:
    return " ".join(np.random.default_rng(i).choice(VOCABULARY, n))


@pytest.fixture(scope="module")
def corpus(spark):
    shared = "shared " + prose(900)
    rows = [(i, prose(i), "en", f"s{i % 3}", 0) for i in range(30)]
    rows += [(100 + i, f"{prose(200 + i)}\n{shared}", "en", "s0", 0) for i in range(5)]
    rows += [(200, prose(3), "en", "s1", 0), (201, prose(3) + " end", "en", "s1", 0), (300, "too short", "en", "s0", 0), (301, None, None, None, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    return frame.withColumn("n_chars", F.length("text")).withColumns({"size": F.lit("x"), "quality": F.lit(1), "shard": F.lit(2)})


def test_stages(spark, corpus):
    docs, seen = corpus, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == corpus.columns
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "mixing", "packing"]
    assert set(seen["quality rules"]) == {r["doc_id"] for r in corpus.collect()} - {300, 301}
    after = seen["line dedup"]
    assert "shared" in after[100]["text"] and all("shared" not in after[100 + i]["text"] for i in range(1, 5))
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    near = seen["SimHash near-dedup"]
    assert 3 in near and 200 not in near and 201 not in near
    assert set(range(30)) <= set(near)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.where("start = 0").count() == docs.count()


def test_stages_on_nothing(spark, corpus):
    docs = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "stage")
    assert docs.count() == 0


def test_line_dedup_keeps_what_is_not_a_copy(spark):
    shared, own = "shared " + prose(900, 200), prose(901, 50)
    rows = [(1, shared), (2, f"{shared}\n{own}"), (3, shared), (4, f"{shared}\n \n")]
    found = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER).collect()
    assert {r["doc_id"]: r["text"] for r in found} == {1: shared, 2: own}
