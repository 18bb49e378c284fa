"""The registered queries on the given tables, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from clickmart.llm import common, exact_dedup, pu_classifier
from clickmart.llm.queries import ORACLES, QUERIES


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(entry.queries()) >= {*QUERIES, "pipeline"} and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(found.columns) == sorted(names)
    assert Counter(map(tuple, found.select(*names).collect())) == Counter(want.fetchall())


def test_quality_of_held_out_documents(spark, sf_dir):
    scored = {r["doc_id"]: r for r in QUERIES["op5_quality_classifier"](spark, sf_dir).collect()}
    labels = [r for r in common.read(spark, sf_dir, "labels").collect() if scored[r["doc_id"]]["held_out"]]
    right = [scored[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    good = [scored[r["doc_id"]]["predicted"] for r in labels if r["quality"] == 1]
    assert len(labels) > 50 and np.mean(right) > 0.95 and np.mean(good) > 0.95


def test_good_held_out_documents_are_kept(spark, sf_dir):
    scored = {r["doc_id"]: r for r in QUERIES["op5_quality_classifier"](spark, sf_dir).collect()}
    labels = [r for r in common.read(spark, sf_dir, "labels").collect() if scored[r["doc_id"]]["held_out"]]
    good = [scored[r["doc_id"]]["predicted"] for r in labels if r["quality"] == 1]
    assert len(good) > 40 and np.mean(good) > 0.98


def test_the_pipeline_works_on_what_each_stage_kept(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "test")
        seen.append(docs)
    good, exact, near, cut, packed = seen
    assert all(d.columns == columns for d in seen[:-1])
    scores = pu_classifier.scores(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
    ids = {r["_id"] for r in scores.filter(scores["score"] >= 0.7).collect()}
    assert {r["doc_id"] for r in good.collect()} == ids
    assert exact.count() == exact_dedup.decisions(good).filter("kept").count() < good.count()
    assert near.count() <= exact.count() and cut.count() == near.count()
    assert cut.filter("n_chars <> length(text)").count() == 0
    before, after = (d.selectExpr("sum(length(text))").first()[0] for d in (near, cut))
    assert after < before
    assert packed.select("doc_id").distinct().count() == cut.count()
    whole = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, whole.select(*key).collect())) == Counter(map(tuple, packed.select(*key).collect()))
