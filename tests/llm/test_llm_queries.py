"""Queries against their SQL, learned ones on held-out rows, and the pipeline stage by stage."""

import pytest
from compare import DATA, checking_engine, differences

import corpus_pipeline
from townform.llm import exact_dedup, ngram_jaccard
from townform.llm.queries import ORACLES, QUERIES
from townform.llm.tables import read


@pytest.fixture(scope="module")
def engine():
    return checking_engine("sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_check(spark, engine, name):
    assert differences(spark, engine, QUERIES[name], ORACLES[name], "sf0.001") == ""


def test_language_held_out(spark):
    out = QUERIES["op6_language_id"](spark, str(DATA / "sf0.01")).where("held_out")
    both = out.join(read(spark, str(DATA / "sf0.01"), "documents").select("doc_id", "lang"), "doc_id").where("lang is not null")
    assert both.where("lang_pred = lang").count() >= 0.97 * both.count()


def test_toxicity_held_out(spark):
    out = QUERIES["op3_toxicity"](spark, str(DATA / "sf0.1")).where("held_out")
    rows = out.join(read(spark, str(DATA / "sf0.1"), "labels"), "doc_id").select("toxic", "predicted").collect()
    assert sum(r.toxic == r.predicted for r in rows) >= 0.96 * len(rows)


def test_pipeline_stages(spark):
    sf_dir = str(DATA / "sf0.001")
    docs = read(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert out.exceptAll(docs).count() == 0
        docs = out.checkpoint()
        if name == "exact dedup":
            assert exact_dedup.exact_groups(docs).where("group_size > 1").count() == 0
        if name == "n-gram Jaccard join":
            assert ngram_jaccard.linked_groups(docs, 5, 80, 100).where("doc_id <> component_id").count() == 0
    assert docs.count() > 0 and docs.where("copies < 1 or copies > 2").count() == 0
