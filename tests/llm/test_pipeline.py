"""The pipeline and the registered queries on the small tables."""

import os
import sys

import corpus_pipeline
import duckdb
import pytest

from ledgerlake.llm import lang_kn, quality_gbt
from ledgerlake.llm.queries import LANGUAGE_LEARN, ORACLE, QUALITY_LEARN, QUERIES

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_decontaminate import brute as windows_of_all  # noqa: E402
from test_ngram_join import brute as components_of_all  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        ids = [r.doc_id for r in kept.select("doc_id").collect()]
        assert len(ids) == len(set(ids))
        docs = docs.where(docs.doc_id.isin(ids))
        if name == "language":
            assert len(ids) > 0.8 * before
        if name == "near_duplicates":
            assert kept.select("text").distinct().count() == len(ids)
    assert docs.count() > 0.7 * before


def test_each_stage_equals_a_plain_version_of_it(spark):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def kept(name):
        return sorted(r.doc_id for r in stages[name](spark, docs, small).select("doc_id").collect())

    def only(ids):
        return docs.where(docs.doc_id.isin(ids))
    labels = spark.read.parquet(f"{small}/labels.parquet")
    ids = kept("quality")
    assert ids == sorted(r.doc_id for r in quality_gbt.score_quality(docs, labels, QUALITY_LEARN).where("predicted = 1").collect())
    docs = only(ids)
    ids = kept("language")
    assert ids == sorted(r.doc_id for r in lang_kn.identify(docs, LANGUAGE_LEARN).where("accepted").collect())
    docs = only(ids)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ids = kept("near_duplicates")
    assert ids == sorted(i for i, _, c in components_of_all(rows, 5, 80, 100) if i == c)
    docs = only(ids)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    ids = kept("decontamination")
    assert ids == sorted(r[0] for r in windows_of_all([(r.doc_id, r.text) for r in docs.collect()], items) if not r[5])


def test_pipeline_packs_what_the_stages_keep(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.where("piece = 0").count() == got.select("doc_id").distinct().count() > 700


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, map(tuple, got.select(want.columns).collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_run(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
