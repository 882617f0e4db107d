"""The registered queries of the subpackage, and the pipeline stage by stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from __spark_entry__ import queries
from check_queries import database, difference
from vecloom.llm.byte_bpe import digests, multilingual
from vecloom.llm.decontaminate import benchmark_hits, contaminated
from vecloom.llm.line_dedup import dedup_lines
from vecloom.llm.ngram_join import near_duplicates
from vecloom.llm.quality import quality_measures
from vecloom.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, small, name):
    found = QUERIES[name](spark, small).toPandas()
    assert len(found) and difference(found, database(small).execute(ORACLE[name]).df()) is None


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert queries()["pipeline"] is corpus_pipeline.run


def test_pipeline_keeps_what_each_operator_says(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    columns, stages = docs.columns, [stage for _, stage in corpus_pipeline.STAGES]
    good = stages[0](spark, docs, small).cache()
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality_measures(docs).where("kept").collect()} and good.columns == columns
    lines = stages[1](spark, good, small).cache()
    assert {(r.doc_id, r.text) for r in lines.collect()} == {(r.doc_id, r.text) for r in dedup_lines(good).collect()} and lines.columns == columns
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    single = stages[2](spark, lines, small).cache()
    found = near_duplicates(lines).collect()
    assert {r.doc_id for r in single.collect()} == {r.class_id for r in found} and single.columns == columns
    clean = stages[3](spark, single, small).cache()
    hits = benchmark_hits(single, spark.read.parquet(f"{small}/benchmark.parquet")).where(~contaminated())
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in hits.collect()} and clean.columns == columns
    wanted = sorted(map(tuple, digests(clean, multilingual()).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == wanted and len(wanted) > 50
