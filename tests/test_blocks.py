"""Joins with tables in blocks against plain joins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vecloom.operators import blocks, sgns
from vecloom.operators.embeddings import lookup_embeddings, lookup_occurrences
from vecloom.operators.negatives import draw_tokens, weighted_tokens
from vecloom.operators.similarity import cosine_pairs


@pytest.fixture()
def vectors(spark):
    rows = [(t, [float(t), 1.0, float(t % 7)]) for t in range(300)] + [(5, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0]), (7000, None)]
    return spark.createDataFrame(rows, "token bigint, embedding array<float>")


@pytest.fixture()
def pairs(spark):
    rows = [(a, (a * 17) % 311, a % 2, 1 + a % 3) for a in range(310)] + [(None, 1, 0, 1), (3, 7000, 1, 1), (5, 5, 1, 2)]
    return spark.createDataFrame(rows, "a int, b int, label int, m long")


def no_shuffle(df):
    return "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def shuffled(spark, make):
    """What ``make`` gives, and whether its rows stay where they lie, without Spark's own broadcasts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = make()
        return sorted(map(str, df.collect())), no_shuffle(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("size,count", [(1 << 20, 1), (10_000, 3), (1000, 0)])
def test_rows_meet_their_vectors_whatever_the_blocks(spark, monkeypatch, vectors, pairs, size, count):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    found = {name: shuffled(spark, make) for name, make in {
        "lookup": lambda: lookup_occurrences(pairs.selectExpr("a AS token", "b", "m"), vectors),
        "gather": lambda: sgns.gather_vectors(pairs, vectors), "cosine": lambda: cosine_pairs(vectors, pairs.select("a", "b"))}.items()}
    assert blocks.block_count(vectors) == count
    assert all(stays == bool(count) for _, stays in found.values())
    v = vectors.select("token", F.col("embedding").cast("array<double>").alias("v"))
    assert found["lookup"][0] == sorted(map(str, lookup_embeddings(pairs.selectExpr("a AS token", "b", "m"), vectors).collect()))
    plain = pairs.join(v.toDF("a", "va"), "a").join(v.toDF("b", "vb"), "b").select(*sgns.gather_vectors(pairs, vectors).columns)
    assert found["gather"][0] == sorted(map(str, plain.collect()))
    assert len(found["cosine"][0]) == plain.where("a <> b").count() > 250


def test_a_draw_does_not_move_its_row(spark):
    weighted = weighted_tokens(spark.createDataFrame([(t, 1 + t) for t in range(50)], "token int, n long"))
    _, stays = shuffled(spark, lambda: draw_tokens(spark.range(100), weighted, "n", F.col("id")))
    assert stays
