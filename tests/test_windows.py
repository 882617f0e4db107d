from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom.operators import windows as wd


def sliding(tokens: list[int], size: int, step: int) -> list[list[int]]:
    """Windows start every ``step`` until one has reached the end of the list."""
    found, start = [], 0
    while start < len(tokens):
        found.append(tokens[start:start + size])
        if start + max(size, step) >= len(tokens):
            break
        start += step
    return found


def windows(df, keys):
    found = {}
    for row in df.orderBy("win_no").collect():
        found.setdefault(tuple(row[k] for k in keys), []).append((row.win_no, row.window))
    assert all([n for n, _ in ws] == list(range(len(ws))) for ws in found.values())
    return {k: [w for _, w in ws] for k, ws in found.items()}


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(size=st.integers(1, 9), step=st.integers(1, 11))
def test_windows_of_every_length(spark, size, step):
    lists = [(n, list(range(100, 100 + n))) for n in range(30)]
    df = spark.createDataFrame(lists, "k int, tokens array<int>").coalesce(1)
    found = windows(wd.token_windows(df, ["k"], size, step), ["k"])
    assert found == {(n,): sliding(t, size, step) for n, t in lists if n}


@pytest.mark.parametrize("size,step", [(8, 4), (3, 1), (2, 5), (4, 4), (1, 3)])
def test_streams_have_the_windows_of_lists(spark, monkeypatch, size, step):
    monkeypatch.setattr(wd, "WINDOWS_PER_STRETCH", 3)
    lists = [(n, list(range(n))) for n in (1, 2, 7, 8, 9, 23, 24, 25, 40, 61)]
    df = spark.createDataFrame(lists, "shard int, tokens array<int>")
    stream = df.select("shard", F.posexplode("tokens").alias("shard_pos", "token")).repartition(5)
    found = windows(wd.stream_windows(stream, size, step), ["shard"])
    assert found == {(n,): sliding(t, size, step) for n, t in lists}


def test_bad_sizes(spark):
    df = spark.createDataFrame([(1, [1])], "k int, tokens array<int>")
    for size, step in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            wd.token_windows(df, ["k"], size, step)


def test_pairs_are_neighbours_and_short_windows_have_none(spark):
    df = spark.createDataFrame([(0, [5, 6, 7]), (1, [9]), (2, [])], "win_no bigint, window array<int>")
    found = wd.skipgram_pairs(df, ["win_no"])
    assert sorted(map(tuple, found.collect())) == [(0, 0, 5, 6), (0, 1, 6, 7)]


def test_negatives_are_repeatable_and_even(spark):
    pairs = spark.range(20000).select(F.col("id").alias("pair_no"))
    once, again = (wd.negative_samples(pairs.repartition(n), ["pair_no"], 50, 1) for n in (2, 5))
    assert once.join(again.withColumnRenamed("n", "m"), "pair_no").where("n <> m").count() == 0
    counts = [r["count"] for r in once.groupBy("n").count().collect()]
    assert len(counts) == 50 and min(counts) > 300 and max(counts) < 500
    assert once.join(wd.negative_samples(pairs, ["pair_no"], 50, 2).withColumnRenamed("n", "m"), "pair_no").where("n = m").count() < 800


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_streams_keep_any_token_and_move_little(spark, monkeypatch, kind):
    monkeypatch.setattr(wd, "WINDOWS_PER_STRETCH", 3)
    tokens = [0, -1, 2**31 - 1, -(2**31), 5, 5, 7, -9] * 9
    rows = [(s, at, t) for s in (0, 1) for at, t in enumerate(tokens)]
    stream = spark.createDataFrame(rows, f"shard int, shard_pos bigint, token {kind}").repartition(5)
    found = wd.stream_windows(stream, 5, 2)
    assert {(r.shard, r.win_no): r.window for r in found.collect()} == {(s, w): tokens[2 * w:2 * w + 5] for s in (0, 1) for w in range(35)}
    assert found.schema["window"].dataType.elementType.simpleString() == kind
    assert ("struct" in found._jdf.queryExecution().optimizedPlan().toString()) == (kind == "bigint")
