"""Weighted negatives against a walk along the cumulative weights."""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vecloom.operators.negatives import draw_tokens, negative_samples_weighted, weighted_tokens


def model(counts: dict[int, int], power: float) -> tuple[list[int], list[int]]:
    tokens = sorted(t for t, n in counts.items() if n and n > 0)
    raised = [math.sqrt(counts[t]) * math.sqrt(math.sqrt(counts[t])) if power == 0.75 else counts[t] ** power for t in tokens]
    ends = []
    for w in raised:
        ends.append((ends[-1] if ends else 0) + max(1, math.floor(w * 1024)))
    return tokens, ends


@pytest.mark.parametrize("power", [0.75, 0.0, 1.0])
def test_draws_follow_the_cumulative_weights(spark, power):
    counts = {t: 1 + (t * 7919) % 50 for t in range(200)} | {500: 1_000_000, 501: 0, 502: None, -3: 4}
    table = spark.createDataFrame(list(counts.items()), "token int, n long").repartition(5)
    weighted = weighted_tokens(table, power)
    tokens, ends = model(counts, power)
    assert weighted.total == ends[-1]
    assert [tuple(r) for r in weighted.spans.orderBy("token").collect()] == list(zip(tokens, [0, *ends[:-1]], ends))
    drawn = draw_tokens(spark.range(4000), weighted, "n", 17, F.col("id")).collect()
    assert len(drawn) == 4000
    for row in drawn:
        draw = int(hashlib.md5(f"17:{row.id}".encode()).hexdigest()[:15], 16) % ends[-1]
        assert row.n == tokens[bisect_right(ends, draw)]


def test_cells_are_few_and_small_beside_a_hot_token(spark):
    table = spark.createDataFrame([(t, 3) for t in range(1000)] + [(5000, 10**9)], "token int, n long")
    weighted = weighted_tokens(table)
    assert weighted.cells.count() <= 1001 and weighted.width * 1001 >= weighted.total
    seen = Counter(r.n for r in draw_tokens(spark.range(2000), weighted, "n", F.col("id")).collect())
    assert seen[5000] > 1900  # as its weight says: 10^(9 * 0.75) against 1000 * 3^0.75


def test_without_tokens_there_is_no_negative(spark):
    pairs = spark.createDataFrame([(1, 2, 3)], "k long, c int, o int")
    none = weighted_tokens(spark.createDataFrame([], "token int, n long"))
    assert [tuple(r) for r in negative_samples_weighted(pairs, ["k"], none, 1).collect()] == [(1, 2, 3, None)]
    assert none.total == 0 and none.cells.count() == 0


def test_repeated_and_null_keys_draw_alike(spark):
    weighted = weighted_tokens(spark.createDataFrame([(t, 1 + t) for t in range(50)], "token int, n long"))
    rows = spark.createDataFrame([(1, None, 7), (1, None, 7), (2, 5, 7)], "k long, c int, o int")
    found = sorted((r.k, r.n) for r in negative_samples_weighted(rows, ["k"], weighted, 1).collect())
    assert len(found) == 3 and found[0] == found[1]
