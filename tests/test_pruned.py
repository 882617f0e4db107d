"""Pruned neighbours against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from vecloom.operators.pruned import block_bounds, pruned_neighbours
from vecloom.operators.similarity import top_k_similar, unit_rows

SCHEMA = "token int, embedding array<float>"


def clustered(seed: int, rows: int, clusters: int, width: int = 8) -> list[tuple]:
    draw = np.random.default_rng(seed)
    centre = draw.normal(size=(clusters, width))
    return [(t, (centre[t % clusters] + 0.02 * draw.normal(size=width)).astype(np.float32).tolist()) for t in range(rows)]


def same(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = pruned_neighbours(df, **settings)
    rows = sorted(map(str, found.neighbours.collect()))
    assert rows == sorted(map(str, top_k_similar(df, settings.get("k", 5)).collect()))
    assert found.neighbours.schema["token"].dataType.simpleString() == "int"
    return found


def test_most_block_pairs_of_clustered_vectors_are_skipped(spark):
    found = same(spark, clustered(1, 600, 12), pivots=24, block_rows=40)
    assert found.skipped > 0.6 * found.block_pairs > 50


def test_evenly_spread_vectors_are_all_scored_right(spark):
    draw = np.random.default_rng(2)
    found = same(spark, [(t, v.tolist()) for t, v in enumerate(draw.normal(size=(300, 6)))], block_rows=20)
    assert 0 <= found.skipped <= found.block_pairs


def test_vectors_make_few_blocks_whatever_their_number(spark):
    draw = np.random.default_rng(5)
    found = same(spark, [(t, v.tolist()) for t, v in enumerate(draw.normal(size=(8200, 4)))])
    assert found.block_pairs <= 70 * 71 // 2


def test_ties_and_zero_vectors(spark):
    equal = [(t, [1.0, 2.0]) for t in range(100, 200)] + [(t, [2.0, 4.0]) for t in range(50)]
    odd = [(300 + t, [float(t % 3), 1.0]) for t in range(60)] + [(500, [0.0, 0.0]), (7000, [0.0, 0.0]), (-4, [-1.0, -2.0])]
    same(spark, equal + odd, pivots=4, block_rows=16)
    same(spark, equal + odd, pivots=1, block_rows=16, k=3)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 0.0])], [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0])], [(t, [float(t), 1.0]) for t in range(8)]])
def test_few_vectors(spark, rows):
    same(spark, rows)


def test_no_pair_of_two_blocks_passes_their_bound():
    draw = np.random.default_rng(3)
    vectors = unit_rows_of(draw.normal(size=(400, 5)))
    centres = vectors[:10]
    pivot = (vectors @ centres.T).argmax(axis=1)
    angle = np.arccos(np.clip((vectors * centres[pivot]).sum(axis=1), -1, 1)) + 1e-7
    radius = np.array([angle[pivot == p].max() for p in range(10)])
    bound = block_bounds(centres, radius)
    best = np.array([[(vectors[pivot == a] @ vectors[pivot == b].T).max() for b in range(10)] for a in range(10)])
    assert (best <= bound).all()


def unit_rows_of(matrix):
    import pyarrow as pa

    return unit_rows(pa.array(matrix.tolist(), pa.list_(pa.float64())))
