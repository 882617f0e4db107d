"""The end-to-end neighbours over the whole vocabulary against plain Python."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np

import __spark_entry__
from vecloom.operators.embeddings import init_embeddings
from vecloom.plans import neighbours as plan
from vecloom.plans import queries


def test_whole_vocabulary_equals_brute_force(spark, tmp_path):
    texts = [(1, "one two three four five six seven eight nine ten"), (2, "two three eleven twelve"), (3, "one one two"), (4, "")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sequences = queries._sequences(spark, str(tmp_path), queries.PARAMS.vocab_size)
    triples = plan.piece_triples(sequences, ["doc_id"], queries.PARAMS).select("c", "o", "n").collect()
    used = sorted({t for triple in triples for t in triple})
    assert max(used) >= 2000  # ids beyond the table embeddings
    start = {r.token: np.array(r.embedding, float) for r in init_embeddings(
        spark.createDataFrame([(t,) for t in used], "token int"), queries.PARAMS.embedding_dim, queries.PARAMS.seed).collect()}
    gradient = defaultdict(lambda: np.zeros(queries.PARAMS.embedding_dim))
    for c, o, n in triples:
        for b, label in ((o, 1), (n, 0)):
            pull = 1 / (1 + math.exp(-start[c] @ start[b])) - label
            gradient[c] = gradient[c] + pull * start[b]
            gradient[b] = gradient[b] + pull * start[c]
    moved = {t: v - queries.PARAMS.learning_rate * gradient[t] for t, v in start.items()}
    found = defaultdict(list)
    for r in sorted(queries.piece_neighbours(spark, str(tmp_path)).collect(), key=lambda r: r["rank"]):
        found[r.token].append((r.neighbour, r.sim))
    assert sorted(found) == used
    for token, own in found.items():
        sims = {t: moved[token] @ v / np.linalg.norm(moved[token]) / np.linalg.norm(v) for t, v in moved.items() if t != token}
        assert np.allclose([s for _, s in own], sorted(sims.values(), reverse=True)[:5], atol=2e-6)
        assert np.allclose([sims[t] for t, _ in own], [s for _, s in own], atol=2e-6)


def test_entry_runs_the_whole_vocabulary(monkeypatch):
    seen = []
    monkeypatch.setattr(plan, "one_step_neighbours", lambda sequences, keys, params: seen.append(params))
    monkeypatch.setattr(queries, "_sequences", lambda *a: None)
    __spark_entry__.entry(None)
    assert seen == [queries.PARAMS]
