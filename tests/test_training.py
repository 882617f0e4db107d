from __future__ import annotations

from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from vecloom.operators import sgns, training
from vecloom.operators import tokens as tk
from vecloom.operators import windows as wd
from vecloom.operators.embeddings import init_embeddings
from vecloom.operators.training import (
    PROBE_ROW, learning_rate, needed_tokens, numbered_triples, pulled_vectors, shard_triples, train_embeddings, train_load, train_shard, training_segments)
from vecloom.params import Params
from vecloom.session import Rotation, write_bucketed


def loss_of(vectors: dict[int, np.ndarray], triples) -> float:
    def part(x):
        return float(np.log1p(np.exp(-x)))

    return sum(part(vectors[c] @ vectors[o]) + part(-(vectors[c] @ vectors[n])) for c, o, n in triples)


@pytest.fixture(scope="module")
def problem(spark):
    rng = np.random.default_rng(5)
    triples = [tuple(int(x) for x in rng.integers(0, 6, 3)) for _ in range(80)] + [(0, 0, 0), (1, 1, 2)]
    vectors = {t: rng.normal(size=3) for t in range(7)}
    return (triples, vectors, sgns.labelled_pairs(spark.createDataFrame(triples, "c int, o int, n int")),
            spark.createDataFrame([(t, v.tolist()) for t, v in vectors.items()], "token int, embedding array<double>"))


def test_loss_is_the_mean_over_triples(problem):
    triples, vectors, pairs, table = problem
    row = sgns.sgns_loss(pairs, table).first()
    assert row.pairs == len(triples) and row.loss == pytest.approx(loss_of(vectors, triples) / len(triples))


def test_loss_of_vectors_of_known_width_needs_no_arrays(problem):
    triples, vectors, pairs, table = problem
    found = sgns.sgns_loss(pairs, table, 3)
    assert "zip_with" not in found._jdf.queryExecution().executedPlan().toString()
    row = found.first()
    assert row.pairs == len(triples) and row.loss == pytest.approx(loss_of(vectors, triples) / len(triples))


def test_gradient_is_the_slope_of_the_loss(problem):
    triples, vectors, pairs, table = problem
    found = {r.token: r.gradient for r in sgns.sgns_gradient(pairs, table, 3).collect()}
    assert set(found) == {t for triple in triples for t in triple}
    for token, gradient in found.items():
        for at in range(3):
            ends = []
            for move in (1e-5, -1e-5):
                moved = {t: v.copy() for t, v in vectors.items()}
                moved[token][at] += move
                ends.append(loss_of(moved, triples))
            assert gradient[at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-4)


def test_step_moves_down_and_leaves_others(problem):
    triples, vectors, pairs, table = problem
    moved = sgns.sgns_step(table, sgns.sgns_gradient(pairs, table, 3), 0.01)
    after = {r.token: np.array(r.embedding) for r in moved.collect()}
    assert set(after) == set(vectors) and after[6].tolist() == vectors[6].tolist()
    assert loss_of(after, triples) < loss_of(vectors, triples)


PARAMS = Params(vocab_size=40, epochs=2, rounds=4, windows_per_shard=20, batch_pairs=32, learning_rate=0.1)


@pytest.fixture(scope="module")
def sequences(spark):
    rng = np.random.default_rng(6)
    lists = [(i, [int(x) for x in 10 * (i % 4) + rng.integers(0, 10, int(rng.integers(0, 60)))]) for i in range(60)]
    return spark.createDataFrame([*lists, (99, [39])], "line_no bigint, tokens array<int>")


@pytest.mark.parametrize("round_robin", [False, True])
def test_training_lowers_the_loss_and_repeats_itself(spark, sequences, round_robin):
    params = replace(PARAMS, round_robin=round_robin, num_shards_embeddings=3)
    first = train_embeddings(sequences, ["line_no"], params)
    assert len(first.losses) == 5 and first.losses[-1] < first.losses[0] and first.best == first.losses.index(min(first.losses))
    again = train_embeddings(sequences.repartition(5), ["line_no"], params)
    one, two = ({r.token: r.embedding for r in t.embeddings.collect()} for t in (first, again))
    assert set(one) == {t for r in sequences.collect() for t in r.tokens}
    for token in one:
        assert one[token] == pytest.approx(two[token], abs=1e-5)


@pytest.mark.parametrize("size,step", [(8, 4), (3, 1), (2, 5)])
@pytest.mark.parametrize("round_robin", [False, True])
def test_segments_hold_the_pairs_of_the_windows(spark, sequences, monkeypatch, size, step, round_robin):
    monkeypatch.setattr(wd, "WINDOWS_PER_STRETCH", 4)
    params = replace(PARAMS, window_size=size, stride=step, round_robin=round_robin, num_shards_embeddings=3)
    segments = training_segments(sequences, ["line_no"], params).toArrow()
    shards = np.unique(segments["shard"].to_numpy())
    assert len(shards) > 3
    found = Counter()
    for shard in shards:
        mine = segments.filter(pc.equal(segments["shard"], int(shard)))
        assert pc.sum(mine["n_windows"]).as_py() <= params.windows_per_shard + 4 * round_robin
        pool = np.arange(100, 107)
        c, o, n = shard_triples(mine, pool, params)
        assert len(n) == len(c) and np.isin(n, pool).all()
        found.update(zip(c.tolist(), o.tolist()))
    if round_robin:
        windows = wd.stream_windows(tk.shard_tokens(tk.token_stream(sequences, ["line_no"]), 3), size, step)
    else:
        windows = wd.token_windows(sequences, ["line_no"], size, step)
    assert found == Counter((r.c, r.o) for r in wd.skipgram_pairs(windows, ["win_no"]).collect())


def test_a_token_without_pairs_keeps_its_start_vector(spark):
    lone = spark.createDataFrame([(1, [3]), (2, [])], "line_no bigint, tokens array<int>")
    result = train_embeddings(lone, ["line_no"], PARAMS)
    start = init_embeddings(spark.createDataFrame([(3,)], "token int"), PARAMS.embedding_dim, PARAMS.seed).first()
    assert result.losses == [] and [r.token for r in result.embeddings.collect()] == [3]
    assert result.embeddings.first().embedding == pytest.approx(start.embedding, abs=1e-6)


def vectors_of(table) -> dict:
    return {r.token: r.embedding for r in table.collect()}


def start_of(spark, table) -> dict:
    return vectors_of(init_embeddings(table.select("token"), PARAMS.embedding_dim, PARAMS.seed))


def test_equal_losses_use_up_patience(spark, sequences):
    result = train_embeddings(sequences, ["line_no"], replace(PARAMS, learning_rate=0.0, rounds=6, patience=2))
    assert len(result.losses) == 3 and result.stopped and result.best == 0
    assert [tuple(r) for r in result.history(spark).select("round", "stopped").orderBy("round").collect()] == [(0, False), (1, False), (2, True)]


@pytest.mark.parametrize("patience", [2, 10])
def test_the_best_table_comes_back_when_losses_rise(spark, sequences, patience):
    result = train_embeddings(sequences, ["line_no"], replace(PARAMS, learning_rate=-0.5, rounds=3, patience=patience))
    assert result.best == 0 and result.losses == sorted(result.losses) and result.stopped == (patience == 2)
    found, start = vectors_of(result.embeddings), start_of(spark, result.embeddings)
    assert all(found[t] == pytest.approx(start[t], abs=1e-12) for t in found)


def test_the_last_table_is_judged_too(spark, sequences):
    result = train_embeddings(sequences, ["line_no"], replace(PARAMS, rounds=1))
    assert len(result.losses) == 2 and result.losses[1] < result.losses[0] and result.best == 1 and not result.stopped


def test_mixed_losses_keep_the_lowest(spark, sequences):
    """A rate that first helps and then overshoots."""
    result = train_embeddings(sequences, ["line_no"], replace(PARAMS, learning_rate=0.2, decay_rate=4.0, decay_steps=12, rounds=4, patience=10))
    best = result.losses.index(min(result.losses))
    assert 0 < best < len(result.losses) - 1 and result.best == best
    shorter = train_embeddings(sequences, ["line_no"], replace(PARAMS, learning_rate=0.2, decay_rate=4.0, decay_steps=12, rounds=best, patience=10))
    found, wanted = vectors_of(result.embeddings), vectors_of(shorter.embeddings)
    assert all(found[t] == pytest.approx(wanted[t], abs=1e-9) for t in wanted)


def test_shards_need_their_own_tokens_and_a_pool(spark, sequences):
    params = replace(PARAMS, negative_pool=4)
    segments = training_segments(sequences, ["line_no"], params)
    needs = needed_tokens(segments, tk.distinct_tokens(sequences), params).collect()
    own, pools = {}, {}
    for r in needs:
        (own if r.place is None else pools).setdefault(r.shard, []).append(r.token)
    held = {}
    for r in segments.collect():
        held.setdefault(r.shard, set()).update(r.tokens)
    assert {s: sorted(t) for s, t in own.items()} == {s: sorted(t) for s, t in held.items()}
    corpus = set().union(*held.values())
    assert all(len(p) == 4 and set(p) <= corpus for p in pools.values()) and set(pools) == set(held)


def test_decay_counts_whole_steps():
    params = Params(learning_rate=1.0, decay_rate=0.5, decay_steps=3)
    assert [learning_rate(params, step) for step in range(7)] == [1, 1, 1, 0.5, 0.5, 0.5, 0.25]


def test_a_rate_of_zero_after_decay_stands_still(spark, sequences):
    still = replace(PARAMS, decay_rate=0.0, decay_steps=1)
    one, two = (vectors_of(train_embeddings(sequences, ["line_no"], replace(still, rounds=r)).embeddings) for r in (1, 2))
    assert all(one[t] == pytest.approx(two[t], abs=1e-12) for t in one)


def shard_of(tokens: list[list[int]], params: Params):
    """One shard's segments and vectors, as the kernel gets them."""
    segments = pa.table({"shard": [0] * len(tokens), "win": list(np.cumsum([0] + [len(t) for t in tokens[:-1]])),
                         "n_windows": [int(max(1, 1 + max(0, -(-(len(t) - max(params.window_size, params.stride)) // params.stride)))) for t in tokens], "tokens": tokens})
    words = sorted({t for own in tokens for t in own})
    draw = np.random.default_rng(0)
    rows = [(None, t, draw.normal(size=4).tolist()) for t in words] + [(i, words[(7 * i) % len(words)], None) for i in range(8)]
    vector = {t: v for _, t, v in rows if v}
    return segments, pa.table({"place": pa.array([p for p, _, _ in rows], pa.int32()), "token": [t for _, t, _ in rows], "embedding": [vector[t] for _, t, _ in rows]})


PROBING = Params(embedding_dim=4, epochs=5, batch_pairs=16, probe_steps=3, hold_out=4, patience=2, learning_rate=0.05)


def probes_of(table) -> list[tuple]:
    return [(r["step"], r["embedding"][0], bool(r["weight"])) for r in table.to_pylist() if r["token"] == PROBE_ROW]


def test_a_shard_probes_as_it_trains_and_gives_back_its_best_table():
    draw = np.random.default_rng(4)
    tokens = [[int(x) for x in draw.integers(0, 9, 40)] for _ in range(6)]
    segments, vectors = shard_of(tokens, PROBING)
    found = train_shard(segments, vectors, PROBING, 0, PROBING.epochs)
    probes = probes_of(found)
    assert [s for s, _, _ in probes] == list(range(0, 3 * len(probes), 3)) and probes[0][2]
    assert [best for _, _, best in probes] == [all(x < y for _, y, _ in probes[:i]) for i, (_, x, _) in enumerate(probes)]
    # the held-back pairs have no say: a model of the same loop
    c, o, n, number = numbered_triples(segments, np.array([sorted({t for own in tokens for t in own})[(7 * i) % 9] for i in range(8)]), PROBING)
    back = number % PROBING.hold_out == 0
    matrix = np.array([vectors["embedding"][t].as_py() for t in range(9)])

    def loss(m):
        return loss_of(dict(enumerate(m)), zip(c[back], o[back], n[back])) / back.sum()

    ct, ot, nt = c[~back], o[~back], n[~back]
    batches, seen, best, left = -(-len(ct) // 16), [loss(matrix)], matrix.copy(), 2
    for at in range(5 * batches):
        i = at % batches * 16
        move = np.zeros_like(matrix)
        for a, b, d in zip(ct[i:i + 16], ot[i:i + 16], nt[i:i + 16]):
            g, h = 1 / (1 + np.exp(-matrix[a] @ matrix[b])) - 1, 1 / (1 + np.exp(-matrix[a] @ matrix[d]))
            move[a] += g * matrix[b] + h * matrix[d]
            move[b] += g * matrix[a]
            move[d] += h * matrix[a]
        matrix = matrix - 0.05 * move
        if (at + 1) % 3 == 0:
            left, best = (2, matrix.copy()) if loss(matrix) < min(seen) else (left - 1, best)
            seen.append(loss(matrix))
            if not left:
                break
    assert [x for _, x, _ in probes] == pytest.approx(seen)
    rows = {r["token"]: r["embedding"] for r in found.to_pylist() if r["token"] >= 0}
    assert all(rows[t] == pytest.approx(best[t]) for t in rows)


def test_a_shard_stops_by_itself_when_its_loss_rises():
    segments, vectors = shard_of([[1, 2, 3, 1, 2, 3, 1, 2, 3, 4] * 5], PROBING)
    worse = replace(PROBING, learning_rate=-0.5, epochs=50)
    found = train_shard(segments, vectors, worse, 0, worse.epochs)
    assert [(s, best) for s, _, best in probes_of(found)] == [(0, True), (3, False), (6, False)]
    start = {t: v for t, v in zip(vectors["token"].to_pylist(), vectors["embedding"].to_pylist())}
    assert all(r["embedding"] == pytest.approx(start[r["token"]]) for r in found.to_pylist() if r["token"] >= 0)


def test_without_pairs_to_hold_back_nothing_is_probed():
    segments, vectors = shard_of([[1, 2, 3, 4]], PROBING)
    for hold_out in (1, 10**6):  # all pairs, which leaves none to train on, or only the first
        found = train_shard(segments, vectors, replace(PROBING, hold_out=hold_out), 0, 2)
        assert len(probes_of(found)) == (hold_out > 1) and any(r["token"] >= 0 for r in found.to_pylist())


def test_probes_are_reported_by_round_and_shard(spark, sequences):
    result = train_embeddings(sequences, ["line_no"], replace(PARAMS, rounds=2, probe_steps=2, hold_out=8))
    rows = result.probes.collect()
    assert {r["round"] for r in rows} == {0, 1} and len({r.shard for r in rows}) > 3 and len(result.losses) == 3
    assert all(r.step % 2 == 0 and r.loss > 0 for r in rows) and train_embeddings(sequences, ["line_no"], replace(PARAMS, rounds=1)).probes is None


@pytest.mark.parametrize("hot", [[], [3, 4]])
def test_a_round_moves_neither_what_is_needed_nor_the_table(spark, hot):
    needs = write_bucketed(spark.range(3000).selectExpr("id % 50 AS shard", "CAST(NULL AS INT) AS place", "id % 997 AS token").repartition(6, "token"), "needs", "token", 6)
    tables = Rotation(spark, "round", "token", 6)
    current = tables.write(spark.range(997).selectExpr("id AS token", "array(CAST(id AS DOUBLE)) AS embedding").repartition(6, "token"))
    current = tables.write(current.selectExpr("token", "transform(embedding, x -> x + 1) AS embedding"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pulled_vectors(needs, current, hot)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastExchange") == bool(hot)
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 3000 and all(r.embedding == [r.token + 1.0] for r in rows)


@pytest.mark.parametrize("width", [3, 4])
@pytest.mark.parametrize("size,step", [(8, 4), (4, 1), (3, 3), (2, 40)])
def test_a_step_scores_a_link_once_for_all_its_windows(size, step, width):
    draw = np.random.default_rng(2)
    text, matrix = draw.integers(0, 9, 200), draw.normal(size=(15, width))
    starts = [s + i for s, e in ((0, 90), (93, 200)) for i in range(0, e - s - size, step)]  # two stretches of text
    at = np.concatenate([np.arange(s, s + size - 1) for s in starts])
    n = draw.integers(3, 15, len(at))
    batch = training._batch(text, at, n, np.zeros(15, np.int64))
    held = np.unique(np.concatenate([at, at + 1]))
    places = len(held) if step == 40 else at.max() + 2 - at.min()
    assert len(batch.rows) - len(batch.links) == places and len(batch.links) == len(at) + places - 1 - len(np.unique(at))
    wanted = matrix.copy()
    for a, b, d in zip(text[at], text[at + 1], n):
        g, h = 1 / (1 + np.exp(-matrix[a] @ matrix[b])) - 1, 1 / (1 + np.exp(-matrix[a] @ matrix[d]))
        wanted[a] -= 0.05 * (g * matrix[b] + h * matrix[d])
        wanted[b] -= 0.05 * g * matrix[a]
        wanted[d] -= 0.05 * h * matrix[a]
    training._descend(matrix, batch, 0.05)
    assert matrix == pytest.approx(wanted)


@pytest.mark.parametrize("epochs", [0, 3])
@pytest.mark.parametrize("probe_steps", [0, 3])
def test_a_load_is_the_mean_of_its_shards(epochs, probe_steps):
    params = replace(PROBING, probe_steps=probe_steps)
    draw = np.random.default_rng(8)
    start = {t: draw.normal(size=4) for t in range(20)}
    rows, parts, singles = [], [], []
    for shard in (3, 9, 4):
        segments, vectors = shard_of([[int(x) for x in draw.integers(shard, shard + 9, 40)] for _ in range(4)], params)
        vectors = vectors.set_column(2, "embedding", [[start[t].tolist() for t in vectors["token"].to_pylist()]])
        segments = segments.set_column(0, "shard", [[shard] * segments.num_rows])
        singles += train_shard(segments, vectors, params, 0, epochs).to_pylist()
        parts.append(segments)
        rows += [(r["place"], r["token"], r["embedding"], shard) for r in vectors.to_pylist() if r["place"] is not None]
    rows += [(None, t, v.tolist(), None) for t, v in start.items()]
    held = pa.table({"place": pa.array([r[0] for r in rows], pa.int32()), "token": [r[1] for r in rows], "embedding": [r[2] for r in rows], "pool_shard": pa.array([r[3] for r in rows], pa.int64())})
    held = held.take(pa.array(draw.permutation(len(rows))))
    found = train_load(pa.concat_tables(parts).take(pa.array(draw.permutation(12))), held, params, 0, epochs).to_pylist()
    wanted = {}
    for r in singles:
        if r["token"] != PROBE_ROW:
            wanted.setdefault(r["token"], []).append((r["weight"], np.array(r["embedding"])))
    assert sorted(r["token"] for r in found if r["token"] != PROBE_ROW) == sorted(wanted)
    for r in found:
        if r["token"] != PROBE_ROW:
            load = wanted[r["token"]]
            assert r["weight"] == sum(w for w, _ in load) and r["embedding"] == pytest.approx(sum(w * v for w, v in load) / r["weight"])
    probes = [[(r["shard"], r["step"], pytest.approx(r["embedding"][0]), r["weight"]) for r in x if r["token"] == PROBE_ROW] for x in (found, singles)]
    assert sorted(probes[0], key=lambda p: p[:2]) == sorted(probes[1], key=lambda p: p[:2])


def test_a_load_gets_a_vector_once(spark, sequences, monkeypatch):
    from vecloom.operators import training

    params, seen = replace(PARAMS, negative_pool=4), []
    plain = training.write_bucketed
    monkeypatch.setattr(training, "write_bucketed", lambda df, name, *more: seen.append((name, plain(df, name, *more))) or seen[-1][1])
    train_embeddings(sequences, ["line_no"], replace(params, rounds=1))
    needs = dict(seen)["needs"].collect()
    own = Counter((r.shard, r.token) for r in needs if r.place is None)
    assert len({s for s, _ in own}) == 1 and set(own.values()) == {1} and len(own) == 40
    assert len({r.pool_shard for r in needs if r.place is not None}) > 10


def test_loads_grow_with_the_corpus_within_bounds(spark, monkeypatch):
    lists = spark.range(100).selectExpr("id AS line_no", "IF(id = 7, NULL, sequence(1, 44)) AS tokens")  # ten windows each
    assert training.load_windows(lists, PARAMS, 5) == training.LOAD_WINDOWS
    monkeypatch.setattr(training, "LOAD_WINDOWS", 10)
    assert training.load_windows(lists, PARAMS, 5) == 990 // 20
    monkeypatch.setattr(training, "MOST_LOAD_WINDOWS", 30)
    assert training.load_windows(lists, PARAMS, 5) == 30


def test_a_probing_round_writes_means_and_no_updates(spark, sequences, monkeypatch):
    """And pools go to their loads without vectors."""
    params, seen, moved = replace(PARAMS, rounds=1, probe_steps=2, hold_out=8, windows_per_shard=5), [], []
    plain, pulled = training.write_table, training.pulled_vectors
    monkeypatch.setattr(training, "write_table", lambda df, name: seen.append((name, plain(df, name))) or seen[-1][1])
    monkeypatch.setattr(training, "pulled_vectors", lambda *parts: moved.append(pulled(*parts)) or moved[-1])
    monkeypatch.setattr(training, "LOAD_WINDOWS", 20)
    found = train_embeddings(sequences, ["line_no"], params)
    written = dict(seen)
    assert "updates" not in written
    means = written["means"].collect()
    assert sorted(r.token for r in means if r.token >= 0) == list(range(40)) and sum(r.token == PROBE_ROW for r in means) == found.probes.count()
    rows = moved[0].collect()
    assert {r.place is None for r in rows} == {True, False} and all((r.embedding is None) == (r.place is not None) for r in rows)
    own = {(r.vector_shard, r.token) for r in rows if r.place is None}
    assert len({load for load, _ in own}) > 5 and {(r.vector_shard, r.token) for r in rows} == own
