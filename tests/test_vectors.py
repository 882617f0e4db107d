from __future__ import annotations

import contextlib
import io

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vecloom.functions import vector_sums
from vecloom.functions.vector import combine_vectors, cosine, dot, fixed_text, norm, to_double
from vecloom.operators import embeddings as emb


def one(spark, a, b, function):
    row = spark.createDataFrame([(a, b)], "a array<float>, b array<float>")
    return row.select(function(F.col("a"), F.col("b")).alias("x")).first().x


@pytest.mark.parametrize("a,b,wanted", [
    ([1.0, 0.0], [0.0, 1.0], 0.0), ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0], 1.0), ([1.0, 2.0, 3.0], [-1.0, -2.0, -3.0], -1.0)])
def test_cosine(spark, a, b, wanted):
    assert one(spark, a, b, cosine) == pytest.approx(wanted, abs=1e-5)


@pytest.mark.parametrize("a,b", [([], []), ([0.0, 0.0], [1.0, 0.0])])
def test_no_direction_no_cosine(spark, a, b):
    assert one(spark, a, b, cosine) is None


def test_vector_arithmetic(spark):
    assert one(spark, [1.0, 2.0, 3.0], [], lambda a, b: to_double(a)) == [1.0, 2.0, 3.0]
    assert one(spark, [], [], lambda a, b: to_double(a)) == []
    assert one(spark, [1.0, 2.0], [3.0, 4.0], dot) == 11.0
    assert one(spark, [3.0, 4.0], [], lambda a, b: norm(a)) == 5.0


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_strict_embeddings(spark):
    df = values(spark, "1\t[0.5,-1e-3]", "2", "3\t[1.0]\textra", " 4\t2.5 ")
    assert {r.token: r.embedding for r in emb.parse_embeddings(df, strict=True).collect()} == {
        1: [0.5, pytest.approx(-1e-3)], 4: [2.5]}
    with pytest.raises(PySparkException, match="not a float: x"):
        emb.parse_embeddings(values(spark, "1\t[1.0,x]"), strict=True).collect()
    with pytest.raises(PySparkException, match="not a int: q"):
        emb.parse_embeddings(values(spark, "q\t[1.0]"), strict=True).collect()


def test_rows_to_drop_are_not_cast_whatever_the_plan(spark):
    df = values(spark, "1\t[0.5,2]", "user", "x\ty\tz")
    cells = emb.parse_embeddings(df, strict=True).select("token", F.posexplode("embedding"))
    assert sorted(map(tuple, cells.where("col > 1").collect())) == [(1, 1, 2.0)]


def test_lenient_embeddings(spark):
    df = values(spark, "1\t[0.5, 2]", "2 [1]", "x\t[1]", "3\t[1,y]", "4\t[]", "5", "6\t[1,2,]")
    assert {r.token: r.embedding for r in emb.parse_embeddings(df).collect()} == {1: [0.5, 2.0], 2: [1.0], 6: [1.0, 2.0]}


def test_text_round_trip_loses_nothing(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").select(F.col("vec_id").alias("token"), "embedding")
    back = emb.parse_embeddings(emb.format_embeddings(table, digits=None), strict=True)
    assert back.join(table.withColumnRenamed("embedding", "e"), "token").where("embedding = e").count() == table.count()


def test_decimals_are_rounded_as_the_binary_value_has_it(spark):
    draw = np.random.default_rng(9)
    values = [k / 128 for k in range(-300, 300)] + [k / 2e6 for k in range(-41, 41)] + [1e5 + k / 128 for k in range(9)] + draw.normal(size=300).tolist()
    values += [-0.0, 1e-9, -1e-9, 3e7 + 1 / 128, 2.0**40 + 0.25, 0.1 + 0.2, 1e300]
    for digits in (6, 2):
        row = spark.createDataFrame([(values,)], "v array<double>").select(fixed_text(F.col("v"), digits).alias("t")).first()
        assert [x.split(".")[1] for x in row.t[1:-1].split(",")] == [("%.*f" % (digits, x)).split(".")[1] for x in values]
        assert row.t[1:-1].split(",")[:-1] == ["%.*f" % (digits, x) for x in values[:-1]]
    odd = spark.createDataFrame([([None, float("nan"), float("inf"), -float("inf")],)], "v array<double>")
    assert odd.select(fixed_text(F.col("v")).alias("t")).first().t == "[null,NaN,Infinity,-Infinity]"


def test_mean_leaves_unreadable_rows_out_of_the_divisor(spark):
    df = spark.createDataFrame(
        [(1, "[1,3]"), (1, "[3,5]"), (1, "[1,x]"), (2, "[bad]"), (3, "[7,7]")], "token int, value string")
    means = emb.mean_embeddings(emb.parse_vectors(df, ["token"], "value"), 2)
    assert {r.token: r.embedding for r in means.collect()} == {1: [2.0, 4.0], 3: [7.0, 7.0]}


def test_mean_of_unequal_lengths_fails(spark):
    df = spark.createDataFrame([(1, [1.0]), (1, [1.0, 2.0])], "token int, embedding array<float>")
    with pytest.raises(PySparkException, match="another length"):
        emb.mean_embeddings(df, 2).collect()


def test_weighted_mean_with_a_hot_key(spark):
    rows = [(i % 3 and 1, [float(i), 1.0], i) for i in range(3000)]
    df = spark.createDataFrame(rows, "token int, embedding array<float>, w int").repartition(8)
    found = {r.token: r.embedding for r in emb.mean_embeddings(df, 2, weight="w").collect()}
    for key in (0, 1):
        part = [(v[0], w) for k, v, w in rows if k == key]
        assert found[key] == pytest.approx([sum(x * w for x, w in part) / sum(w for _, w in part), 1.0])


def test_last_loaded_vector_stays(spark):
    df = spark.createDataFrame([(1, 0, [1.0]), (1, 2, [3.0]), (1, 1, [2.0]), (2, 5, [9.0])], "token int, at int, embedding array<float>")
    assert sorted(map(tuple, emb.dedupe_embeddings(df, "token", "at").collect())) == [(1, 2, [3.0]), (2, 5, [9.0])]


def test_lookup_per_occurrence_drops_unknown(spark):
    table = spark.createDataFrame([(1, [1.0])], "token int, embedding array<float>")
    stream = spark.createDataFrame([(0, 1), (1, 1), (2, 8)], "pos int, token int")
    assert sorted(map(tuple, emb.lookup_embeddings(stream, table).collect())) == [(1, 0, [1.0]), (1, 1, [1.0])]


def test_lookup_spreads_a_hot_token_over_copies_of_its_vector(spark):
    table = spark.createDataFrame([(t, [float(t)]) for t in range(50)], "token int, embedding array<float>")
    rows = [(i, 7 if i % 3 == 0 else i % 60) for i in range(3000)]
    stream = spark.createDataFrame(rows, "pos int, token int")
    keep = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = emb.hot_tokens(stream)
        assert hot == [7] or (7 in hot and len(hot) <= 60)
        found = emb.lookup_embeddings(stream, table, [7])
        tasks = found.where("token = 7").groupBy(F.spark_partition_id()).count().collect()
        got = sorted(map(tuple, found.select("pos", "token", "embedding").collect()))
    finally:
        for name, value in keep.items():
            spark.conf.set(name, value)
    assert got == [(i, t, [float(t)]) for i, t in rows if t < 50]
    assert len(tasks) > 2 and max(r["count"] for r in tasks) < 700


def test_only_hot_tokens_are_found_and_copied(spark):
    rows = [(i, 7 if i % 3 == 0 else 10_000 + i) for i in range(30_000)] + [(-1, None)] * 50
    stream = spark.createDataFrame(rows, "pos int, token int").repartition(6)
    assert emb.hot_tokens(stream) == [7]
    table = spark.createDataFrame([(t, [1.0]) for t in range(100)], "token int, embedding array<float>")
    seen = []
    frame, plain = type(stream), type(stream).join
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(frame, "join", lambda self, other, on, *rest: (seen.append(other.count()), plain(self, other, on, *rest))[1])
        found = emb.lookup_embeddings(stream, table, [7])
    assert seen == [100 + emb.LOOKUP_SALTS - 1]
    assert found.count() == 10_000 == emb.lookup_embeddings(stream, table).count()
    assert emb.hot_tokens(stream.limit(0)) == []


@pytest.mark.parametrize("how", ["sum", "mean"])
def test_wide_vectors_are_added_up_by_key(spark, monkeypatch, how):
    monkeypatch.setattr(vector_sums, "HELD_BYTES", 20_000)
    monkeypatch.setattr(vector_sums, "ROWS", 16)
    draw = np.random.default_rng(1)
    rows = [(k, s, float(w), v.tolist()) for k, s, w, v in zip(
        [None if x == 9 else int(x) for x in draw.choice([0, 0, 0, 1, 2, 9], 500)], draw.choice(["a", "b"], 500).tolist(), draw.integers(1, 5, 500), draw.normal(size=(500, 100)))]
    df = spark.createDataFrame([*rows, (1, "a", 1.0, None)], "k int, s string, w double, v array<double>").repartition(5)
    for keys in ([], ["s"], ["k", "s"]):
        found = {tuple(r)[:len(keys)]: np.array(r["v"]) for r in combine_vectors(df, keys, "v", 100, how, "w").collect()}
        for key in {tuple(dict(zip("ks", r))[n] for n in keys) for r in rows}:
            own = [r for r in rows if tuple(dict(zip("ks", r))[n] for n in keys) == key]
            total = sum(r[2] * np.array(r[3]) for r in own)
            assert np.allclose(found.pop(key), total / sum(r[2] for r in own) if how == "mean" else total)
        assert not found
    assert combine_vectors(df.limit(0), ["k"], "v", 100).count() == 0
    with pytest.raises(PySparkException, match="another length than 101"):
        combine_vectors(df, ["k"], "v", 101).collect()


def test_the_plan_of_a_wide_mean_does_not_grow(spark):
    def size(width):
        df = spark.range(10).select("id", F.array_repeat(F.col("id").cast("double"), width).alias("v"))
        return len(combine_vectors(df, ["id"], "v", width)._jdf.queryExecution().executedPlan().toString())

    assert abs(size(768) - size(4096)) < 100


def test_start_vectors_depend_on_token_and_seed_only(spark):
    tokens = spark.range(500).select(F.col("id").cast("int").alias("token"))
    first = {r.token: r.embedding for r in emb.init_embeddings(tokens, 4, 1).collect()}
    assert first == {r.token: r.embedding for r in emb.init_embeddings(tokens.repartition(7), 4, 1).collect()}
    other = {r.token: r.embedding for r in emb.init_embeddings(tokens, 4, 2).collect()}
    flat = [x for v in first.values() for x in v]
    assert first != other and all(0 <= x < 1 for x in flat) and math.isclose(sum(flat) / len(flat), 0.5, abs_tol=0.03)


def test_vectors_are_summed_whole(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "token int, embedding array<float>")
    assert "Generate" not in plan_of(emb.mean_embeddings(df, 2))


def test_white_space_around_rows_and_vectors_does_not_count(spark):
    rows = ["2\t[0.5,0.25]\t", "\t3\t[0.5,0.25]", " 4\t [0.5, 0.25] ", "5\t[0.5,0.25]\tx", "6", "7\t[0.5,,]"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    strict = {r.token: r.embedding for r in emb.parse_embeddings(df, strict=True).collect()}
    assert {t: v for t, v in strict.items() if t < 7} == {2: [0.5, 0.25], 3: [0.5, 0.25], 4: [0.5, 0.25]}
    lenient = {r.token for r in emb.parse_embeddings(df).collect()}
    assert 2 in lenient and not lenient & {3, 4, 5, 6}


@pytest.mark.parametrize("setting,value", [("spark.sql.files.maxPartitionBytes", v) for v in ("256m", "128MB")]
                         + [("spark.sql.autoBroadcastJoinThreshold", v) for v in ("10MB", "-1", "1k")])
def test_settings_with_units(spark, small, setting, value):
    from vecloom.plans.queries import corpus_lines, lookup_embeddings

    spark.conf.set(setting, value)
    try:
        assert corpus_lines(spark, small).count() > 100 and lookup_embeddings(spark, small).count() > 1000
    finally:
        spark.conf.unset(setting)


def plan_of(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain()
    return text.getvalue()
