"""Rejected rows apart from kept ones, and counts that are taken while results are written."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from vecloom.operators import embeddings as emb
from vecloom.operators import lines as ln
from vecloom.operators.accounts import set_apart
from vecloom.plans import jobs
from vecloom.params import Params
from vecloom.sources.sinks import write_parquet, write_rejected, write_shards, write_text


def one():
    return F.count(F.lit(1))


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def reasons(judged):
    found = set_apart(judged)
    assert found.counts["read"] == found.counts["kept"] + found.counts["rejected"] == judged.count()
    assert found.kept.count() == found.counts["kept"] and "value" not in found.kept.columns
    return found.kept, sorted((r.reason, r.value) for r in found.rejected.collect())


def test_numbered_lines(spark):
    rows = values(spark, "1\ta\tb", "2", "x\tc", None, "\t", "99999999999999999999\td", "1\ta\tb")
    kept, out = reasons(ln.judge_numbered_lines(rows))
    assert sorted(map(tuple, kept.collect())) == [(1, "a\tb")] * 2
    assert out == [("no tab", "2"), ("no value", None), ("not a number", "\t"), ("not a number", "99999999999999999999\td"), ("not a number", "x\tc")]
    kept, out = reasons(ln.judge_numbered_lines(values(spark, "1\ta", "2"), strict=True))
    assert kept.count() == 1 and out == [("no tab", "2")]


def test_token_lines(spark):
    rows = values(spark, "1\t5 x 4.5 7", "2\t  ", "q\t1", "3", None, "4\tx")
    found = set_apart(ln.judge_token_lines(rows), {"skipped": F.sum(F.when(F.col("reason").isNull(), F.col("skipped")))})
    assert sorted((r.line_no, r.tokens, r.skipped) for r in found.kept.collect()) == [(1, [5, 7], 2), (4, [], 1)]
    assert found.counts == {"read": 6, "kept": 2, "rejected": 4, "skipped": 3}
    assert sorted((r.reason, r.value) for r in found.rejected.collect()) == [("no tab", "3"), ("no tokens", "2\t  "), ("no value", None), ("not a number", "q\t1")]


def test_vectors_and_embeddings(spark):
    rows = values(spark, "1\t[0.5]", "x\t[1]", "2\t[1,y]", "3", None, " 4\t[1]")
    kept, out = reasons(emb.judge_embeddings(rows))
    assert [tuple(r) for r in kept.collect()] == [(1, [0.5])]
    assert out == [("no value", None), ("not a number", " 4\t[1]"), ("not a number", "x\t[1]"), ("not a vector", "2\t[1,y]"), ("not two fields", "3")]
    kept, out = reasons(emb.judge_embeddings(values(spark, "1\t[0.5]", "3", "1\t[1]\tx", None), strict=True))
    assert kept.count() == 1 and out == [("no value", None), ("not two fields", "1\t[1]\tx"), ("not two fields", "3")]
    keyed = values(spark, "[1,2]", "[x]", None, "").withColumn("k", F.lit(1))
    kept, out = reasons(emb.judge_vectors(keyed, ["k"], "value"))
    assert [tuple(r) for r in kept.collect()] == [(1, [1.0, 2.0])] and out == [("no value", None), ("not a vector", ""), ("not a vector", "[x]")]


def test_nothing_to_read(spark):
    kept, out = reasons(ln.judge_numbered_lines(values(spark).limit(0)))
    assert kept.count() == 0 and out == []


def test_what_sorting_reads_twice_is_counted_once(spark, tmp_path):
    rows = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("shard"), F.col("id").cast("string").alias("value")).repartition(7)
    assert write_text(rows, str(tmp_path / "a"), ["id"], {"n": one(), "total": F.sum("id")}) == {"n": 1000, "total": 499_500}
    assert write_shards(rows, str(tmp_path / "b"), "id", {"n": one()}) == {"n": 1000}
    assert write_parquet(rows, str(tmp_path / "c"), {"n": one()}) == {"n": 1000}
    assert write_text(rows.where("id < 0"), str(tmp_path / "d"), ["id"], {"n": one(), "total": F.sum("id")}) == {"n": 0, "total": 0}
    assert write_text(rows, str(tmp_path / "e")) == {}


def test_jobs_count_and_keep_what_they_reject(spark, tmp_path, vocabulary):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.txt").write_text("the cat\nsat on\n\nthe mat\n")
    at = {n: str(tmp_path / n) for n in ("in", "counts", "lines", "tokens", "stream", "shards", "out")}
    params = Params(num_shards=2, num_shards_embeddings=2)
    counts = jobs.word_frequency_job(spark, at["in"], at["counts"], vocabulary)
    assert counts["tokens"] >= counts["distinct"] >= 5
    assert jobs.shard_lines_job(spark, at["in"], at["lines"], params) == {"lines": 4}
    with open(os.path.join(at["lines"], "shard=0", "part-more.txt"), "w") as file:
        file.write("no number here\n")
    tokenised = jobs.tokenize_job(spark, at["lines"], at["tokens"], vocabulary, str(tmp_path / "bad"))
    assert (tokenised["read"], tokenised["rejected"], tokenised["lines"]) == (5, 1, 4) and tokenised["tokens"] >= 6
    assert [r.value for r in spark.read.text(str(tmp_path / "bad")).collect()] == ["no tab\tno number here"]
    sharded = jobs.shard_tokens_job(spark, at["tokens"], at["stream"], at["shards"], params)
    assert sharded == {"read": 4, "rejected": 1, "skipped": 0, "tokens": tokenised["tokens"]}  # the blank line has no tokens


def test_rejected_rows_stay_on_their_line(spark, tmp_path):
    write_rejected(spark.createDataFrame([("a\r\nb\n\nc", "why"), (None, "none")], "value string, reason string"), str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["none\t", "why\ta b c"]


@pytest.mark.parametrize("stage", ["shard-lines"])
def test_a_stage_prints_its_counts(spark, tmp_path, capsys, stage):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.txt").write_text("a\nb\n")
    assert jobs.main([stage, str(tmp_path / "in"), str(tmp_path / "out"), "--rejected", str(tmp_path / "bad")]) == 0
    assert '{"lines": 2}' in capsys.readouterr().out
