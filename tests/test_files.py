from __future__ import annotations

import contextlib
import io
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vecloom.plans import jobs
from vecloom.params import Params
from vecloom.session import new_path, shared_folder, write_table
from vecloom.sources import line_splits
from vecloom.sources.line_splits import nline_corpus
from vecloom.sources.sinks import merge_part_files, write_shards, write_text
from vecloom.sources.tables import spread
from vecloom.sources.text_files import corpus_lines, numbered_corpus


def text_of(folder) -> str:
    files = sorted(os.path.join(place, f) for place, _, names in os.walk(folder) for f in names if f.startswith("part-"))
    return "".join(open(f, encoding="utf-8").read() for f in files)


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "corpus"
    folder.mkdir()
    lines = {}
    for name, count in (("b.txt", 400), ("a.txt", 700), ("c.txt", 3)):
        lines[name] = [f"{name} line {i} " + "x" * (i % 90) if i % 5 else "" for i in range(count)]
        (folder / name).write_text("\n".join(lines[name]) + "\n", encoding="utf-8")
    return folder, lines["a.txt"] + lines["b.txt"] + lines["c.txt"]


def test_numbers_run_through_files_and_splits(spark, corpus):
    folder, wanted = corpus
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    try:
        numbered = numbered_corpus(spark, str(folder))
        assert [tuple(r) for r in numbered.orderBy("line_no").collect()] == list(enumerate(wanted))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_missing_corpus_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        corpus_lines(spark, str(tmp_path / "none"))


def test_merged_parts_are_the_parts_in_name_order(spark, tmp_path):
    source, target = tmp_path / "source", tmp_path / "target"
    source.mkdir()
    for number, lines in ((2, ["e", "", "f"]), (0, ["z", "a"]), (1, [])):
        (source / f"part-r-0000{number}").write_text("".join(line + "\n" for line in lines))
    (source / "other.txt").write_text("not this\n")
    assert merge_part_files(spark, str(source), str(target))
    assert text_of(target) == "z\na\ne\n\nf\n"
    assert merge_part_files(spark, str(source), str(target))
    assert text_of(target) == "z\na\ne\n\nf\n"


def test_nothing_to_merge(spark, tmp_path):
    assert not merge_part_files(spark, str(tmp_path / "none"), str(tmp_path / "target"))
    (tmp_path / "empty").mkdir()
    assert not merge_part_files(spark, str(tmp_path / "empty"), str(tmp_path / "target"))
    assert not (tmp_path / "target").exists()


def test_text_in_order_over_part_files(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), F.col("id").cast("string").alias("value")).repartition(6)
    write_text(df, str(tmp_path / "out"), ["id"])
    assert text_of(tmp_path / "out") == "".join(f"{i}\n" for i in range(1000))


def test_shards_in_order(spark, tmp_path):
    df = spark.range(900).select((F.col("id") % 3).cast("int").alias("shard"), "id", F.col("id").cast("string").alias("value"))
    write_shards(df.repartition(5), str(tmp_path / "out"), "id")
    for shard in range(3):
        assert text_of(tmp_path / "out" / f"shard={shard}") == "".join(f"{i}\n" for i in range(shard, 900, 3))


def test_tables_go_to_the_shared_folder(spark):
    table = write_table(spark.range(5).repartition(2), "five")
    assert table.count() == 5 and shared_folder(spark).rstrip("/") in table.inputFiles()[0]
    assert new_path(spark, "a") != new_path(spark, "a")


def test_only_a_single_split_is_dealt_over_the_cores(spark, small):
    tasks = 2 * spark.sparkContext.defaultParallelism
    table = spark.read.parquet(f"{small}/documents.parquet")
    assert spread(table, "doc_id").rdd.getNumPartitions() == tasks
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10b")
    held = spark.read.parquet(f"{small}/documents.parquet").cache()  # what the session holds has no say
    try:
        assert spread(held, "doc_id").rdd.getNumPartitions() == held.rdd.getNumPartitions() != tasks
        assert spread(spark.read.parquet(f"{small}/region.parquet", f"{small}/region.parquet"), "r_regionkey").count() == 10
    finally:
        held.unpersist()
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert spread(table, "doc_id").rdd.getNumPartitions() == tasks


def test_all_jobs_from_folder_to_folder(spark, tmp_path, vocabulary):
    (tmp_path / "in").mkdir()
    story = ["the cat sat on the mat", "", "the dog sat on the log", "a cat and a dog"]
    (tmp_path / "in" / "one.txt").write_text("\n".join(story * 3) + "\n")
    (tmp_path / "in" / "two.txt").write_text("the end: it is\tover\n")
    paths = [str(tmp_path / n) for n in ("in", "counts", "lines", "tokens", "stream", "shards", "vectors", "losses", "merged", "out")]
    params = Params(num_shards=2, num_shards_embeddings=3, vocab_size=50256, rounds=1, epochs=1)
    jobs.run(spark, paths, params, vocabulary)
    jobs.word_frequency_job(spark, paths[0], paths[1], vocabulary)  # replaces the first output

    counts = [line.rsplit(" ", 2) for line in text_of(paths[1]).splitlines()]
    assert sum(len(text) * int(n) for text, n, _ in counts) == sum(
        len(w) for line in [*story * 3, "the end: it is\tover"] for w in line.split())
    assert [int(t) for _, _, t in counts] == sorted(int(t) for _, _, t in counts)
    lines = text_of(paths[2] + "/shard=0").splitlines() + text_of(paths[2] + "/shard=1").splitlines()
    assert sorted(int(line.split("\t")[0]) for line in lines) == list(range(13)) and "12\tthe end: it is\tover" in lines
    tokens = [line.split("\t") for line in text_of(paths[3]).splitlines()]
    assert [int(n) for n, _ in tokens] == list(range(13)) and tokens[1] == ["1", ""]
    stream = [t for _, ids in tokens for t in ids.split()]
    for shard in range(3):
        assert text_of(f"{paths[5]}/shard={shard}").split() == stream[shard::3]
    vectors = text_of(paths[6])
    assert {line.split("\t")[0] for line in vectors.splitlines()} == set(stream) and vectors == text_of(paths[8])
    assert [line.split()[0] for line in text_of(paths[7]).splitlines()] == ["0", "1"]
    neighbours = text_of(paths[9]).splitlines()
    assert len(neighbours) == len(set(stream)) and all("\t" in line for line in neighbours)  # a token's text may hold a tab


@pytest.mark.parametrize("arguments", [
    ["unknown", "a", "b"], ["shard-lines", "one"], ["tokenize", "a", "b"], ["shard-lines", "a", "b", "--set", "none=1"],
    ["shard-lines", "a", "b", "--set", "epochs=x"], ["shard-lines", "a", "b", "--set", "round_robin=1"]])
def test_usage(capsys, arguments):
    with pytest.raises(SystemExit) as stop:
        jobs.main(arguments)
    assert stop.value.code == 2 and "usage" in capsys.readouterr().err


def test_one_stage_with_settings(spark, tmp_path, vocabulary):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.txt").write_text("".join(f"line {i}\n" for i in range(20)))
    lines, tokens = str(tmp_path / "lines"), str(tmp_path / "tokens")
    assert jobs.main(["shard-lines", str(tmp_path / "in"), lines, "--set", "num_shards=4"]) == 0
    assert sorted(p for p in os.listdir(lines) if p.startswith("shard=")) == [f"shard={i}" for i in range(4)]
    assert jobs.main(["tokenize", lines, tokens, "--vocabulary", vocabulary.rank_path]) == 0
    assert len(text_of(tokens).splitlines()) == 20
    (tmp_path / "settings").write_text("# shards\nnum_shards = 3\n\nepochs=2 # few\n")
    assert jobs.settings([*jobs.setting_lines(str(tmp_path / "settings")), "epochs=4"]) == Params(num_shards=3, epochs=4)
    assert jobs.settings(["round_robin=true", "learning_rate=0.5", "epochs=3"]) == Params(round_robin=True, learning_rate=0.5, epochs=3)


def test_text_is_neither_sorted_nor_copied_to_number_it(spark, corpus, monkeypatch):
    from vecloom.operators.lines import number_lines
    from vecloom.sources import text_files

    monkeypatch.setattr(text_files, "MOST_BYTES_TO_BROADCAST", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = spark.createDataFrame([(i, "a\nb") for i in range(50)], "doc_id long, text string")
        for numbered in (number_lines(documents), numbered_corpus(spark, str(corpus[0]))):
            with contextlib.redirect_stdout(io.StringIO()) as text:
                numbered.explain()
            outer = text.getvalue().split("Join", 1)[0]  # the join of the lines with their starts stands first
            assert outer.endswith("ShuffledHash") and "Sort " not in outer
        assert [r.line for r in numbered_corpus(spark, str(corpus[0])).orderBy("line_no").collect()] == corpus[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def odd_files(tmp_path):
    """Files with a name to escape, of no line, of one huge line without an end, and with line ends of two characters."""
    wanted = []
    for name, count, end, closed in (("a b.txt", 2500, "\n", True), ("c%é.txt", 0, "", False), ("d.txt", 1, "", False), ("e.txt", 4002, "\r\n", False),
                                     ("f.txt", 3, "\n", True), ("g.txt", 1, "\n", True)):
        lines = ["x" * 3_000_000 if name == "d.txt" else "é" * (i % 50) if i % 7 else "" for i in range(count)]
        (tmp_path / name).write_bytes((end.join(lines) + (end if closed else "")).encode())
        wanted += lines
    return tmp_path, wanted


@pytest.mark.parametrize("size", [1000, 137, 10**7])
def test_each_split_of_lines_is_a_partition(spark, odd_files, size):
    folder, wanted = odd_files
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000b")
    try:
        found = nline_corpus(spark, str(folder), size)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = found.withColumn("p", F.spark_partition_id()).orderBy("split", "place").collect()
    assert [(r.split, r.place, r.line) for r in rows] == [(i // size, i % size, line) for i, line in enumerate(wanted)]
    assert len({(r.split, r.p) for r in rows}) == found.rdd.getNumPartitions() == -(-len(wanted) // size)


def test_more_splits_than_partitions_share_them(spark, odd_files, monkeypatch):
    monkeypatch.setattr(line_splits, "MOST_PARTITIONS", 10)
    folder, wanted = odd_files
    found = nline_corpus(spark, str(folder), 7)
    assert found.rdd.getNumPartitions() <= 10
    assert [(r.split, r.place, r.line) for r in found.orderBy("split", "place").collect()] == [(i // 7, i % 7, line) for i, line in enumerate(wanted)]


def test_no_line_is_no_split(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    found = nline_corpus(spark, str(tmp_path))
    assert found.collect() == [] and found.columns == ["split", "place", "line"]
    with pytest.raises(AnalysisException):
        nline_corpus(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        nline_corpus(spark, str(tmp_path), 0)


def test_reading_n_lines_shuffles_no_text(spark, odd_files):
    found = nline_corpus(spark, str(odd_files[0]), 500)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_file_that_has_shrunk_fails(tmp_path):
    path = tmp_path / "short.txt"
    path.write_bytes(b"one\ntwo\nthree")
    assert list(line_splits.file_lines(f"file://{path}", 4, 0, 2)) == [b"two", b"three"]
    assert list(line_splits.file_lines(f"file://{path}", 0, 2, 1)) == [b"three"]
    with pytest.raises(ValueError, match="fewer lines"):
        list(line_splits.file_lines(f"file://{path}", 4, 1, 2))
