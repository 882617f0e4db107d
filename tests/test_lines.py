from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vecloom.functions.text import whole_part
from vecloom.operators import lines as ln
from vecloom.operators.ordinal import running_offsets, with_ordinal


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_line_ends(spark):
    docs = spark.createDataFrame(
        [(1, "a\nb"), (2, "a\nb\n"), (3, ""), (4, "\n"), (5, "a\r\n\r\nb\rc"), (6, "a\n\n")], "doc_id bigint, text string")
    found = {}
    for doc, pos, line in rows(ln.document_lines(docs), "doc_id", "pos", "line"):
        found.setdefault(doc, []).append(line)
    assert found == {1: ["a", "b"], 2: ["a", "b"], 4: [""], 5: ["a", "", "b", "c"], 6: ["a", ""]}


def test_numbers_follow_documents_and_skip_no_blank_line(spark):
    docs = spark.createDataFrame([(30, "x\n\ny"), (-5, "first"), (7, ""), (9, "p\nq")], "doc_id bigint, text string")
    assert rows(ln.number_lines(docs), "line_no", "line") == [
        (0, "first"), (1, "p"), (2, "q"), (3, "x"), (4, ""), (5, "y")]


def test_offsets_by_composite_key_with_a_hot_first_part(spark):
    keyed = [(1 if i % 3 else 0, i, i % 5) for i in range(4000)]
    df = spark.createDataFrame(keyed, "a int, b int, w int").repartition(7)
    total, wanted = 0, []
    for a, b, w in sorted(keyed):
        wanted.append((a, b, total))
        total += w
    assert rows(running_offsets(df, ["a", "b"], F.col("w")), "a", "b", "offset") == wanted
    assert [r.no for r in with_ordinal(df, ["a", "b"], "no").orderBy("a", "b").collect()] == list(range(4000))


def test_order_and_dealing(spark):
    df = spark.createDataFrame([(i * 7 % 50, f"l{i * 7 % 50}") for i in range(50)], "k int, line string")
    ordered = ln.order_lines(df, ["k"])
    assert [r.line for r in ordered.collect()] == [f"l{i}" for i in range(50)]
    dealt = ln.shard_lines(ordered, 20)
    assert rows(dealt, "shard", "shard_line", "line_no") == sorted((i % 20, i // 20, i) for i in range(50))
    splits = ln.line_splits(ordered, 20).groupBy("split_no").count()
    assert rows(splits, "split_no", "count") == [(0, 20), (1, 20), (2, 10)]


def test_parse_numbered_lines(spark):
    df = values(spark, "5\thello", "6\ta\tb", "7\t", "no tab", "x\ty", "8 z")
    assert rows(ln.parse_numbered_lines(df), "line_no", "line") == [(5, "hello"), (6, "a\tb"), (7, "")]
    with pytest.raises(PySparkException, match="not a bigint: x"):
        ln.parse_numbered_lines(df, strict=True).collect()


def test_parse_token_lines(spark):
    df = values(spark, "1\t5 six 7", "2\t  ", "3\t4.5 99999999999 -3 +2", "4 5 6", "9\tx y")
    found = {r.line_no: r.tokens for r in ln.parse_token_lines(df).collect()}
    assert found == {1: [5, 7], 3: [-3, 2], 9: []}


def test_token_shards_are_strict(spark):
    df = values(spark, " 1 2\t3 ", "4").withColumn("k", F.monotonically_increasing_id())
    assert sorted(r.tokens for r in ln.parse_token_shard(df, ["k"]).collect()) == [[1, 2, 3], [4]]
    with pytest.raises(PySparkException, match="not a int: x"):
        ln.parse_token_shard(values(spark, "1 x"), []).collect()


def test_text_forms(spark):
    counts = spark.createDataFrame([(3, "the", 7)], "token int, text string, n bigint")
    assert ln.format_word_counts(counts).first().value == "the 7 3"
    tokens = spark.createDataFrame([(4, [1, 2]), (5, [])], "line_no bigint, tokens array<int>")
    assert rows(ln.format_token_lines(tokens), "value") == [("4\t1 2",), ("5\t",)]
    lines = spark.createDataFrame([(4, "a b")], "line_no bigint, line string")
    assert ln.format_numbered_lines(lines).first().value == "4\ta b"


def test_concat_keeps_order_and_words_make_no_empty_word(spark):
    df = spark.createDataFrame([(1, "  b a\t c "), (2, "   ")], "k int, line string")
    words = ln.split_words(df, ["k"], "line")
    assert rows(words, "k", "word_no", "word") == [(1, 0, "b"), (1, 1, "a"), (1, 2, "c")]
    assert rows(ln.concat_by_line(words, ["k"], "word_no", "word"), "k", "word") == [(1, "b a c")]


def test_words_stay_with_their_documents(spark, small, capsys):
    from vecloom.plans import queries

    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000b")  # documents of several splits
    try:
        queries.concat_by_line(spark, small).explain()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")


def test_numbered_rows_read_their_documents_once(spark, small, capsys):
    from vecloom.plans import queries

    queries.parse_numbered_lines(spark, small).explain()
    assert capsys.readouterr().out.count("/documents.parquet") == 1


def test_concat_takes_nulls_and_places_that_repeat(spark):
    words = [(1, 0, "a"), (1, 1, None), (1, 1, "c"), (None, 0, "x y"), (1, 0, "b"), (2, 0, None), (1, None, "z")]
    df = spark.createDataFrame(words, "k int, place bigint, word string").repartition(3)
    assert {r.k: r.word for r in ln.concat_by_line(df, ["k"], "place", "word").collect()} == {1: "z a b c", None: "x y", 2: ""}


def test_lines_keep_the_partitions_of_the_session(spark):
    docs = spark.createDataFrame([(n, "a\nb") for n in range(9)], "doc_id bigint, text string")
    assert ln.number_lines(docs).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_lines_are_numbered_once_for_all_forms_of_token_rows(spark, small, capsys):
    from vecloom.plans import queries

    queries.parse_token_lines(spark, small).explain()
    plan = capsys.readouterr().out
    assert plan.count("regexp_extract_all") == 1 and plan.count("/documents.parquet") == 1


def test_piece_vocabulary_ranks_by_count_then_piece(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "text string")
    assert rows(ln.piece_vocabulary(ln.piece_frequency(df, "text")), "token", "text", "n") == [
        (0, "b", 2), (1, "a", 1), (2, "c", 1)]


@pytest.mark.parametrize("divisor", [3, 7, 10_000, 2**40 + 1, -3])
def test_whole_part_is_exact_at_the_ends_of_64_bits(spark, divisor):
    numbers = [2**55 + 3, 2**60 + 1, 2**63 - 1, -2**63 + 1, -2**60 - 1, -1, 0, 1, None]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", whole_part(F.col("n"), divisor).alias("part")).collect()
    assert all(r.part == (None if r.n is None else r.n // divisor) for r in rows) and len(rows) == len(numbers)
