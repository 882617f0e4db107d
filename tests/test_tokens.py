from __future__ import annotations

import base64
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F

from vecloom.operators import tokens as tk
from vecloom.operators.lines import document_lines
from vecloom.sources.tables import read_table
from vecloom.sources.vocabulary import LARGEST_RANK_FILE, Vocabulary, rank_file, shared_vocabulary, vocabulary_size, vocabulary_table


@pytest.fixture(scope="module")
def encoding(vocabulary):
    ranks = dict((base64.b64decode(p), int(r)) for p, r in (l.split() for l in open(vocabulary.rank_path, "rb")))
    return tiktoken.Encoding("check", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})


def encode(spark, vocabulary, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, line string")
    return [r.tokens for r in tk.tokenize_lines(df, vocabulary).orderBy("k").collect()]


def test_tokens_of_text_and_of_nothing(spark, vocabulary):
    text, empty, missing = encode(spark, vocabulary, "Test input", "", None)
    assert text and empty == [] and missing is None


def test_different_texts_have_different_tokens(spark, vocabulary):
    hello, world = encode(spark, vocabulary, "Hello", "World")
    assert hello != world


@pytest.mark.parametrize("text", ["Hello, world!", "", "naïve 猫 \U0001f600 é", "<|endoftext|> stays text", " \t two  blanks "])
def test_round_trip(spark, vocabulary, text):
    df = spark.createDataFrame([(1, text)], "k int, line string")
    back = tk.detokenize_lines(tk.tokenize_lines(df, vocabulary), vocabulary)
    assert back.first().line == text


def test_whole_documents_match_the_tokenizer(spark, vocabulary, encoding, small):
    lines = document_lines(read_table(spark, small, "documents", ["doc_id", "text"]))
    for row in tk.tokenize_lines(lines.withColumn("copy", F.col("line")), vocabulary).collect():
        assert row.tokens == encoding.encode_ordinary(row.copy)


def test_word_frequency_encodes_words_alone(spark, vocabulary, encoding, small):
    docs = read_table(spark, small, "documents", ["doc_id", "text"])
    found = {r.token: (r.text, r.n) for r in tk.word_frequency(docs, vocabulary, "text").collect()}
    wanted, characters = Counter(), 0
    for row in docs.collect():
        for word in filter(None, __import__("re").split(r"[ \t\n\x0b\f\r]+", row.text)):
            wanted.update(encoding.encode_ordinary(word))
            characters += len(word.encode())
    assert {t: n for t, (_, n) in found.items()} == dict(wanted)
    size = {r.token: len(r.bytes) for r in vocabulary_table(spark, vocabulary).collect()}
    assert sum(size[t] * n for t, (_, n) in found.items()) == characters


def test_line_frequency_encodes_lines_whole(spark, vocabulary, encoding):
    df = spark.createDataFrame([("the cat the cat",), ("the",)], "line string")
    found = {r.token: r.n for r in tk.word_frequency(df, vocabulary, mode="per_line").collect()}
    assert found == dict(Counter(encoding.encode_ordinary("the cat the cat") + encoding.encode_ordinary("the")))
    with pytest.raises(ValueError):
        tk.word_frequency(df, vocabulary, mode="other")


def test_vocabulary_texts(spark, vocabulary, encoding):
    table = {r.token: r for r in vocabulary_table(spark, vocabulary).collect()}
    assert len(table) == encoding.n_vocab
    for token, row in table.items():
        assert bytes(row.bytes) == encoding.decode_single_token_bytes(token)
        assert row.text == bytes(row.bytes).decode("utf-8", "replace")


def test_a_large_rank_file_is_refused(spark, tmp_path, monkeypatch):
    path = tmp_path / "ranks"
    path.write_bytes(b"IQ== 0\n")
    monkeypatch.setattr("vecloom.sources.vocabulary.LARGEST_RANK_FILE", 3)
    assert LARGEST_RANK_FILE > 3
    with pytest.raises(ValueError, match="too large"):
        rank_file(spark, Vocabulary(str(path)))


def test_unknown_ids_have_no_text(spark):
    words = spark.createDataFrame([(1, "a")], "token int, text string")
    rows = spark.createDataFrame([(1,), (2,)], "token int")
    assert {r.token: r.text for r in tk.detokenize_ids(rows, words).collect()} == {1: "a", 2: None}


def test_stream_and_shards(spark):
    lists = spark.createDataFrame([(5, [7, 8]), (1, [1, 2, 3]), (3, []), (9, [9])], "line_no bigint, tokens array<int>")
    stream = tk.token_stream(lists, ["line_no"])
    assert [r.token for r in stream.orderBy("pos").collect()] == [1, 2, 3, 7, 8, 9]
    sharded = tk.shard_tokens(stream, 4)
    assert sorted(map(tuple, sharded.collect())) == [(0, 0, 1), (0, 1, 8), (1, 0, 2), (1, 1, 9), (2, 0, 3), (3, 0, 7)]
    texts = tk.shard_texts(tk.shard_tokens(stream, 2), tokens_per_line=2)
    assert sorted(map(tuple, texts.collect())) == [(0, 0, "1 3"), (0, 1, "8"), (1, 0, "2 7"), (1, 1, "9")]
    assert sorted(r.token for r in tk.distinct_tokens(lists).collect()) == [1, 2, 3, 7, 8, 9]
    assert {r.token: r.n for r in tk.count_tokens(lists.unionAll(lists)).collect()} == dict.fromkeys([1, 2, 3, 7, 8, 9], 2)


@pytest.mark.parametrize("mode", ["per_word", "per_line"])
def test_the_tokenizer_runs_once_per_plan(spark, vocabulary, mode):
    df = spark.createDataFrame([("a b a",), ("",)], "line string")
    plan = tk.word_frequency(df, vocabulary, mode=mode)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_a_copied_rank_file_is_the_same_vocabulary(spark, vocabulary):
    copy = shared_vocabulary(spark, vocabulary.rank_path, vocabulary.pattern)
    assert encode(spark, copy, "Hello, world! naïve") == encode(spark, vocabulary, "Hello, world! naïve")
    assert vocabulary_size(spark, copy) == vocabulary_table(spark, vocabulary).count() == 50256


def test_word_counts_by_key_add_up(spark, vocabulary, small):
    docs = read_table(spark, small, "documents", ["lang", "text"])
    each = tk.word_frequency(docs, vocabulary, "text", keys=["lang"]).groupBy("token").agg(F.sum("n").alias("n"))
    whole = tk.word_frequency(docs, vocabulary, "text").select("token", "n")
    assert {tuple(r) for r in each.collect()} == {tuple(r) for r in whole.collect()}


def test_ids_to_text_in_the_jvm(spark, vocabulary):
    text = "naïve 日本語 \U0001F600\U0001F9D1\u200d\U0001F680 e\u0301"
    lines = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, line string")
    coded = tk.tokenize_lines(lines, vocabulary)
    ids = coded.where("k = 1").first().tokens
    back = tk.detokenize_lines(coded, vocabulary)
    assert "Python" not in back._jdf.queryExecution().optimizedPlan().toString().split("Project", 1)[0]
    assert {r.k: r.line for r in back.collect()} == {1: text, 2: "", 3: None}
    import tiktoken

    from vecloom.functions.codec import _encoding

    encoding = _encoding(open(vocabulary.rank_path, "rb").read(), vocabulary.pattern)
    assert isinstance(encoding, tiktoken.Encoding)
    cut = [(i, ids[:i]) for i in range(len(ids))] + [(100 + i, ids[i:]) for i in range(len(ids))]  # inside characters too
    found = tk.detokenize_lines(spark.createDataFrame(cut, "k int, tokens array<int>"), vocabulary)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.k: r.line for r in found.collect()} == {k: encoding.decode(own, errors="replace") for k, own in cut}
    odd = spark.createDataFrame([(1, [10**9, ids[0]]), (2, [-1]), (3, [None, ids[0]])], "k int, tokens array<int>")
    first = encoding.decode(ids[:1])
    assert {r.k: r.line for r in tk.detokenize_lines(odd, vocabulary).collect()} == {1: "\ufffd" + first, 2: "\ufffd", 3: "\ufffd" + first}


def test_the_ids_of_a_batch_are_held_as_numbers_not_as_lists(spark, vocabulary):
    import tracemalloc

    import pyarrow as pa

    from vecloom.functions.codec import encoder

    class Sent:
        value = open(vocabulary.rank_path, "rb").read()

    encode = encoder(Sent, vocabulary.pattern).func
    texts = [" ".join(f"word{i * j % 977} of" for j in range(400)) for i in range(300)] + [None, ""]
    assert next(encode(iter([pa.array(["warm"])]))).to_pylist()
    tracemalloc.start()
    found = next(encode(iter([pa.array(texts)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.null_count == 1 and found[300].as_py() is None and found[301].as_py() == []
    assert peak < 20 * len(found.flatten()), peak / len(found.flatten())
