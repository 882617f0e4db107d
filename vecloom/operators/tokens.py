"""Byte-pair tokens: encoding, decoding, counting, and the one stream of all tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.codec import encoder
from vecloom.functions.text import BLANKS, whole_part
from vecloom.operators.lines import deal
from vecloom.operators.ordinal import with_offset
from vecloom.session import ship_package
from vecloom.sources.vocabulary import LARGEST_RANK_FILE, Vocabulary, rank_file, vocabulary_table


def tokenize_lines(lines: DataFrame, vocabulary: Vocabulary, text: str = "line") -> DataFrame:
    """``lines`` with the whole text of each line replaced by its ids, ``tokens``."""
    spark = lines.sparkSession
    ship_package(spark)
    encode = encoder(rank_file(spark, vocabulary), vocabulary.pattern)
    return lines.withColumn("tokens", encode(F.col(text))).drop(text)


def detokenize_lines(tokenised: DataFrame, vocabulary: Vocabulary, text: str = "line") -> DataFrame:
    """``tokenised`` with the ids of each list, ``tokens``, replaced by their text.

    The bytes of all ids of a list are joined before they are read, so characters that are split over ids come back whole;
    what is no character reads as the replacement character, as does an unknown or missing id. No list, no text; an empty
    list is the empty text. Rows stay where they lie and no Python runs: the vocabulary is one array, indexed by id, that a
    subquery brings to every task after a check of its size.
    """
    spark = tokenised.sparkSession
    words = vocabulary_table(spark, vocabulary).select(F.col("token").cast("bigint").alias("id"), F.col("bytes").cast("string").alias("raw"))
    size, held = words.agg(F.max("id") + 1, F.sum(F.octet_length("raw") + 16)).first()
    if (held or 0) + 8 * (size or 0) > 4 * LARGEST_RANK_FILE:
        raise ValueError("a vocabulary too large to send to every task")
    places = spark.range(size or 0).join(words, "id", "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("raw", F.lit("\ufffd")).alias("raw"))))
    array = places.agg(F.transform(listed, lambda word: word["raw"]).alias("_words")).scalar()
    named = F.transform("tokens", lambda token: F.coalesce(F.get("_words", token), F.lit("\ufffd")))
    return tokenised.withColumn("_words", array).withColumn(text, F.make_valid_utf8(F.array_join(named, ""))).drop("tokens", "_words")


def detokenize_ids(rows: DataFrame, words: DataFrame, token: str = "token", text: str = "text") -> DataFrame:
    """``rows`` with ``text``, the text of each id in ``words`` ``(token, text)``; an unknown id has none.

    For rows that are per token already (counts, neighbours), not per occurrence. ``words`` is one row per
    vocabulary entry; Spark broadcasts it while its size allows.
    """
    named = words.select(F.col("token").alias("_token"), F.col("text").alias(text))
    return rows.join(named, F.col(token) == F.col("_token"), "left").drop("_token")


def each_token(rows: DataFrame, keys: list[str], tokens: Column | str = "tokens") -> DataFrame:
    """``(keys..., token)``: one row per id of each list.

    The outer form and a filter behind it: for a plain explode Spark infers the filter "list not empty" and
    pushes it down, even below an aggregation, where the tokenizer would run again on every row.
    """
    return rows.select(*keys, F.explode_outer(tokens).alias("token")).where(F.col("token").isNotNull())


def count_tokens(tokenised: DataFrame) -> DataFrame:
    """``(token, n)`` over lists ``tokens``."""
    return each_token(tokenised, []).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def word_frequency(
        lines: DataFrame, vocabulary: Vocabulary, text: str = "line", mode: str = "per_word", keys: list[str] | None = None) -> DataFrame:
    """``(keys..., token, text, n)``: how often each id occurs, in all lines or for each value of ``keys``.

    ``per_word`` encodes every word by itself, without the blank before it; ``per_line`` encodes whole lines.
    Words repeat, so they are counted first and each distinct word is encoded once; its count then weighs
    its ids. Both counts combine on the map side, so a word that is a third of the text is no hot spot.
    """
    spark, keys = lines.sparkSession, keys or []
    if mode == "per_line":
        counts = each_token(tokenize_lines(lines.select(*keys, text), vocabulary, text), keys).groupBy(*keys, "token").agg(
            F.count(F.lit(1)).alias("n"))
    elif mode == "per_word":
        ids = each_token(tokenize_lines(count_words(lines, text, keys), vocabulary, "word"), [*keys, "n"])
        counts = ids.groupBy(*keys, "token").agg(F.sum("n").alias("n"))
    else:
        raise ValueError(f"mode must be per_word or per_line, not {mode}")
    return detokenize_ids(counts, vocabulary_table(spark, vocabulary)).select(*keys, "token", "text", "n")


def count_words(lines: DataFrame, text: str = "line", keys: list[str] | None = None) -> DataFrame:
    """``(keys..., word, n)``: how often each word between blanks occurs."""
    keys = keys or []
    return lines.select(*keys, F.explode(F.split(text, BLANKS)).alias("word")).where(F.col("word") != "").groupBy(*keys, "word").agg(
        F.count(F.lit(1)).alias("n"))


def encoded_words(lines: DataFrame, vocabulary: Vocabulary, text: str = "line") -> DataFrame:
    """``(word, n, text)``: each distinct word, how often it occurs, and what its ids decode to."""
    coded = tokenize_lines(count_words(lines, text).withColumn("_word", F.col("word")), vocabulary, "_word")
    return detokenize_lines(coded, vocabulary, "text").select("word", "n", "text")


def token_stream(tokenised: DataFrame, order_by: list[str]) -> DataFrame:
    """``(pos, token)``: all ids of all lists, numbered from 0 in the order of the unique key ``order_by``.

    ``tokenised`` is read twice; where its ids are dear to make, write it as a table first. A blank line has
    no ids and vanishes.
    """
    placed = with_offset(tokenised.select(*order_by, "tokens"), order_by, F.size("tokens"))
    return placed.select("offset", F.posexplode_outer("tokens").alias("_at", "token")).where(
        F.col("token").isNotNull()).select((F.col("offset") + F.col("_at")).alias("pos"), "token")


def shard_tokens(stream: DataFrame, shards: int) -> DataFrame:
    """``(shard, shard_pos, token)``: the stream dealt round, so neighbours in the text part."""
    return deal(stream, "pos", shards, "shard_pos").select("shard", "shard_pos", "token")


def distinct_tokens(tokenised: DataFrame) -> DataFrame:
    """``(token)``, each id once; a list's repeats go before anything is exploded."""
    return each_token(tokenised, [], F.array_distinct("tokens")).distinct()


def shard_texts(sharded: DataFrame, tokens_per_line: int = 100_000) -> DataFrame:
    """``(shard, line, value)``: each shard's ids in order as text lines of at most ``tokens_per_line`` ids.

    A shard grows with the corpus, a line does not.
    """
    lines = sharded.withColumn("line", whole_part(F.col("shard_pos"), tokens_per_line))
    ids = F.array_sort(F.collect_list(F.struct("shard_pos", "token")))
    return lines.groupBy("shard", "line").agg(ids.alias("_ids")).select(
        "shard", "line", F.array_join(F.col("_ids.token").cast("array<string>"), " ").alias("value"))
