"""Lines of a corpus: making, numbering, ordering, dealing, counting, and their text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.text import (
    NO_NUMBER, NO_TAB, NO_TOKENS, NO_VALUE, lines_of, must_cast, pair_field, piece_ids_of, pieces_of, rejected, whole_numbers, whole_part, words_of)
from vecloom.operators.ordinal import running_offsets, with_ordinal
from vecloom.session import write_table


def dealt_documents(documents: DataFrame) -> DataFrame:
    """``(doc_id, text)`` dealt by ``doc_id`` to the session's number of shuffle partitions.

    Text moves once, and what is grouped by document behind it moves no more. A shuffle that names its number is not merged
    into as few partitions as there are cores, which would make long tasks of the work on lines and words that follows.
    """
    return documents.select("doc_id", "text").repartition(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")


def document_lines(documents: DataFrame) -> DataFrame:
    """``(doc_id, pos, line)`` from ``(doc_id, text)``."""
    return documents.select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("pos", "line")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "line")


def number_lines(documents: DataFrame) -> DataFrame:
    """``(line_no, line)``: all lines of all documents numbered from 0, documents in ``doc_id`` order.

    Only line counts per document are range-partitioned; the text itself is exploded after its document
    has its start, so it is never sorted.
    """
    starts = running_offsets(documents, ["doc_id"], F.size(lines_of(F.col("text"))))
    placed = dealt_documents(documents).join(starts.hint("shuffle_hash"), "doc_id")
    return placed.select("offset", F.posexplode(lines_of(F.col("text"))).alias("pos", "line")).select(
        (F.col("offset") + F.col("pos")).alias("line_no"), "line")


def order_lines(rows: DataFrame, keys: list[str], name: str = "line_no") -> DataFrame:
    """Rows numbered by a unique key and in that order, sorted over all partitions."""
    return with_ordinal(rows, keys, name).orderBy(name)


def deal(rows: DataFrame, ordinal: str, shards: int, position: str) -> DataFrame:
    """Deal numbered rows round: ``shard`` is the number modulo ``shards``, ``position`` the turn. No shuffle."""
    number = F.col(ordinal)
    return rows.withColumn("shard", F.pmod(number, F.lit(shards)).cast("int")).withColumn(
        position, whole_part(number, shards))


def shard_lines(numbered: DataFrame, shards: int) -> DataFrame:
    """``(shard, shard_line, line_no, line)`` from ``(line_no, line)``."""
    return deal(numbered, "line_no", shards, "shard_line").select("shard", "shard_line", "line_no", "line")


def line_splits(numbered: DataFrame, lines_per_split: int) -> DataFrame:
    """``numbered`` with ``split_no``: every ``lines_per_split`` lines in order are one split."""
    return numbered.withColumn("split_no", whole_part(F.col("line_no"), lines_per_split))


def concat_by_line(rows: DataFrame, keys: list[str], order_by: str, value: str) -> DataFrame:
    """``(keys..., value)``: the values of one key joined by blanks, in the order of ``order_by``.

    For keys whose values together are one line; a line has to fit one row anyway. Nothing is combined before a shuffle, so
    rows of large tables should lie together by a part of the key, as behind :func:`dealt_documents`, and then stay there.
    """
    parts = F.array_sort(F.collect_list(F.struct(F.col(order_by).alias("_at"), F.col(value).alias("_v"))))
    return rows.groupBy(*keys).agg(parts.alias("_parts")).select(
        *keys, F.array_join(F.col("_parts._v"), " ").alias(value))


def split_words(lines: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``(keys..., word_no, word)``: one row per word between blanks."""
    return lines.select(*keys, F.posexplode(words_of(F.col(text))).alias("word_no", "word")).withColumn(
        "word_no", F.col("word_no").cast("bigint"))


def piece_frequency(lines: DataFrame, text: str) -> DataFrame:
    """``(piece, n)``; a frequent piece is counted on the map side first."""
    return lines.select(F.explode(pieces_of(F.col(text))).alias("piece")).groupBy("piece").agg(
        F.count(F.lit(1)).alias("n"))


def piece_vocabulary(counts: DataFrame) -> DataFrame:
    """``(token, text, n)`` from ``(piece, n)``: token ids from 0, the most frequent piece first.

    The counts are written before they are ranked, so the text behind them is read once.
    """
    counted = write_table(counts.select((-F.col("n")).alias("_rarity"), "piece"), "counts")
    return running_offsets(counted, ["_rarity", "piece"]).select(
        F.col("offset").alias("token"), F.col("piece").alias("text"), (-F.col("_rarity")).alias("n"))


def corpus_stats(documents: DataFrame, vocab_size: int) -> DataFrame:
    """One row: documents, lines, words, tokens, and the vocabulary size, the largest token id plus one.

    Every number is an aggregate of per-document numbers, so the text is read once and nothing is exploded.
    """
    text = F.col("text")
    ids = piece_ids_of(text, vocab_size)
    per_document = documents.select(
        F.size(lines_of(text)).alias("lines"), F.size(words_of(text)).alias("words"), ids.alias("ids")).select(
        "lines", "words", F.size("ids").alias("tokens"), F.array_max("ids").alias("largest"))
    return per_document.agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("lines").cast("bigint").alias("n_lines"),
        F.sum("words").cast("bigint").alias("n_words"), F.sum("tokens").cast("bigint").alias("n_tokens"),
        (F.max("largest") + 1).cast("bigint").alias("vocab_size"))


def judge_numbered_lines(rows: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """``(value, reason, line_no, line)`` for every row; ``reason`` says why :func:`parse_numbered_lines` drops it, or is NULL."""
    fields = rows.select(F.col(value).alias("value"), F.split(F.col(value), "\t", 2).alias("_f"))
    first, rest = (pair_field(F.col("_f"), place) for place in (0, 1))
    number = must_cast(first, "bigint") if strict else first.try_cast("bigint")
    read = fields.select("value", "_f", number.alias("line_no"), rest.alias("line"))
    return read.select("value", rejected((F.col("value").isNull(), NO_VALUE), (F.size("_f") != 2, NO_TAB), (F.col("line_no").isNull(), NO_NUMBER)), "line_no", "line")


def parse_numbered_lines(rows: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """``(line_no, line)`` from ``number TAB text``; later tabs stay in the text.

    Rows without a tab are dropped. A number that cannot be read drops the row, or fails the job if strict.
    """
    return judge_numbered_lines(rows, value, strict).where(F.col("reason").isNull()).select("line_no", "line")


def judge_token_lines(rows: DataFrame, value: str = "value") -> DataFrame:
    """``(value, reason, line_no, tokens, skipped)`` for every row; ``reason`` says why :func:`parse_token_lines` drops it, or is
    NULL, and ``skipped`` counts the words of a row that are no ids."""
    fields = rows.select(F.col(value).alias("value"), F.split(F.col(value), "\t", 2).alias("_f"))
    first, rest = (pair_field(F.col("_f"), place) for place in (0, 1))
    worded = fields.select("value", "_f", first.try_cast("bigint").alias("line_no"), rest.alias("_rest"), words_of(rest).alias("_w"))
    read = worded.select("value", "_f", "line_no", "_rest", whole_numbers(F.col("_w")).alias("tokens"), F.size("_w").alias("_words"))
    reason = rejected((F.col("value").isNull(), NO_VALUE), (F.size("_f") != 2, NO_TAB), (F.trim("_rest") == "", NO_TOKENS), (F.col("line_no").isNull(), NO_NUMBER))
    return read.select("value", reason, "line_no", "tokens", (F.col("_words") - F.size("tokens")).cast("bigint").alias("skipped"))


def parse_token_lines(rows: DataFrame, value: str = "value") -> DataFrame:
    """``(line_no, tokens)`` from ``number TAB id id id``.

    Rows without a tab or with a blank list are dropped; a token that is no 32-bit whole number is skipped
    and the rest of its line kept.
    """
    return judge_token_lines(rows, value).where(F.col("reason").isNull()).select("line_no", "tokens")


def parse_token_shard(rows: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """``(keys..., tokens)`` from a line of blank-separated ids; a word that is no id fails the job."""
    return rows.select(*keys, F.transform(words_of(F.col(value)), lambda word: must_cast(word, "int")).alias("tokens"))


def format_numbered_lines(numbered: DataFrame) -> DataFrame:
    """``(line_no, value)``: ``number TAB text``."""
    return numbered.select("line_no", F.concat_ws("\t", F.col("line_no").cast("string"), "line").alias("value"))


def token_line_text() -> Column:
    """``number TAB id id id`` of ``(line_no, tokens)``."""
    return F.concat_ws("\t", F.col("line_no").cast("string"), F.array_join(F.col("tokens").cast("array<string>"), " "))


def format_token_lines(tokenised: DataFrame) -> DataFrame:
    """``(line_no, value)``: ``number TAB id id id``."""
    return tokenised.select("line_no", token_line_text().alias("value"))


def word_count_text() -> Column:
    """``text n id`` of ``(token, text, n)``."""
    return F.concat_ws(" ", "text", F.col("n").cast("string"), F.col("token").cast("string"))


def format_word_counts(counts: DataFrame) -> DataFrame:
    """``(token, value)``: ``text n id`` from ``(token, text, n)``."""
    return counts.select("token", word_count_text().alias("value"))
