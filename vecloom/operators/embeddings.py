"""Embedding tables ``(token, embedding)``: text forms, lookup, merging."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.hashing import draw_unit
from vecloom.functions.text import NO_NUMBER, NO_PAIR, NO_VALUE, NO_VECTOR, float_list, must_cast, pair_field, rejected, stripped
from vecloom.functions.vector import combine_vectors, exact_text, fixed_text
from vecloom.operators.blocks import block_count, join_blocks

#: Over how many copies of its vector a frequent token's occurrences are spread.
LOOKUP_SALTS = 32
#: A token with more than one in so many rows is hot.
HOT_SHARE = 500


def judge_embeddings(rows: DataFrame, keep: list[str] | None = None, value: str = "value", strict: bool = False) -> DataFrame:
    """``(keep..., value, reason, token, embedding)`` for every row; ``reason`` says why :func:`parse_embeddings` drops it, or is NULL."""
    keep = keep or []
    text = F.col(value)
    first, rest = (pair_field(F.col("_f"), place) for place in (0, 1))
    fields = rows.select(*keep, text.alias("value"), (F.split(stripped(text), "\t") if strict else F.split(text, r"\s+", 2)).alias("_f"))
    if strict:
        token, vector = must_cast(first, "int"), F.transform(float_list(rest), lambda x: must_cast(x, "float"))
    else:
        token, vector = F.trim(first).try_cast("int"), _floats(rest)
    read = fields.select(*keep, "value", "_f", token.alias("token"), vector.alias("embedding"))
    pair = (F.col("value").isNull(), NO_VALUE), (F.size("_f") != 2, NO_PAIR)
    unread = () if strict else ((F.col("token").isNull(), NO_NUMBER), (~_readable(F.col("embedding")), NO_VECTOR))
    return read.select(*keep, "value", rejected(*pair, *unread), "token", "embedding")


def parse_embeddings(rows: DataFrame, keep: list[str] | None = None, value: str = "value", strict: bool = False) -> DataFrame:
    """``(keep..., token, embedding)`` from ``id TAB [f,f,...]``.

    White space at both ends of a row and of its vector does not count, and neither do empty fields at the end.
    Strict: a row without exactly two tab fields is dropped, a number that cannot be read fails the job.
    Lenient: id and vector may be parted by any blanks, and every row that cannot be read is dropped, as is one that
    begins with a blank.
    """
    return judge_embeddings(rows, keep, value, strict).where(F.col("reason").isNull()).select(*(keep or []), "token", "embedding")


def judge_vectors(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``(keys..., value, reason, embedding)`` for every row; ``reason`` says why :func:`parse_vectors` drops it, or is NULL."""
    read = rows.select(*keys, F.col(value).alias("value"), _floats(F.col(value)).alias("embedding"))
    return read.select(*keys, "value", rejected((F.col("value").isNull(), NO_VALUE), (~_readable(F.col("embedding")), NO_VECTOR)), "embedding")


def parse_vectors(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``(keys..., embedding)`` from ``[f,f,...]``; rows with a bad number are dropped, so no mean counts them."""
    return judge_vectors(rows, keys, value).where(F.col("reason").isNull()).select(*keys, "embedding")


def _floats(text: Column) -> Column:
    return F.transform(float_list(text), lambda x: x.try_cast("float"))


def _readable(vector: Column) -> Column:
    return ~F.exists(vector, lambda x: x.isNull())


def format_embeddings(embeddings: DataFrame, digits: int | None = 6) -> DataFrame:
    """``(token, value)``: ``id TAB [f,f,...]`` with ``digits`` decimals, or with all that the float needs if None."""
    vector = F.col("embedding")
    text = exact_text(vector) if digits is None else fixed_text(vector, digits)
    return embeddings.select("token", F.concat_ws("\t", F.col("token").cast("string"), text).alias("value"))


def dedupe_embeddings(rows: DataFrame, key: str, load_order: str, vector: str = "embedding") -> DataFrame:
    """``(key, load_order, vector)``: of the rows of one key the last loaded stays. Combines on the map side."""
    latest = F.max_by(F.struct(load_order, vector), load_order).alias("_last")
    return rows.groupBy(key).agg(latest).select(key, f"_last.{load_order}", f"_last.{vector}")


def hot_tokens(occurrences: DataFrame, share: int = HOT_SHARE, token: str = "token") -> list[int]:
    """The tokens that may hold more than one in ``share`` of the rows, fewer than ``4 * share`` of them.

    A sketch of frequent items, kept per task and merged, finds them in one pass; its estimates are never too low by more than
    it allows for here, and a token too many does no harm.
    """
    found = occurrences.agg(F.count(F.lit(1)).alias("n"), F.call_function(
        "approx_top_k", token, F.lit(4 * share), F.lit(64 * share)).alias("top")).first()
    return [row["item"] for row in found["top"] or [] if row["item"] is not None and row["count"] * 2 * share > found["n"]]


def lookup_embeddings(occurrences: DataFrame, embeddings: DataFrame, hot: Collection[int] = ()) -> DataFrame:
    """``occurrences`` ``(token, ...)`` with the embedding of each row's token; tokens without one are dropped.

    The embedding side has one row per token. The vectors of the ``hot`` tokens alone, see :func:`hot_tokens`, are copied
    ``LOOKUP_SALTS`` times, and their occurrences are dealt over the copies by a hash of their other columns, so a token in a
    third of all rows does not meet its vector in one task; rows equal in all columns stay together. Spark may broadcast the
    vectors by its own threshold. The rows are the same whatever ``hot`` holds. Where only the number of an occurrence
    matters, count first: then no token is hot.
    """
    if not hot:
        return occurrences.join(embeddings.select("token", "embedding"), "token")
    salts, few, last = F.lit(LOOKUP_SALTS), F.col("token").isin(list(hot)), F.when(F.col("token").isin(list(hot)), LOOKUP_SALTS - 1).otherwise(0)
    copies = embeddings.select("token", "embedding", F.explode(F.sequence(F.lit(0), last)).alias("_salt"))
    dealt = occurrences.withColumn("_salt", F.when(few, F.pmod(F.xxhash64(*occurrences.columns), salts).cast("int")).otherwise(0))
    return dealt.join(copies, ["token", "_salt"]).drop("_salt")


def lookup_occurrences(occurrences: DataFrame, embeddings: DataFrame) -> DataFrame:
    """:func:`lookup_embeddings` for very many rows that shall stay beside their like, as those of one document do, until they
    are added up: vectors of a bounded size go to the rows, see :mod:`vecloom.operators.blocks`. Larger tables meet them by a
    shuffle, hot tokens apart.
    """
    vectors = embeddings.select("token", "embedding")
    blocks = block_count(vectors)
    return join_blocks(occurrences, vectors, "token", blocks) if blocks else lookup_embeddings(occurrences, embeddings, hot_tokens(occurrences))


def unknown_tokens(counts: DataFrame, embeddings: DataFrame) -> DataFrame:
    """``counts`` ``(token, n)`` of the tokens without an embedding: what a lookup drops."""
    return counts.join(embeddings.select("token"), "token", "left_anti")


def mean_embeddings(rows: DataFrame, width: int, key: str = "token", vector: str = "embedding", weight: str | None = None) -> DataFrame:
    """``(key, vector)``: the mean vector of each key, weighted if asked. A length other than ``width`` fails the job."""
    return combine_vectors(rows, [key], vector, width, how="mean", weight=weight)


def init_embeddings(tokens: DataFrame, dim: int, seed: int) -> DataFrame:
    """``(token, embedding)``: a start vector per token, even in [0, 1), the same on every shard and every run."""
    place = F.sequence(F.lit(0), F.lit(dim - 1))
    return tokens.select("token", F.transform(place, lambda j: draw_unit(seed, F.col("token"), j)).alias("embedding"))
