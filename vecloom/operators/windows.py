"""Windows over token lists, the pairs inside them, and their negatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.hashing import draw_below

#: How many windows of a long stream are cut out of one list.
WINDOWS_PER_STRETCH = 256


def window_count(length: Column, size: int, step: int) -> Column:
    """How many windows a list of this length has: none if empty, else as many as reach its end, the last maybe short."""
    beyond = F.greatest(length - F.lit(max(size, step)), F.lit(0))
    return F.when(length == 0, F.lit(0)).otherwise(F.lit(1) + F.ceil(beyond / F.lit(step))).cast("int")


def windows_of(tokens: Column, size: int, step: int) -> Column:
    count = window_count(F.size(tokens), size, step)
    starts = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(tokens, i * F.lit(step) + F.lit(1), F.lit(size)))


def token_windows(sequences: DataFrame, keys: list[str], size: int, step: int) -> DataFrame:
    """``(keys..., win_no, window)`` from lists ``tokens``."""
    _positive(size, step)
    return sequences.select(*keys, F.posexplode(windows_of(F.col("tokens"), size, step)).alias("win_no", "window")).withColumn(
        "win_no", F.col("win_no").cast("bigint"))


def stream_stretches(sharded: DataFrame, size: int, step: int) -> DataFrame:
    """``(shard, first_win, n_windows, tokens)`` over streams ``(shard, shard_pos, token)`` of any length.

    A stream is cut into stretches of ``WINDOWS_PER_STRETCH`` windows, each with the few tokens its last
    windows share with the next stretch, so no stream is ever gathered. Window ``i`` of a stretch begins at
    its token ``i * step``.
    """
    _positive(size, step)
    at, span, reach = F.col("shard_pos"), F.lit(WINDOWS_PER_STRETCH * step), max(size, step)
    first = F.greatest(F.ceil((at - F.lit(size - 1 - step)) / span) - 1, F.lit(0)).cast("bigint")
    last = F.floor(at / span).cast("bigint")
    # place in the stretch and token as one number, in the same order: a list of numbers is a third of a list of pairs
    packed = (F.col("shard_pos") - F.col("_stretch") * span).cast("bigint") * F.lit(1 << 32) + F.col("token").cast("bigint")
    small = sharded.schema["token"].dataType.simpleString() == "int"
    stretches = sharded.where(first <= last).select(
        "shard", F.explode(F.sequence(first, last)).alias("_stretch"), "shard_pos", "token").select(
        "shard", "_stretch", (packed if small else F.struct("shard_pos", "token")).alias("_p")).groupBy("shard", "_stretch").agg(
        F.array_sort(F.collect_list("_p")).alias("_t"))
    # a window follows another if the stream goes on behind the earlier one, which the stretch itself shows
    open_windows = F.ceil((F.size("_t") - F.lit(reach - step)) / F.lit(step))
    least = F.when(F.col("_stretch") == 0, 1).otherwise(0)
    count = F.least(F.greatest(open_windows, least), F.lit(WINDOWS_PER_STRETCH)).cast("int")
    return stretches.where(count > 0).select(
        "shard", (F.col("_stretch") * F.lit(WINDOWS_PER_STRETCH)).alias("first_win"), count.alias("n_windows"),
        (F.transform("_t", _low_half) if small else F.col("_t.token")).alias("tokens"))


def _low_half(packed: Column) -> Column:
    low = packed.bitwiseAND(F.lit((1 << 32) - 1))
    return F.when(low >= 1 << 31, low - F.lit(1 << 32)).otherwise(low).cast("int")


def stream_windows(sharded: DataFrame, size: int, step: int) -> DataFrame:
    """``(shard, win_no, window)``: the windows of streams ``(shard, shard_pos, token)``, as over one list per shard."""
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.col("n_windows") - 1, F.lit(0))),
                      lambda i: F.slice(F.col("tokens"), i * F.lit(step) + F.lit(1), F.lit(size)))
    return stream_stretches(sharded, size, step).select("shard", "first_win", F.posexplode(cut).alias("_i", "window")).select(
        "shard", (F.col("first_win") + F.col("_i")).alias("win_no"), "window")


def skipgram_pairs(windows: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys..., pair_no, c, o)``: each token of a window with the one after it. Overlapping windows repeat a pair."""
    w = F.col("window")
    inner = F.when(F.size(w) > 1, F.arrays_zip(
        F.slice(w, F.lit(1), F.size(w) - 1).alias("c"), F.slice(w, F.lit(2), F.size(w) - 1).alias("o")))
    return windows.select(*keys, F.posexplode(inner).alias("_at", "_p")).select(
        *keys, F.col("_at").cast("bigint").alias("pair_no"), F.col("_p.c").alias("c"), F.col("_p.o").alias("o"))


def negative_samples(pairs: DataFrame, keys: list[str], vocab_size: int, seed: int) -> DataFrame:
    """``pairs`` with ``n``, one token drawn evenly from the vocabulary by the pair's own key. It may equal c or o."""
    return pairs.withColumn("n", draw_below(vocab_size, seed, *[F.col(k) for k in keys]).cast("int"))


def _positive(size: int, step: int) -> None:
    if size < 1 or step < 1:
        raise ValueError("window size and stride must be at least 1")
