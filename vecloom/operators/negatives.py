"""Negatives drawn by how often a token occurs: a table of cumulative weights, cut into cells that a draw finds at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.hashing import draw_wide
from vecloom.operators.blocks import block_count, join_blocks
from vecloom.operators.ordinal import running_offsets
from vecloom.session import write_table

#: Weights are whole multiples of one over this, so that sums are exact in any order and in any engine.
WEIGHT_UNIT = 1024


@dataclass(frozen=True)
class WeightedTokens:
    """Tokens with weights: ``spans`` ``(token, start, end)`` lie end to end over the whole numbers below ``total``.

    ``cells`` ``(cell, ends, tokens)`` cuts that range into stretches of ``width`` numbers, each with the tokens whose spans
    meet it. There are as many cells as tokens, so a cell has few tokens, and a draw falls on each cell alike: what joins
    draws with cells has no hot key, however frequent a token is.
    """

    spans: DataFrame
    cells: DataFrame
    total: int
    width: int


def token_weight(count: Column, power: float) -> Column:
    """``count ^ power`` in units of ``1 / WEIGHT_UNIT``, rounded down, at least one unit for a token that occurs.

    Three quarters are two square roots, which every engine rounds alike.
    """
    count = count.cast("double")
    raised = F.sqrt(count) * F.sqrt(F.sqrt(count)) if power == 0.75 else F.pow(count, F.lit(float(power)))
    return F.greatest(F.floor(raised * WEIGHT_UNIT), F.lit(1)).cast("bigint")


def weighted_tokens(counts: DataFrame, power: float = 0.75) -> WeightedTokens:
    """From ``(token, n)``, one row per token. Tokens that do not occur (``n`` null or below 1) are never drawn.

    Weights are added up along the order of the tokens by :func:`running_offsets`, so no task sees all of them. Power 0
    draws evenly among the tokens, power 1 by their counts.
    """
    weighed = write_table(counts.where("token IS NOT NULL AND n > 0").select("token", token_weight(F.col("n"), power).alias("_weight")), "token-weights")
    number, total = weighed.agg(F.count(F.lit(1)), F.sum("_weight")).first()
    starts = running_offsets(weighed, ["token"], F.col("_weight"))
    spans = write_table(weighed.join(starts, "token").select("token", F.col("offset").alias("start"), (F.col("offset") + F.col("_weight")).alias("end")), "token-spans")
    total, width = total or 0, max(1, -(-(total or 0) // max(number, 1)))
    met = F.sequence(F.call_function("div", F.col("start"), F.lit(width).cast("bigint")), F.call_function("div", F.col("end") - 1, F.lit(width).cast("bigint")))
    inside = spans.select("token", "end", F.explode(met).alias("cell")).groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("end", "token"))).alias("_t"))
    cells = write_table(inside.select("cell", F.col("_t.end").alias("ends"), F.col("_t.token").alias("tokens")), "token-cells")
    return WeightedTokens(spans, cells, total, width)


def draw_tokens(rows: DataFrame, weighted: WeightedTokens, name: str, *parts: Column | str | int) -> DataFrame:
    """``rows`` with ``name``, a token drawn by weight with a hash of ``parts``; NULL if no token has a weight.

    The same row gets the same token in every run. Rows meet the one cell their draw falls in, and find the token there; cells
    of a bounded size, those of some million tokens, go to the rows.
    """
    if not weighted.total:
        return rows.withColumn(name, F.lit(None).cast(weighted.spans.schema["token"].dataType))
    drawn = rows.withColumn("_draw", draw_wide(weighted.total, *parts)).withColumn(
        "_cell", F.call_function("div", F.col("_draw"), F.lit(weighted.width).cast("bigint")))
    cells = weighted.cells.toDF("_cell", "_ends", "_tokens")
    before = F.size(F.filter("_ends", lambda end: end <= F.col("_draw")))
    return join_blocks(drawn, cells, "_cell", block_count(cells) == 1).withColumn(name, F.get("_tokens", before)).drop("_draw", "_cell", "_ends", "_tokens")


def negative_samples_weighted(pairs: DataFrame, keys: list[str], weighted: WeightedTokens, seed: int) -> DataFrame:
    """``pairs`` with ``n``, one token drawn by weight with the pair's own key. It may equal c or o."""
    return draw_tokens(pairs, weighted, "n", seed, *[F.col(k) for k in keys])
