"""Exact nearest neighbours without scoring all pairs: blocks of like direction, and a bound on what two blocks can score."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.functions.vector import norm
from vecloom.operators.similarity import DIGITS, score_cell, top_k_similar, unit_rows
from vecloom.session import ship_package, write_table

#: Directions by which blocks are made, at most, and rows of a block. More rows than both allow make larger blocks.
MOST_PIVOTS, BLOCK_ROWS, MOST_BLOCKS = 1024, 4096, 2048
#: As many directions, if the vectors suffice, are used where fewer blocks would do.
FEW_PIVOTS = 64
#: Angles are widened by this, so that rounding never hides a pair.
SLACK = 1e-7

_PARTIAL = "token bigint, neighbour bigint, sim double"


@dataclass
class PrunedNeighbours:
    """``neighbours`` ``(token, rank, neighbour, sim)``, and how many pairs of blocks there are and were never scored."""

    neighbours: DataFrame
    block_pairs: int
    skipped: int


def pruned_neighbours(embeddings: DataFrame, k: int = 5, pivots: int | None = None, block_rows: int = BLOCK_ROWS) -> PrunedNeighbours:
    """The same rows as :func:`vecloom.operators.similarity.top_k_similar`, from fewer scores where vectors lie in clusters.

    Every vector joins the nearest of some pivots, vectors drawn by a hash of their id; the vectors of a pivot are cut into
    blocks. The angle between two vectors is at least that between their pivots less the largest angles of both blocks to
    theirs, so no pair of the two blocks scores above its cosine. First each block is compared with itself and with the
    block nearest to it, which gives every token a ``k``-th score to beat; then two blocks meet only if some token of
    either could still find a better or an equal score there. Equal scores are settled by the smaller id as ever, since
    only what is lower after rounding is skipped. Where directions are spread evenly nothing can be skipped, and the work is
    that of ``top_k_similar``.

    Zero vectors have no direction: their similarity is NULL and ranks last. One row per token; the driver sees one row per
    block, ``MOST_BLOCKS`` at most, and the pivots.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    kind = embeddings.schema["token"].dataType
    held = write_table(embeddings.select(F.col("token").cast("bigint").alias("token"), "embedding", (norm(F.col("embedding")) > 0).alias("_real")), "vectors")
    rows, real = held.agg(F.count(F.lit(1)), F.count(F.when(F.col("_real"), 1))).first()
    if real <= k + 1:  # zero vectors would be among the best
        return PrunedNeighbours(top_k_similar(embeddings, k, rows), 0, 0)
    # a pivot is a block at least, and a vector is copied once per block it meets: no more pivots than blocks are needed
    wanted = pivots or max(1, min(MOST_PIVOTS, int(np.sqrt(real)), max(FEW_PIVOTS, -(-real // block_rows))))
    drawn = held.where("_real").orderBy(F.xxhash64("token"), "token").limit(wanted).select("embedding").toArrow()["embedding"]
    centres = unit_rows(pa.concat_arrays(drawn.chunks))
    per_block = max(block_rows, -(-2 * real // MOST_BLOCKS))

    schema = f"token bigint, embedding {held.schema['embedding'].dataType.simpleString()}, pivot int, angle double"
    placed = held.where("_real").select("token", "embedding").mapInArrow(_nearest(spark.sparkContext.broadcast(centres)), schema)
    near = write_table(placed, "pivots")
    sizes = near.groupBy("pivot").agg((F.floor((F.count(F.lit(1)) - 1) / per_block) + 1).cast("int").alias("parts"))
    parted = near.join(F.broadcast(sizes), "pivot").select("token", "embedding", "angle", F.struct(
        "pivot", F.pmod(F.xxhash64("token"), F.col("parts")).cast("int").alias("part")).alias("_b"))  # a row per pivot
    stats = parted.groupBy("_b").agg(F.max("angle").alias("radius")).orderBy("_b").collect()
    number = spark.createDataFrame([(r["_b"]["pivot"], r["_b"]["part"], i) for i, r in enumerate(stats)], "pivot int, part int, block int")
    blocks = write_table(parted.select("token", "embedding", "_b.*").join(F.broadcast(number), ["pivot", "part"]).select("token", "embedding", "block"), "blocks")
    bound = block_bounds(centres[[r["_b"]["pivot"] for r in stats]], np.array([r["radius"] for r in stats]))

    first = np.eye(len(stats), dtype=bool)
    if len(stats) > 1:
        beside = np.where(first, -2.0, bound).argmax(axis=1)
        first[np.arange(len(stats)), beside] = first[beside, np.arange(len(stats))] = True
    begun = write_table(_scored(blocks, first, k), "first-scores")
    best = Window.partitionBy("token").orderBy(F.desc("sim"), "neighbour")
    kth = begun.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") == k).select("token", "sim")
    floors = blocks.select("token", "block").join(kth, "token", "left").groupBy("block").agg(
        F.min(F.coalesce("sim", F.lit(-2.0))).alias("floor")).orderBy("block").collect()
    floor = np.array([r["floor"] for r in floors])
    rest = ~first & ((bound >= floor[:, None]) | (bound >= floor[None, :]))
    found = begun
    if rest.any():
        found = begun.unionByName(_scored(blocks, rest, k))
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if real < rows:  # zero vectors score NULL with all others, so the smallest ids come first
        smallest = held.orderBy("token").limit(k + 1).select(F.col("token").alias("neighbour"))
        blank = held.where(~F.col("_real")).select("token").join(F.broadcast(smallest), F.col("token") != F.col("neighbour"))
        numbered = blank.withColumn("sim", F.lit(None).cast("double")).withColumn("rank", F.row_number().over(Window.partitionBy("token").orderBy("neighbour")))
        top = top.unionByName(numbered.where(F.col("rank") <= k))
    pairs = len(stats) * (len(stats) + 1) // 2
    scored = int(np.triu(first | rest).sum())
    return PrunedNeighbours(top.select(F.col("token").cast(kind).alias("token"), "rank", F.col("neighbour").cast(kind).alias("neighbour"), "sim"), pairs, pairs - scored)


def block_bounds(centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each two blocks a score that none of their pairs passes after rounding."""
    apart = np.arccos(np.clip(centres @ centres.T, -1, 1)) - radius[:, None] - radius[None, :] - SLACK
    return np.cos(np.clip(apart, 0, np.pi)) + 10.0**-DIGITS


def _nearest(sent: Broadcast) -> Callable:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            score = unit_rows(batch.column("embedding")) @ centres.T
            pivot = score.argmax(axis=1)
            angle = np.arccos(np.clip(score[np.arange(len(pivot)), pivot], -1, 1)) + SLACK
            yield pa.RecordBatch.from_arrays([batch.column("token"), batch.column("embedding"), pa.array(pivot.astype(np.int32)), pa.array(angle)],
                                             ["token", "embedding", "pivot", "angle"])

    return place


def _scored(blocks: DataFrame, wanted: np.ndarray, k: int) -> DataFrame:
    """Each token's best ``k`` in every pair of blocks that ``wanted`` flags, both ways."""
    low, high = (x.astype(np.int32) for x in np.nonzero(np.triu(wanted)))
    two = low != high
    pairs = blocks.sparkSession.createDataFrame(pa.table(
        {"block": np.concatenate([low, high[two]]), "low": np.concatenate([low, low[two]]), "high": np.concatenate([high, high[two]])}))
    meet = blocks.join(pairs, "block").select("low", "high", "token", "embedding", "block")
    return meet.groupBy("low", "high").applyInArrow(_cell_kernel(k), _PARTIAL)


def _cell_kernel(k: int) -> Callable[[pa.Table], pa.Table]:
    def score(cell: pa.Table) -> pa.Table:
        return score_cell(cell, k)

    return score
