"""Hard-negative mining: for every anchor and each of its nearest positives, the negatives that score just below the positive.

Vectors are whole numbers and scores are exact. Anchors and candidates are laid out in tiles; a tile pair is multiplied by
Strassen's recursion, and what leaves a tile pair are heaps of a few rows per anchor, which merge into one another.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.llm.common import table
from vecloom.session import ship_package, write_table

#: Positives of an anchor, and negatives of an anchor and a positive.
POSITIVES, NEGATIVES = 5, 5
#: A negative scores at least ``LOW / HIGH`` of the positive, and at most as much.
LOW, HIGH = 80, 100
#: Rows of a tile of anchors and of a block of candidates; what is multiplied at once; where the recursion ends.
ANCHORS, CANDIDATES, AT_ONCE, LEAF = 2048, 16384, (128, 4096), 32
#: Candidates for which another block is worth a task, while there are fewer blocks than tasks at work.
LEAST_CANDIDATES = 1024
#: Fixed values of the registered query: components are multiplied by this and rounded down.
SCALE = 256
#: Scores must lie below this, so that 64 bits hold what is computed of them.
SCORE_LIMIT = 1 << 60

_FOUND = "anchor long, slot int, id long, row long, score long"
_NO_SCORE = np.iinfo(np.int64).min


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` in whole numbers: seven products of half the size in place of eight, with zeros where a side is odd.

    Sums inside may pass 64 bits; they wrap around, and what they cancel out to is right whenever the result fits.
    """
    (m, k), n = a.shape, len(b)
    if min(m, k, n) <= LEAF:
        return a @ b.T
    if m % 2 or k % 2 or n % 2:
        return product(np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, n % 2), (0, k % 2))))[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:n, :k], b[n:, :k], b[:n, k:], b[n:, k:]  # of b.T, whose rows are columns here
    diagonal = product(a11 + a22, b11 + b22)
    lower, upper = product(a21 + a22, b11), product(a11 + a12, b22)
    right, left = product(a11, b12 - b22), product(a22, b21 - b11)
    found = np.empty((2 * m, 2 * n), np.int64)
    found[:m, :n] = diagonal + left - upper + product(a12 - a22, b21 + b22)
    found[:m, n:] = right + upper
    found[m:, :n] = lower + left
    found[m:, n:] = diagonal - lower + right + product(a21 - a11, b11 + b12)
    return found


class Heaps:
    """For each of some heaps the best ``k`` candidates so far, the highest score first and the smaller candidate at ties.

    Candidates are numbers that must be offered in ascending order from one call to the next.
    """

    def __init__(self, heaps: int, k: int) -> None:
        self.k = k
        self.heap, self.score, self.candidate = (np.zeros(0, np.int64) for _ in range(3))
        #: A score that a candidate must pass to enter a heap.
        self.least = np.full(heaps, _NO_SCORE)

    def offer(self, heap: np.ndarray, score: np.ndarray, candidate: np.ndarray) -> None:
        better = score > self.least[heap]
        heap, score, candidate = (np.concatenate([old, new[better]]) for old, new in
                                  ((self.heap, heap), (self.score, score), (self.candidate, candidate)))
        order = np.lexsort((candidate, -score, heap))
        heap = heap[order]
        heads = np.flatnonzero(np.diff(heap, prepend=-1))
        place = np.arange(len(heap)) - np.repeat(heads, np.diff(np.append(heads, len(heap))))
        keep = place < self.k
        self.heap, self.score, self.candidate = heap[keep], score[order][keep], candidate[order][keep]
        full = place[keep] == self.k - 1
        self.least[self.heap[full]] = self.score[full]


def _side(rows: pa.Table, width: int, order: np.ndarray) -> np.ndarray:
    """Vectors as matrix rows; a shorter one ends in zeros."""
    lists = rows["vector"].combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    matrix = np.zeros((len(sizes), width), np.int64)
    ends = np.cumsum(sizes)
    matrix[np.repeat(np.arange(len(sizes)), sizes), np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
    return matrix[order]


def _tiles(anchors: pa.Table, candidates: pa.Table):
    """For each part of a tile pair: anchor places, candidate places, scores, and which of them share the label."""
    names, rows = candidates["id"].to_numpy(), candidates["row"].to_numpy()
    order = np.lexsort((rows, names))  # so a smaller place is a smaller id
    width = max(int(t["vector"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max()) for t in (anchors, candidates))
    a, b = _side(anchors, width, np.arange(anchors.num_rows)), _side(candidates, width, order)
    here, there = anchors["label"].to_numpy(), candidates["label"].to_numpy()[order]
    tall, wide = AT_ONCE
    for i in range(0, len(a), tall):
        for j in range(0, len(b), wide):
            yield i, j, product(a[i:i + tall], b[j:j + wide]), here[i:i + tall, None] == there[j:j + wide], order


def _leave(heaps: Heaps, anchors: pa.Table, candidates: pa.Table, order: np.ndarray, slots: int) -> pa.Table:
    at = order[heaps.candidate] if len(order) else heaps.candidate
    return pa.table({"anchor": anchors["row"].to_numpy()[heaps.heap // slots], "slot": (heaps.heap % slots).astype(np.int32),
                     "id": candidates["id"].to_numpy()[at], "row": candidates["row"].to_numpy()[at], "score": heaps.score})


def _nothing() -> pa.Table:
    return pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())]).empty_table()


def tile_positives(anchors: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The best ``k`` candidates of its own label for each anchor of a tile, itself apart."""
    if not anchors.num_rows or not candidates.num_rows:
        return _nothing()
    heaps, order = Heaps(anchors.num_rows, k), np.zeros(0, np.int64)
    own, rows = anchors["row"].to_numpy(), candidates["row"].to_numpy()
    for i, j, score, same, order in _tiles(anchors, candidates):
        open_ = same & (score > heaps.least[i:i + len(score), None]) & (own[i:i + len(score), None] != rows[order[j:j + score.shape[1]]])
        heap, column = np.nonzero(open_)
        heaps.offer(heap + i, score[heap, column], column + j)
    return _leave(heaps, anchors, candidates, order, 1)


def tile_negatives(anchors: pa.Table, candidates: pa.Table, k: int, slots: int) -> pa.Table:
    """The best ``k`` candidates of another label in the window under each positive of each anchor of a tile.

    ``scores`` of an anchor holds those of its positives, at most ``slots``, which number the windows.
    """
    if not anchors.num_rows or not candidates.num_rows:
        return _nothing()
    heaps, order = Heaps(anchors.num_rows * slots, k), np.zeros(0, np.int64)
    # a window nothing lies in, where an anchor has fewer positives
    top, bottom = np.full((anchors.num_rows, slots), _NO_SCORE), np.full((anchors.num_rows, slots), SCORE_LIMIT)
    for row, scores in enumerate(anchors["scores"].to_pylist()):
        top[row, :len(scores)], bottom[row, :len(scores)] = scores, [-(-LOW * s // HIGH) for s in scores]
    for i, j, score, same, order in _tiles(anchors, candidates):
        some = slice(i, i + len(score))
        heap, column = np.nonzero(~same & (score <= top[some].max(axis=1)[:, None]) & (score >= bottom[some].min(axis=1)[:, None]))
        found = score[heap, column]
        for slot in range(slots):
            inside = (found <= top[some][heap, slot]) & (found >= bottom[some][heap, slot])
            heaps.offer((heap[inside] + i) * slots + slot, found[inside], column[inside] + j)
    return _leave(heaps, anchors, candidates, order, slots)


def whole_vectors(rows: DataFrame, key: str, label: str | Column, vector: str, scale: int = SCALE) -> DataFrame:
    """``(id, label, vector)`` with components ``floor(scale * x)``, of the rows whose label and components are all there and finite."""
    x = F.col(vector)
    named = rows.select(F.col(key).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                        F.transform(x, lambda e: e.cast("double")).alias("vector"))
    bad = F.exists("vector", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    fine = named.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    complaint = F.raise_error(F.lit("a component too large for whole numbers of 64 bits")).cast("bigint")
    whole = F.transform("vector", lambda e: F.when(F.abs(e) * scale < float(SCORE_LIMIT), F.floor(e * scale).cast("bigint")).otherwise(complaint))
    return fine.withColumn("vector", whole)


def mine_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` from ``rows (id, label, vector)`` of whole numbers.

    Scores are inner products; higher ones come first, ties by the smaller id. An anchor's positives are its first
    ``positives`` other rows of its label; a positive's negatives are the first ``negatives`` rows of other labels that score
    from ``LOW / HIGH`` of the positive's score up to it. Fewer, if there are no more; an anchor without a positive, or a
    positive without a negative, has no row. Rows without an id take no part. Rows of one id are rows of their own: each
    may be an anchor, and the positive or negative of the others. A shorter vector counts as one that ends in zeros.
    Vectors that could score beyond 2^60 fail the job. Other columns do not matter. An empty table gives an empty table.

    Every anchor meets every row: that is what is asked. Tiles of anchors meet blocks of candidates of bounded size,
    whatever a label holds, and a few rows per anchor leave each. First pass: positives; second pass: windows under them.
    """
    spark = rows.sparkSession
    ship_package(spark)
    # numbers given once and written, so that both passes know a row by the same number
    held = write_table(rows.where("id IS NOT NULL").select("id", "label", "vector", is_anchor.alias("_anchor"), F.monotonically_increasing_id().alias("row")), "vectors")
    biggest = F.array_max(F.transform("vector", lambda e: F.abs(e)))
    count, asked, largest, width = held.agg(F.count(F.lit(1)), F.count(F.when(F.col("_anchor"), 1)), F.max(biggest), F.max(F.size("vector"))).first()
    if (largest or 0) ** 2 * max(width or 0, 1) >= SCORE_LIMIT:
        raise ValueError("vectors whose scores may not fit whole numbers of 64 bits")
    tiles = max(1, math.ceil(asked / ANCHORS))
    blocks = max(1, math.ceil(count / CANDIDATES), min(2 * spark.sparkContext.defaultParallelism, math.ceil(count / LEAST_CANDIDATES)))
    dealt = F.xxhash64("row")
    columns = [F.pmod(dealt, F.lit(tiles)).cast("int").alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")]
    anchors = held.where("_anchor")
    candidates = held.select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"),
                             "row", "id", "label", "vector").groupBy("tile", "block")

    def positives_of(tile: pa.Table, block: pa.Table) -> pa.Table:
        return tile_positives(tile, block, positives)

    def negatives_of(tile: pa.Table, block: pa.Table) -> pa.Table:
        return tile_negatives(tile, block, negatives, positives)

    pairs = anchors.select(*columns, "row", "label", "vector").groupBy("tile", "block").cogroup(candidates).applyInArrow(positives_of, _FOUND)
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    first = write_table(pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives).select(
        "anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    listed = first.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))).alias("_p")).select(
        F.col("anchor").alias("row"), F.col("_p.positive_score").alias("scores"))
    asking = write_table(anchors.select("row", "label", "vector").join(listed, "row"), "windows")
    pairs = asking.select(*columns, "row", "label", "vector", "scores").groupBy("tile", "block").cogroup(candidates).applyInArrow(negatives_of, _FOUND)
    last = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives).select(
        "anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return last.join(first, ["anchor", "slot"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(whole_vectors(rows, "vec_id", moved, "embedding"), F.col("id") % 100 == 0)


OP13_SQL = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
           FROM rows a JOIN rows b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) <= 5"""
