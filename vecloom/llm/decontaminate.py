"""Benchmark decontamination: windows of benchmark words found in documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecloom.llm.common import covered, flat, freed, owner, set_aside, slices, table, words_of
from vecloom.operators.ordinal import with_offset
from vecloom.session import ship_package, write_table

#: Words of a window; an item of fewer words is one window.
WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
HIT_SHARE = 20
#: Benchmark text, with the ids of its items, that goes to every worker at once as an index of about ten times the size. A
#: larger benchmark takes one more pass over the documents for each block more.
BLOCK_BYTES = 8 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier

RESULT = "n_words long, n_hit long, item_ids array<string>, hits binary"


def item_words(texts: pa.Array):
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    data, offsets = flat(texts)
    return words_of(_FOLD[data], offsets, _INSIDE)


def _roll(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    total = np.zeros(len(at), np.uint64)
    for j in range(length):
        total = total * _STEP + ids[at + j].astype(np.uint64) + np.uint64(1)
    return total


class Windows:
    """The windows of benchmark items: a hash set by window length, and the words themselves to verify hits."""

    def __init__(self, names: list[list[str]], texts: list[str], window: int) -> None:
        self.names = names  # of each distinct text, the items that have it
        words = item_words(pa.array(texts, pa.string()))
        coded = words.values.dictionary_encode()
        self.vocabulary = coded.dictionary
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        counts = words.counts()
        lengths = np.minimum(counts, window)
        self.tables = []
        for length in sorted(set(lengths[lengths > 0].tolist())):
            items = np.flatnonzero(lengths == length)
            many = counts[items] - length + 1
            at = np.concatenate([np.arange(a, a + m) for a, m in zip(words.first[items], many)])
            rows = ids[at[:, None] + np.arange(length)]
            hashes = _roll(ids, at, length)
            order = np.argsort(hashes, kind="stable")
            self.tables.append((length, hashes[order], rows[order], np.repeat(items, many)[order]))

    def hits(self, ids: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(word numbers, window length, items) of verified hits. ``ids`` is -1 for words no item has; ``stop`` ends each word's text."""
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        for length, hashes, rows, items in self.tables:
            if len(ids) < length:
                continue
            at = np.flatnonzero(known[length:] - known[:-length] == length)
            at = at[at + length <= stop[at]]
            found = _roll(ids, at, length)
            low, high = (np.searchsorted(hashes, found, side) for side in ("left", "right"))
            while (open_ := low < high).any():
                at, low, high = at[open_], low[open_], high[open_]
                same = (ids[at[:, None] + np.arange(length)] == rows[low]).all(axis=1)
                yield at[same], length, items[low[same]]
                low = low + 1


def _scan(sent: Broadcast, first: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = item_words(part.column("text"))
                ids = pc.fill_null(pc.index_in(words.values, value_set=windows.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                text = owner(words.first)
                starts, stops, pairs = [], [], [np.zeros((0, 2), np.int64)]
                for at, length, items in windows.hits(ids, words.first[1:][text]):
                    starts.append(at)
                    stops.append(at + length)
                    pairs.append(np.stack([text[at], items], axis=1))
                none = np.zeros(0, np.int64)
                hit = covered(np.concatenate([none, *starts]), np.concatenate([none, *stops]), len(ids))
                names: list[list[str]] = [[] for _ in range(part.num_rows)]
                for document, item in np.unique(np.concatenate(pairs), axis=0).tolist():
                    names[document] += windows.names[item]
                bounds = words.first
                bits = [np.packbits(hit[a:b]) if any_ else None
                        for a, b, any_ in zip(bounds[:-1].tolist(), bounds[1:].tolist(), names)]
                if not first:  # join what earlier blocks have found
                    for i, (items, earlier) in enumerate(zip(part.column("item_ids").to_pylist(), part.column("hits").to_pylist())):
                        names[i] += items
                        if earlier:
                            old = np.frombuffer(earlier, np.uint8)
                            bits[i] = old if bits[i] is None else old | bits[i]
                n_hit = [0 if b is None else int(np.bitwise_count(b).sum()) for b in bits]
                made = [pa.array(words.counts()), pa.array(n_hit, pa.int64()), pa.array([sorted(set(x)) for x in names], pa.list_(pa.string())),
                        pa.array([b"" if b is None else b.tobytes() for b in bits], pa.binary())]
                kept = [c for c in part.schema.names if c not in _MADE]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], [*kept, *_MADE])

    return scan


_MADE = ("n_words", "n_hit", "item_ids", "hits")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any window), ``item_ids`` (sorted as strings) and ``hits`` (a bit per word).

    The windows of ``benchmark(item_id, text)`` are indexed on the driver and broadcast, in blocks of at most ``block_bytes``
    of distinct texts and the ids of their items (one longer text is a block); items of equal text are one. Every block more
    is one more pass over the documents, written between the passes, so a worker holds one index at a time. No pass shuffles.
    Hash hits are verified word by word. Null texts have no words; items without words have no windows; an item without
    an id is called "". Columns of ``docs`` named like the new ones are replaced. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    ship_package(spark)
    named = benchmark.where(F.coalesce("text", F.lit("")) != "").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text")
    distinct = named.groupBy("text").agg(F.array_sort(F.collect_set("name")).alias("names"))
    weight = F.octet_length("text") + F.aggregate("names", F.lit(0).cast("bigint"), lambda total, name: total + F.octet_length(name) + 8)
    items = write_table(distinct.withColumn("size", weight.cast("bigint")), "benchmark-items")
    total, longest = items.agg(F.sum("size"), F.max("size")).first()
    if (total or 0) <= block_bytes:
        dealt, blocks = items.withColumn("block", F.lit(0)), 1
    else:  # by running sizes, so that no block is more than one text too large; a text that would not fit begins the next
        room = max(1, block_bytes - min(longest, block_bytes // 2))
        dealt = write_table(with_offset(items, ["text"], F.col("size")).withColumn("block", F.call_function("div", F.col("offset"), F.lit(room).cast("bigint"))), "benchmark-blocks")
        blocks = dealt.agg(F.max("block")).first()[0] + 1
    result = docs.drop(*_MADE)
    wanted = StructType([*result.schema.fields, *spark.createDataFrame([], RESULT).schema.fields])
    for number in range(blocks):  # grows with the benchmark only
        rows = dealt.where(F.col("block") == number).select("names", "text").collect()
        sent = spark.sparkContext.broadcast(Windows([r["names"] for r in rows], [r["text"] for r in rows], window))
        found = result.mapInArrow(freed(_scan(sent, number == 0)), wanted)
        result = found if number == blocks - 1 else write_table(found, "hits")
    return result


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` of whose words less than one in twenty lies in a benchmark window, with their columns."""
    aside, back = set_aside(docs, _MADE)
    return benchmark_hits(aside, benchmark).where(~contaminated()).drop(*_MADE).withColumnsRenamed(back).select(*docs.columns)


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = benchmark_hits(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


OP6_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
  UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), text FROM benchmark),
words AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
sizes AS (SELECT DISTINCT least(len(w), 13) AS size FROM words WHERE kind = 'b' AND len(w) > 0),
items AS (
  SELECT id AS item, least(len(w), 13) AS size, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: list_slice(w, i, i + least(len(w), 13) - 1))) AS win
  FROM words WHERE kind = 'b' AND len(w) > 0),
places AS (SELECT id, len(w) AS n, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM words, sizes WHERE kind = 'd' AND len(w) >= size),
found AS (
  SELECT p.id, p.pos, p.size, i.item FROM (SELECT id, pos, size, list_slice(w, pos, pos + size - 1) AS win FROM places) p
  JOIN items i ON p.size = i.size AND p.win = i.win),
hit AS (SELECT id, count(DISTINCT h) AS n_hit FROM (SELECT id, unnest(range(pos, pos + size)) AS h FROM found) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN hit h ON w.id = h.id LEFT JOIN named n ON w.id = n.id WHERE w.kind = 'd'"""
