"""Source divergence audit: which words set the sources of a language apart, and by how much.

Words are found as pointers to their first bytes in the Arrow text buffers. The pointers of a slice of text are sorted by
what they point to, by a multikey quicksort whose characters are eight bytes wide; a run of equal words then gives its
counts by source and its document frequency at once. All later steps work on counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.llm.common import binaries, flat, freed, slices, table, words_of
from vecloom.session import ship_package, write_table

#: A term stays if at least so many documents of its language have it.
LEAST_DOCUMENTS = 30
#: What every count is raised by, and what the shares of a group add up to.
SMOOTHING, UNIT = 5, 1_000_000_000
#: Ranks of the report of terms.
MOST_TERMS = 50
#: Text whose pointers are sorted at once. One longer text is a slice by itself.
SHARD_BYTES = 8 << 20
#: Sources of one side of a tile, counts behind one shard of the terms, and terms laid out as a matrix at once.
TILE_SOURCES, SHARD_CELLS, COLUMNS = 256, 100_000, 4096
#: A table of groups of up to so many bytes is broadcast.
GROUP_BYTES = 64 << 20

COUNTED = "lang string, source string, term string, n long, documents long"
_DISTANCES = "lang string, a long, b long, value long"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True


def sort_pointers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers ``start`` in the order of the words ``data[start:end]``, and a flag for the first of each run of equal words.

    Words hold no zero byte, so a word that ends inside an eight-byte character is padded with zeros and sorts before all
    that go on. Each level sorts the groups that agree so far, and are not yet told apart, by their next character.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    characters = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))

    def character(pointers: np.ndarray, level: int) -> np.ndarray:
        left = end[pointers] - start[pointers] - 8 * level
        cut = np.uint64(8) * (np.uint64(8) - np.clip(left, 0, 8).astype(np.uint64))
        found = characters[np.minimum(start[pointers] + 8 * level, len(data))].astype(np.uint64)
        return np.where(left > 0, (found >> np.minimum(cut, np.uint64(63))) << np.minimum(cut, np.uint64(63)), np.uint64(0))

    everyone = np.arange(len(start))
    first = character(everyone, 0)
    order = np.argsort(first)
    first = first[order]
    head = np.ones(len(order), bool)
    head[1:] = first[1:] != first[:-1]
    level, places = 1, np.arange(len(order))
    while True:
        group = np.cumsum(head[places]) if len(places) else places  # places of one group lie together
        sizes = np.bincount(group)
        going = (sizes[group] > 1) & (end[order[places]] - start[order[places]] > 8 * level)
        # a whole group goes on if any of its words does: those that end here sort first
        alive = np.bincount(group, weights=going, minlength=len(sizes)) > 0
        places, group = places[alive[group]], group[alive[group]]
        if not len(places):
            return order, head
        now = character(order[places], level)
        inner = np.lexsort((now, group))
        order[places] = order[places][inner]
        now, same = now[inner], group[1:] == group[:-1]
        head[places[1:]] |= ~same | (now[1:] != now[:-1])
        level += 1


def count_slice(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Rows of ``COUNTED`` for some documents; one with an empty term for each language and source among them."""
    data, offsets = flat(texts)
    data = _FOLD[data]
    words = words_of(data, offsets, _INSIDE)
    start, end = words.start, words.end
    names = pa.StructArray.from_arrays([langs, sources], ["lang", "source"])
    pairs: dict[tuple, int] = {}
    group = np.fromiter((pairs.setdefault((x["lang"], x["source"]), len(pairs)) for x in names.to_pylist()), np.int64, len(names))
    by_group = np.argsort(group, kind="stable")  # documents of one group get numbers in a row
    number = np.empty(len(group), np.int64)
    number[by_group] = np.arange(len(group))

    order, head = sort_pointers(data, start, end)
    run = np.cumsum(head) - 1
    document = number[np.repeat(np.arange(len(group)), words.counts())][order]
    codes = np.sort(run * len(group) + document)
    once = np.flatnonzero(np.diff(codes, prepend=-1))  # a word in a document
    run, document = codes[once] // max(len(group), 1), codes[once] % max(len(group), 1)
    cell = run * len(pairs) + group[by_group][document]
    heads = np.flatnonzero(np.diff(cell, prepend=-1))  # a word in a group
    times = np.diff(np.append(once[heads], len(codes)))
    documents = np.diff(np.append(heads, len(cell)))

    first = order[head]
    sizes = end[first] - start[first]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    spread = np.repeat(start[first] - ends[:-1], sizes) + np.arange(ends[-1])
    terms = binaries(data[spread], ends).cast(pa.binary()).cast(pa.string())
    which = np.concatenate([cell[heads] % max(len(pairs), 1), np.arange(len(pairs))])
    blank = pa.array([""] * len(pairs), pa.string())
    none = np.zeros(len(pairs), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in pairs], pa.string()).take(pa.array(which)), pa.array([x for _, x in pairs], pa.string()).take(pa.array(which)),
         pa.concat_arrays([terms.take(pa.array(run[heads])), blank]), pa.array(np.concatenate([times, none])),
         pa.array(np.concatenate([documents, none]))], ["lang", "source", "term", "n", "documents"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SHARD_BYTES):
            yield count_slice(part.column("lang"), part.column("source"), part.column("text"))


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(lang, source, term, n, lang_n, first)``: how often each group and language has each kept term, written as a table.

    A group with no kept term has a row with the empty term, as every other group has. ``first`` marks one row per term
    of a language. Counts are added up inside each task, then by language, source and term, so a frequent word is one row
    per task. A document belongs to one source, so document frequencies add up over the sources.
    """
    ship_package(docs.sparkSession)
    name = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counted = docs.select(*name).mapInArrow(freed(_count), COUNTED).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    over = Window.partitionBy("lang", "term")
    wide = counted.select("*", F.sum("documents").over(over).alias("_df"), F.sum("n").over(over).alias("lang_n"),
                          (F.min("source").over(over) == F.col("source")).alias("first"))
    kept = wide.where((F.col("_df") >= least) | (F.col("term") == "")).select("lang", "source", "term", "n", "lang_n", "first")
    return write_table(kept, "terms")


def share_of(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a term, of ``UNIT``, in whole numbers of 38 digits."""
    wide = [x.cast("decimal(20,0)") for x in (count + F.lit(SMOOTHING), total + F.lit(SMOOTHING) * terms)]
    return F.lit(1).cast("long") + F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * wide[0], wide[1])


def _groups(counts: DataFrame) -> DataFrame:
    """``(lang, source, total, terms, lang_total, base)``: per group the occurrences of kept terms, and the share of a term it lacks."""
    real = F.col("term") != ""
    langs = counts.groupBy("lang").agg(F.count(F.when(real & F.col("first"), 1)).alias("terms"), F.sum("n").alias("lang_total"))
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang")
    none = F.lit(0).cast("long")
    return groups.withColumn("base", F.when(F.col("terms") > 0, share_of(none, F.col("total"), F.greatest("terms", F.lit(1)))).otherwise(none))


def _with_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with the columns of their group, by a broadcast if the table of groups is small and else by a shuffle."""
    held = groups.agg(F.sum(F.octet_length("lang") + F.octet_length("source") + 64)).first()[0] or 0
    return rows.join(F.broadcast(groups) if held <= GROUP_BYTES else groups, ["lang", "source"])


def tile_distances(tile: pa.Table) -> pa.Table:
    """For each pair of sources ``a < b`` of a tile, by how much their shares of the terms of one shard differ in sum, beyond
    what they would if they lacked all these terms.

    Rows without a term bring the sources themselves, their tile and the share ``p`` of the terms they lack.
    """
    low = tile["low"][0].as_py()
    source, side, p = (tile[c].to_numpy() for c in ("idx", "tile", "p"))
    bare = np.asarray(tile["term"].is_null())
    order = np.argsort(source[bare], kind="stable")
    idx, base = source[bare][order], p[bare][order]
    here, there = np.flatnonzero(side[bare][order] == low), np.flatnonzero(side[bare][order] == tile["high"][0].as_py())
    rows = np.searchsorted(idx, source[~bare])
    column = tile["term"].combine_chunks().drop_null().dictionary_encode()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    width = len(column.dictionary)
    column, p = column.indices.to_numpy(zero_copy_only=False), p[~bare]
    by_column = np.argsort(column, kind="stable")
    bounds = np.searchsorted(column[by_column], np.arange(0, width + COLUMNS, COLUMNS))
    value = -width * np.abs(base[here][:, None] - base[there])
    for block in range(-(-width // COLUMNS)):
        some = by_column[bounds[block]:bounds[block + 1]]
        matrix = np.repeat(base[:, None], min(COLUMNS, width - block * COLUMNS), axis=1)
        matrix[rows[some], column[some] - block * COLUMNS] = p[some]
        far = matrix[there]
        for i, a in enumerate(here):
            value[i] += np.abs(far - matrix[a]).sum(axis=1)
    a, b = np.repeat(idx[here], len(there)), np.tile(idx[there], len(here))
    keep = a < b if low == tile["high"][0].as_py() else np.ones(len(a), bool)
    return pa.table({"lang": pa.array([tile["lang"][0].as_py()] * int(keep.sum()), pa.string()), "a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep],
                     "value": value.ravel()[keep]})


def source_distances(scored: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, other, value)``: the distance of every two sources of a language, once for each of them.

    Sources are laid out in tiles of ``TILE_SOURCES`` and terms are dealt over shards by a hash, so a group is two tiles of
    sources and the terms of one shard, whatever a language holds. What is written per pair is one row per shard.
    """
    numbered = write_table(groups.withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1), "groups")
    tiles = numbered.groupBy("lang").agg((F.floor(F.max("idx") / TILE_SOURCES) + 1).cast("int").alias("tiles"))
    sides = numbered.join(tiles, "lang").select("lang", "source", "idx", F.floor(F.col("idx") / TILE_SOURCES).cast("int").alias("tile"), "tiles", "base", "terms")
    shards = max(1, -(-scored.count() // SHARD_CELLS))
    shard = F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int")
    mates = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(
        F.least(F.col("tile"), j).alias("low"), F.greatest(F.col("tile"), j).alias("high")))
    cells = _with_groups(scored.select("lang", "source", "term", "p"), sides.drop("base", "terms")).select(
        "lang", F.explode(mates).alias("_at"), shard.alias("shard"), "idx", "tile", "term", "p")
    bare = sides.select("lang", F.explode(mates).alias("_at"), "idx", "tile", "base").select(
        "lang", "_at", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "idx", "tile",
        F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
    flat_ = ["lang", "_at.low", "_at.high", "shard", "idx", "tile", "term", "p"]
    both = cells.select(*flat_).unionByName(bare.select(*flat_))
    partial = both.groupBy("lang", "low", "high", "shard").applyInArrow(tile_distances, _DISTANCES)
    pairs = write_table(partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "distances")
    ways = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    here = numbered.select("lang", "source", F.col("idx").alias("a"), F.col("base").alias("_base"), "terms")
    there = numbered.select("lang", F.col("source").alias("other"), F.col("idx").alias("b"), F.col("base").alias("_other_base"))
    lacking = F.col("terms") * F.abs(F.col("_base") - F.col("_other_base"))
    return ways.join(here, ["lang", "a"]).join(there, ["lang", "b"]).select("lang", "source", "other", (F.col("value") + lacking).alias("value"))


def audit_sources(docs: DataFrame, least: int = LEAST_DOCUMENTS, most: int | None = MOST_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs (lang, source, text)``; null counts as the empty string in each column.

    A language keeps the terms, words ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower case, that at least ``least`` of its
    documents have. Part ``pair`` ranks for each source the other sources of its language by the summed differences of
    their smoothed shares of all kept terms; a language without kept terms has distances of 0. Part ``term`` ranks up to
    ``most`` (all, if None) of the terms a source has and uses more than its language does. Ranks go by value, then by item
    in the order of its bytes. Sources whose texts have no terms, or are all empty, have rows of part ``pair``; a source that
    is alone in its language has none. Repeated rows count as often as they stand. Other columns do not matter. An empty
    table gives an empty table. Whole numbers throughout; a single word may be of any length.
    """
    counts = term_counts(docs, least)
    groups = write_table(_groups(counts), "groups")
    real = _with_groups(counts.where("term <> ''"), groups)
    scored = write_table(real.select("lang", "source", "term", share_of(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                                     share_of(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")), "shares")
    above = scored.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    pairs = source_distances(scored, groups).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = above.withColumn("rank", place)
    return pairs.withColumn("rank", place).unionByName(ranked if most is None else ranked.where(F.col("rank") <= most))


def op12_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_sources(table(spark, folder, "documents", "lang", "source", "text"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
words AS (SELECT row, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
langs AS (SELECT l.lang, count(k.term) AS v, CAST(coalesce(sum(k.n), 0) AS BIGINT) AS total FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k ON l.lang = k.lang GROUP BY l.lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT g.lang, g.source, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS total FROM groups g LEFT JOIN cells c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
full_ AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (t.total + 5 * l.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM totals t JOIN langs l ON t.lang = l.lang JOIN kept k ON t.lang = k.lang LEFT JOIN cells c ON t.lang = c.lang AND t.source = c.source AND k.term = c.term),
summed AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM full_ a JOIN full_ b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
           GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM groups a
          JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN summed s ON a.lang = s.lang AND a.source = s.source AND b.source = s.item),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM full_ WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50"""
