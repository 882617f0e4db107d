"""Mixing sources to target weights: nested thresholds on a hash of each document, found by histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.llm.common import table
from vecloom.llm.components import join_counted
from vecloom.operators.ordinal import running_offsets
from vecloom.session import write_table

#: Weights of the sources in their order, repeating; the mix's share of all sizes; how often a document may be taken.
CYCLE, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Bits of the hash, and how many of them one histogram resolves. A histogram has 2 ^ STEP_BITS buckets per source.
HASH_BITS, STEP_BITS = 60, 6
#: A boundary bucket of at most so many documents is walked in the order of the hash.
WALKED = 512
#: The plan of up to so many sources, with at most ``WALKED`` hashes each, is broadcast.
MOST_SOURCES_TO_BROADCAST = 5_000
#: Fixed value: what draws the hash of a document besides the document.
SEED = 17

_MADE = ("size", "source_size", "target", "copies")


def words_in(text: Column) -> Column:
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``size``, ``_key`` (the source in an order with null last) and ``_hash`` (of seed, id and text, from 0)."""
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source").cast("string")))
    spread = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 64 - HASH_BITS)
    return docs.drop(*_MADE).withColumns({"size": words_in(F.col("text")), "_key": key, "_hash": spread})


def source_targets(rows: DataFrame, cycle: Sequence[float] = CYCLE, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(_key, source_size, n, target)`` from ``(_key, size)``: what each source should bring to the mix.

    The sources in the order of ``_key`` weigh as ``cycle`` says, and share ``share`` times all sizes. No target passes
    ``most`` times its source's size; what it would have beyond that is shared by weight among the others, until none is
    above. So there is one level, and a target is its weight times the level, or its limit. The level is found by a few
    aggregates over the table of sources; two numbers of each reach the driver.
    """
    sizes = write_table(rows.groupBy("_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sources")
    turn = F.get(F.array(*[F.lit(float(w)) for w in cycle]), F.pmod("offset", F.lit(len(cycle))).cast("int"))
    weighed = write_table(sizes.join(running_offsets(sizes, ["_key"]), "_key").withColumn("_weight", turn).drop("offset"), "weights")
    limit = most * F.col("source_size")
    budget = share * float(sizes.agg(F.sum("source_size")).first()[0] or 0)
    level, bound = 0.0, -1
    while True:
        full = limit <= F.col("_weight") * F.lit(level)
        held, free, now = weighed.agg(F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(~full, F.col("_weight")).otherwise(0.0)),
                                      F.count(F.when(full, 1))).first()
        if now == bound or not free:
            break
        level, bound = max(level, (budget - float(held)) / free), now
    return weighed.withColumn("target", F.least(limit.cast("double"), F.when(full, limit).otherwise(F.col("_weight") * F.lit(level)))).drop("_weight")


def mix_plan(rows: DataFrame, cycle: Sequence[float] = CYCLE, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(_key, source_size, n, target, base, below, chosen)`` from a written table ``(_key, _hash, size)``.

    Each document of a source is taken ``base`` times, and once more if its hash is less than ``below`` or in ``chosen``.
    A larger target has a larger threshold, so mixes nest. The threshold is found without sorting documents: a histogram
    of sizes by source and leading hash bits shows the bucket in which the budget ends, the next histogram reads the rows
    of that bucket alone, and so on, until a bucket has at most ``WALKED`` documents. Those are walked in the order of their
    hashes, and each is taken that still fits. Documents of one hash, as equal rows have it, are taken together or not.
    """
    target, size = F.floor(F.col("target") + 0.5), F.col("source_size")
    base = F.when(size > 0, F.least(F.floor(target / size), F.lit(most))).otherwise(0).cast("long")
    plan = write_table(source_targets(rows, cycle, share, most).withColumn("base", base).withColumn(
        "_left", F.greatest(F.least(target, most * size) - F.col("base") * size, F.lit(0)).cast("long")), "targets")
    inside, ends, shift = rows, [], HASH_BITS
    open_ = plan.where("_left > 0").select("_key", "n", F.lit(0).cast("long").alias("below"), "_left")
    while True:
        walked = open_ if shift < STEP_BITS else open_.where(F.col("n") <= WALKED)
        ends.append(_walked(_with_plan(inside, walked), walked))
        if shift < STEP_BITS or not (open_ := open_.where(F.col("n") > WALKED)).head(1):
            break
        shift -= STEP_BITS
        held = _with_plan(inside, open_).withColumn("_bucket", F.shiftright("_hash", shift))
        bins = held.groupBy("_key", "_bucket").agg(F.sum("size").alias("_size"), F.count(F.lit(1)).alias("n"))
        # at most 2 ^ STEP_BITS rows of a source meet in this window
        before = F.sum("_size").over(Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_size")
        edge = bins.withColumn("_before", before).join(open_.select("_key", "_left"), "_key").where("_before <= _left AND _left < _before + _size")
        open_ = write_table(edge.select("_key", "n", F.shiftleft("_bucket", shift).alias("below"), (F.col("_left") - F.col("_before")).alias("_left"), "_bucket"), "edges")
        inside = write_table(_with_plan(inside, open_.select("_key", "n", "_bucket")).where(
            F.shiftright("_hash", shift) == F.col("_bucket")).select("_key", "_hash", "size"), "edge-rows")
        open_ = open_.drop("_bucket")
    found = ends[0]
    for more in ends[1:]:
        found = found.unionByName(more)
    whole = plan.drop("_left").join(found, "_key", "left")
    return write_table(whole.withColumn("below", F.coalesce("below", F.lit(0).cast("long"))), "mix")


def _walked(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``(_key, below, chosen)``: of the few rows of each source's last bucket those that fit, one after another, and the
    smallest of the others too if the budget is missed by less with it."""
    units = rows.groupBy("_key", "_hash").agg(F.sum("size").alias("_size"))
    listed = units.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_hash", "_size"))).alias("_units"))
    none = F.struct(F.lit(None).cast("long").alias("_size"), F.lit(None).cast("long").alias("_hash"))
    start = F.struct(F.col("_left").alias("left"), F.array().cast("array<bigint>").alias("chosen"), none.alias("spare"))

    def step(held: Column, unit: Column) -> Column:
        taken = F.struct((held["left"] - unit["_size"]).alias("left"), F.concat(held["chosen"], F.array(unit["_hash"])).alias("chosen"), held["spare"].alias("spare"))
        smaller = F.coalesce(unit["_size"] < held["spare"]["_size"], F.lit(True))
        spare = F.when(smaller, F.struct(unit["_size"].alias("_size"), unit["_hash"].alias("_hash"))).otherwise(held["spare"])
        return F.when(unit["_size"] <= held["left"], taken).otherwise(F.struct(held["left"].alias("left"), held["chosen"].alias("chosen"), spare.alias("spare")))

    walked = sources.join(listed, "_key").select("_key", "below", F.aggregate("_units", start, step).alias("_w"))
    nearer = F.col("_w.spare._size") - F.col("_w.left") < F.col("_w.left")
    chosen = F.when(nearer, F.concat("_w.chosen", F.array("_w.spare._hash"))).otherwise(F.col("_w.chosen"))
    return walked.select("_key", "below", chosen.alias("chosen"))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with the columns of its source in ``plan``, which counts rows in ``n``. Few sources go to the rows by a
    broadcast; of many, the hot ones do and the others meet their rows in a shuffle."""
    if plan.limit(MOST_SOURCES_TO_BROADCAST + 1).count() <= MOST_SOURCES_TO_BROADCAST:
        return rows.join(F.broadcast(plan.drop("n")), "_key")
    return join_counted(rows, plan, "_key")


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    once_more = (F.col("_hash") < F.col("below")) | F.coalesce(F.array_contains("chosen", F.col("_hash")), F.lit(False))
    return _with_plan(rows, plan).withColumn("copies", F.col("base") + once_more.cast("long"))


def mix_sources(docs: DataFrame, cycle: Sequence[float] = CYCLE, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``docs (doc_id, text, source, ...)`` with ``size`` (words), ``source_size``, ``target`` and ``copies``: how often the mix takes a row.

    Sources by code point, null last, weigh as ``cycle`` says; see :func:`source_targets` and :func:`mix_plan`. Each
    source's taken words come within a small document of its target. No row is taken more than ``most`` times. Null and
    empty texts have size 0; they follow their source's threshold as others do and add no words. Rows equal in id and
    text are taken alike. A source without words has the target 0. Columns of ``docs`` named like the new ones are
    replaced. An empty table gives an empty table. The draw is a hash of the row, so a lost task or a rerun takes the same.
    """
    plan = mix_plan(write_table(measured(docs, seed).select("_key", "_hash", "size"), "sizes"), cycle, share, most)
    kept = [c for c in docs.columns if c not in _MADE]
    return _taken(measured(docs, seed), plan).select(*kept, *_MADE)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as the mix of :func:`mix_sources` has them: each as often as it is taken, with its columns."""
    found = mix_sources(docs, **settings).where("copies > 0")
    kept = [c for c in docs.columns if c not in _MADE]
    return found.select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))


def op11_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "source", "text")
    rows = write_table(measured(docs).select("doc_id", "_key", "_hash", "size"), "sizes")  # the text is read once
    return _taken(rows, mix_plan(rows)).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
