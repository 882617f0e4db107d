"""Line dedup over all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.common import set_aside, table
from vecloom.session import write_table

#: Shorter keys are never dropped; a key in this many documents is.
LEAST_CHARS = 10
#: A key with more than one in so many of all lines is hot. There are fewer hot keys than this, so they are broadcast.
HOT_SHARE = 2000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_key(docs: DataFrame) -> list[Column]:
    """What tells rows apart. All null ids are one document, after all others."""
    return [F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).alias("__doc"), F.xxhash64("text", F.octet_length("text")).alias("__text")]


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(_doc, __text, _lost)``: the places of the lines that each row of ``docs`` loses; rows that lose none are not there.

    Lines are exploded once into a table of (hash, document, place) without text. Hashes are counted with map-side
    combination; the count of distinct documents is two or more exactly if the smallest and largest differ.
    Hot hashes meet their lines by a broadcast of bounded size, all others by a shuffle.
    """
    places = docs.select(*_row_key(docs), F.posexplode(_lines(F.col("text"))).alias("pos", "__line"))
    keys = places.select("__doc", "__text", "pos", line_key(F.col("__line")).alias("__key")).where(F.char_length("__key") >= least_chars)
    hashed = write_table(keys.select(F.substring(F.unhex(F.sha2("__key", 256)), 1, 16).alias("hash"), "__doc", "__text", "pos"), "lines")
    shared = write_table(
        hashed.groupBy("hash").agg(F.min("__doc").alias("first"), F.max("__doc").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("first < last").select("hash", "first", "n"), "shared-lines")
    often = hashed.count() // HOT_SHARE
    hot = F.broadcast(shared.where(F.col("n") > often).select("hash", "first"))
    rest = shared.where(F.col("n") <= often).select("hash", "first")
    lost = hashed.join(hot, "hash").unionByName(hashed.join(rest, "hash")).where("__doc > first")
    return lost.groupBy("__doc", "__text").agg(F.collect_set("pos").alias("__lost"))


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with ``text`` less the lines that an earlier document holds, and two more columns, ``n_lines`` and ``n_dropped``.

    A key (:func:`line_key`) of ``least_chars`` code points or more that stands in two or more documents stays, with all
    its lines there, only in the document with the smallest ``doc_id``. Other lines stay in order. A null or empty text
    is one empty line and becomes the empty text. Rows with the same id are one document, and so are all rows without
    an id, which counts as the largest. A text may lose all lines and is then empty; its row stays. Columns of ``docs`` called
    like the two new ones are replaced; any other name may stand among them.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    aside, back = set_aside(docs.select(*[F.col(f"`{c}`") for c in columns]), ("__doc", "__text", "__lost"))
    lost = dropped_lines(docs, least_chars)
    both = aside.select("*", *_row_key(aside)).join(lost.hint("shuffle_hash"), ["__doc", "__text"], "left")
    lines = _lines(F.col("text"))
    whole = F.coalesce(F.col("text"), F.lit(""))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lost"))
    left = F.when(F.col("__lost").isNull(), whole).otherwise(
        F.array_join(F.transform(F.array_sort(kept), lambda i: F.get(lines, i)), "\n"))
    return both.withColumns({"text": left, "n_lines": F.size(lines).cast("long"),
                             "n_dropped": F.coalesce(F.size("__lost"), F.lit(0)).cast("long")}).drop("__doc", "__text", "__lost").withColumnsRenamed(back)


def drop_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with the ``text`` that :func:`dedup_lines` leaves, and otherwise the same columns."""
    aside, back = set_aside(docs, ("n_lines", "n_dropped"))
    return dedup_lines(aside, least_chars).drop("n_lines", "n_dropped").withColumnsRenamed(back).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(table(spark, folder, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT k.doc_id, k.pos, k.line, s.first IS NOT NULL AND k.doc_id > s.first AS lost FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
