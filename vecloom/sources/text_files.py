"""Text files as tables of lines, in an order that does not depend on how Spark splits them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.operators.ordinal import running_offsets
from vecloom.session import write_table

#: A table of file splits up to this size is broadcast; a larger one is joined by a shuffle.
MOST_BYTES_TO_BROADCAST = 64 << 20


def corpus_lines(spark: SparkSession, paths: str | Sequence[str], name_glob: str | None = None) -> DataFrame:
    """``(file, block, seq, line)`` for every line of every file; a missing path is an error.

    ``(file, block, seq)`` sorts as the lines stand, files by name: ``block`` is the byte where the file
    split starts and ``seq`` rises inside it. ``name_glob`` keeps files by name, as ``part-*``.
    """
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"))


def numbered_corpus(spark: SparkSession, paths: str | Sequence[str], name_glob: str | None = None) -> DataFrame:
    """``(line_no, line)``: number all lines from 0, through the files in name order, without moving or copying the text.

    A first scan counts the lines of each file split; splits get their starts by :func:`running_offsets`. The second
    scan adds the place inside the split. Starts are joined by broadcast up to ``MOST_BYTES_TO_BROADCAST``, beyond that
    by a hash join. If the second scan cuts or orders the files otherwise than the first, some line falls out of its
    split's range, which fails the job, so numbers are never wrong in silence.
    """
    lines = corpus_lines(spark, paths, name_glob)
    blocks = write_table(lines.groupBy("file", "block").agg(F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_n")), "splits")
    starts = blocks.join(running_offsets(blocks, ["file", "block"], F.col("_n")), ["file", "block"])
    sizes = blocks.agg(F.count(F.lit(1)), F.sum(F.octet_length("file"))).first()
    if (sizes[1] or 0) + 64 * sizes[0] <= MOST_BYTES_TO_BROADCAST:
        starts = F.broadcast(starts)
    else:
        starts = starts.hint("shuffle_hash")
    place = F.col("seq") - F.col("_first")
    lost = F.raise_error(F.lit("the files were cut otherwise in the second scan; run again")).cast("bigint")
    number = F.when((place >= 0) & (place < F.col("_n")), F.col("offset") + place).otherwise(lost)
    return lines.join(starts, ["file", "block"], "left").select(number.alias("line_no"), "line")
