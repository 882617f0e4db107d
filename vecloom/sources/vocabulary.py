"""The byte-pair vocabulary: as a table for lookups, as a broadcast for the tokenizer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.session import new_path

#: A rank file above this size is refused: it goes to every Python worker.
LARGEST_RANK_FILE = 64 * 2**20

#: Fixed value: how text is cut before merging, if no other pattern is given.
DEFAULT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                   r"|\s+(?!\S)|\s+")


@dataclass(frozen=True)
class Vocabulary:
    """A rank file (``base64-bytes rank`` per line) and the pattern that goes with it."""

    rank_path: str
    pattern: str = DEFAULT_PATTERN


def shared_vocabulary(spark: SparkSession, local_path: str, pattern: str = DEFAULT_PATTERN) -> Vocabulary:
    """A rank file that only the driver can open, copied to the shared folder after a check of its size."""
    with open(local_path, "rb") as file:
        content = file.read(LARGEST_RANK_FILE + 1)
    _checked(len(content))
    path = new_path(spark, "ranks")
    spark.createDataFrame([(content.decode("ascii").rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    return Vocabulary(path, pattern)


def _checked(size: int) -> None:
    if size > LARGEST_RANK_FILE:
        raise ValueError("a rank file too large to send to every worker")


def vocabulary_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """``(token, bytes, text)``. Bytes that are no whole character read as the replacement character."""
    fields = F.split(F.col("value"), " ")
    table = spark.read.text(vocabulary.rank_path).where(F.trim("value") != "").select(
        F.get(fields, F.lit(1)).cast("int").alias("token"), F.unbase64(F.get(fields, F.lit(0))).alias("bytes"))
    return table.withColumn("text", F.make_valid_utf8(F.col("bytes").cast("string")))


def rank_file(spark: SparkSession, vocabulary: Vocabulary) -> Broadcast:
    """The rank file's bytes on every worker, after a check of its size. A folder of files is one file."""
    files = spark.read.format("binaryFile").load(vocabulary.rank_path)
    _checked(files.agg(F.sum("length")).first()[0] or 0)
    return spark.sparkContext.broadcast(b"\n".join(bytes(r["content"]) for r in files.orderBy("path").select("content").collect()))


def vocabulary_size(spark: SparkSession, vocabulary: Vocabulary) -> int:
    """The largest id plus one."""
    return (vocabulary_table(spark, vocabulary).agg(F.max("token")).first()[0] or 0) + 1
