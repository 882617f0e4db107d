"""Writers. Each replaces what lies at its path, and none gathers its input in one task."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.operators.accounts import observed, seen_counts
from vecloom.sources.text_files import corpus_lines


def write_text(df: DataFrame, path: str, order_by: list[str] | None = None, counts: dict[str, Column] | None = None) -> dict[str, int]:
    """Write the column ``value`` as text; with ``order_by``, part files in name order hold the rows in order.

    Returns ``counts``, aggregates over the rows of ``df``, taken while they are written.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    counts = counts or {}
    watched, seen = observed(df, counts) if counts else (df, None)
    watched.select("value").write.mode("overwrite").text(path)
    return seen_counts(seen, counts) if seen else {}


def write_shards(df: DataFrame, path: str, order_by: str, counts: dict[str, Column] | None = None) -> dict[str, int]:
    """Write ``value`` into one folder ``shard=i`` per shard, in order inside each shard, and return ``counts`` of the rows.

    A shard may be far too large for one task: rows are range-partitioned by shard and order, so a shard
    becomes as many files as it needs.
    """
    counts = counts or {}
    placed = df.repartitionByRange("shard", order_by).sortWithinPartitions("shard", order_by)
    watched, seen = observed(placed, counts) if counts else (placed, None)
    watched.select("shard", "value").write.mode("overwrite").partitionBy("shard").text(path)
    return seen_counts(seen, counts) if seen else {}


def write_parquet(df: DataFrame, path: str, counts: dict[str, Column]) -> dict[str, int]:
    """Write ``df`` as Parquet and return ``counts`` of its rows."""
    watched, seen = observed(df, counts)
    watched.write.mode("overwrite").parquet(path)
    return seen_counts(seen, counts)


def write_rejected(rejected: DataFrame, path: str) -> None:
    """Write rejected rows as ``reason TAB value``; line ends inside a value become blanks, a missing value is empty."""
    flat = F.regexp_replace(F.coalesce("value", F.lit("")), r"[\r\n]+", " ")
    rejected.select(F.concat_ws("\t", "reason", flat).alias("value")).write.mode("overwrite").text(path)


def merge_part_files(spark: SparkSession, source: str, target: str, name_glob: str = "part-*") -> bool:
    """Join the part files of a folder, in name order, into one ordered text dataset at ``target``.

    The target's files in name order hold exactly the source's lines in order, in files of even size, so
    readers take the folder as the one merged file and no task carries it all. Returns False, and writes
    nothing, when the source is missing or has no such file.
    """
    try:
        lines = corpus_lines(spark, source, name_glob)
        found = lines.head(1)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    if not found:
        return False
    write_text(lines.withColumnRenamed("line", "value"), target, ["file", "block", "seq"])
    return True
