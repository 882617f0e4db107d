"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str], spread_by: str | None = None) -> DataFrame:
    """Columns of ``folder/name.parquet``; with ``spread_by``, :func:`spread` by that column."""
    table = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").select(*columns)
    return spread(table, spread_by) if spread_by else table


def spread(df: DataFrame, column: str) -> DataFrame:
    """Deal the rows of a file of one split over the cores, by a column of unique values.

    A small file gives one task, however many cores wait. That is judged by the table's files alone, not by how the session
    would plan to read them: an input of more than one split, or of several files, stays as it lies.
    """
    spark = df.sparkSession
    files = df.inputFiles()
    if len(files) != 1:
        return df
    size = spark.read.format("binaryFile").load(files[0]).select("length").first()[0]
    if size > _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")):
        return df
    return df.repartition(2 * spark.sparkContext.defaultParallelism, column)


def _bytes(setting: str) -> int:
    """A size setting in bytes, as ``134217728b``, ``128m`` or ``1g``."""
    number = setting.lower().removesuffix("b")
    power = "kmgt".find(number[-1]) + 1
    return int(number[:-1] if power else number) << (10 * power)
