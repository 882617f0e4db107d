"""Global positions without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.session import write_table


def running_offsets(df: DataFrame, order_by: Sequence[str], weight: Column | None = None) -> DataFrame:
    """``(order_by..., offset)``: the summed weights of all rows before each row, by the unique key ``order_by``.

    Spark range-partitions the keys alone, not the rows they belong to. Weights are computed once, into a
    small table, since range partitioning reads its input twice. The partition number is written down with
    each key, because a second evaluation could draw other range bounds. Partition totals (one row per
    shuffle partition) give each partition's start; a window inside the partition gives the rest.
    """
    keys = list(order_by)
    weighed = df.select(*keys, (F.lit(1) if weight is None else weight).cast("bigint").alias("_weight"))
    if weight is not None:
        weighed = write_table(weighed, "weights")
    ranged = weighed.repartitionByRange(*keys)
    placed = write_table(ranged.withColumn("_part", F.spark_partition_id()), "offsets")

    totals = placed.groupBy("_part").agg(F.sum("_weight").alias("_total"))
    over_parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = totals.select("_part", (F.sum("_total").over(over_parts) - F.col("_total")).alias("_start"))

    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.withColumn("_running", F.sum("_weight").over(inside) - F.col("_weight"))
    # one row per shuffle partition, so the broadcast is bounded by spark.sql.shuffle.partitions
    return running.join(F.broadcast(starts), "_part").select(
        *keys, (F.col("_start") + F.col("_running")).alias("offset"))


def with_offset(df: DataFrame, order_by: Sequence[str], weight: Column | None = None) -> DataFrame:
    """``df`` with the column ``offset`` of :func:`running_offsets`.

    The offsets, a few bytes per row, are the build side of a hash join, so the rows themselves are not sorted.
    """
    return df.join(running_offsets(df, order_by, weight).hint("shuffle_hash"), list(order_by))


def with_ordinal(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """``df`` with its rows numbered from 0 in the order of the unique key ``order_by``."""
    return with_offset(df, order_by).withColumnRenamed("offset", name)
