"""What became of the rows: rejected ones apart from the kept ones, and counts taken while a result is written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vecloom.session import new_path


@dataclass(frozen=True)
class Judged:
    """``kept`` rows, the ``rejected`` ones as ``(value, reason)``, and ``counts`` of rows ``read``, ``kept`` and ``rejected``."""

    kept: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def observed(df: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are taken as its rows pass. Put it into the plan of a write behind the last shuffle: there
    a task that runs again is counted once."""
    seen = Observation()
    return df.observe(seen, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in counts.items()]), seen


def seen_counts(seen: Observation, counts: dict[str, Column]) -> dict[str, int]:
    """The counts of :func:`observed` once the write is done; 0 for what an empty plan has left out."""
    found = seen.get
    return {name: found.get(name) or 0 for name in counts}


def set_apart(judged: DataFrame, more: dict[str, Column] | None = None) -> Judged:
    """Part the rows of a parser's ``judge_`` form by their ``reason``, in one scan of what they are parsed from.

    All rows are written to one table in the shared folder, kept ones without their text; both sides read that. ``more`` are
    further counts. No row is lost: ``read = kept + rejected``.
    """
    spark, good = judged.sparkSession, F.col("reason").isNull()
    counts = {"read": F.count(F.lit(1)), "kept": F.count(F.when(good, 1)), "rejected": F.count(F.when(~good, 1))} | (more or {})
    watched, seen = observed(judged, counts)
    path = new_path(spark, "judged")
    watched.withColumn("value", F.when(~good, F.col("value"))).write.mode("overwrite").parquet(path)
    table = spark.read.schema(judged.schema).parquet(path)
    return Judged(table.where(good).drop("value", "reason"), table.where(~good).select("value", "reason"), seen_counts(seen, counts))
