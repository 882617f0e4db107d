"""Connected components, and joins that survive a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.session import write_table

#: A key with more than one in so many of all rows is hot. There are fewer hot keys than this, so they are broadcast.
HOT_SHARE = 2000
#: Rounds after which components are taken to be stuck; a chain of n vertices needs about the logarithm of n.
ROUNDS = 60


def join_counted(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row per ``key`` and in ``n`` how many of ``rows`` have that key.

    Hot keys meet their rows by a broadcast of fewer than ``HOT_SHARE`` rows, where the rows lie; the others by a shuffle.
    Both frames are read twice, so they should be written tables.
    """
    often = rows.count() // HOT_SHARE
    hot = F.broadcast(groups.where(F.col("n") > often).drop("n"))
    rest = groups.where(F.col("n") <= often).drop("n")
    return rows.join(hot, key).unionByName(rows.join(rest, key))


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, root)`` for each vertex of ``edges (u, v)``, numbers of 64 bits; ``root`` is the least of its component.

    Alternating large-star and small-star: every vertex ties its larger, then its smaller neighbours to the least it
    knows, until nothing changes. Each round is written as a table; only two numbers of it reach the driver.
    """
    now, last = write_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"), None
    for _ in range(ROUNDS):
        both = write_table(now.union(now.select("v", "u")).toDF("u", "v"), "edges-both")
        least = write_table(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n")), "edges-least")
        large = write_table(join_counted(both, least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        least = write_table(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "edges-least")
        kept = join_counted(large, least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = write_table(kept.union(least.select("u", "m").toDF("u", "v")).distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        if seen == last:
            roots = now.select(F.col("v")).distinct()
            return now.toDF("vertex", "root").union(roots.select(F.col("v").alias("vertex"), F.col("v").alias("root")))
        last = seen
    raise RuntimeError("components did not settle")
