"""Joins with a table of vectors that goes to every task, in blocks of bounded size, so that the rows it meets stay where they lie."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

#: Bytes of a block, and of how many blocks a table may be to go to every task.
BLOCK_BYTES, MOST_BLOCKS = 128 << 20, 4


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory."""
    arrays = [(f.name, 4 if f.dataType.elementType.simpleString() in ("float", "int") else 8) for f in df.schema if isinstance(f.dataType, ArrayType)]
    return sum((F.coalesce(F.greatest(F.size(name), F.lit(0)), F.lit(0)) * size for name, size in arrays), F.lit(48 + 16 * len(df.columns)))


def block_count(table: DataFrame) -> int:
    """In how many blocks of ``BLOCK_BYTES`` a table goes to the tasks; 0 if it is too large to go to every task."""
    held = table.agg(F.sum(_row_bytes(table).cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-held // BLOCK_BYTES))
    return blocks if blocks <= MOST_BLOCKS else 0


def join_blocks(rows: DataFrame, table: DataFrame, key: str, blocks: int) -> DataFrame:
    """The rows of ``rows.join(table, key)`` for a whole number ``key``, with ``table`` broadcast in ``blocks`` blocks, dealt by a
    hash of the key.

    ``rows`` are read once for each block; with more than one, give a written table. With no block this is that join.
    """
    if not blocks:
        return rows.join(table, key)
    if blocks == 1:
        return rows.join(F.broadcast(table), key)
    block = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(blocks))
    return reduce(DataFrame.unionByName, [rows.where(block == i).join(F.broadcast(table.where(block == i)), key) for i in range(blocks)])
