"""What the operators share: tables, and texts as flat byte arrays inside Arrow tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from vecloom.session import ship_package

#: Text that an Arrow task works on at once. One longer text is worked on by itself.
SLICE_BYTES = 4 << 20

#: Bytes that end a word of kind ``[^\x20\x09-\x0D]+``.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of ``folder/name.parquet``; the package is put on the workers' path."""
    ship_package(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").select(*columns)


def freed(work: Callable) -> Callable:
    """An Arrow function that gives memory back when its task ends, since the worker stays for other stages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def set_aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns called like ``names`` under other names, and what to rename to get them back."""
    prefix = "_kept_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    taken = {c: f"{prefix}{c}" for c in df.columns if c in names}
    return df.withColumnsRenamed(taken), {new: old for old, new in taken.items()}


def sha256_hex(data: bytes | memoryview | np.ndarray) -> str:
    return hashlib.sha256(data).hexdigest()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each starts and the last ends. Null is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[offsets[0]:offsets[-1]], offsets - offsets[0]


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Pieces that lie one after another in ``data``, as an Arrow array without a copy."""
    offsets = np.ascontiguousarray(offsets, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows holding at most ``limit`` bytes of text, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


@dataclass
class Words:
    """The words of some texts. ``first[d]`` is the number of the first word of text ``d``; it has one entry more."""

    values: pa.Array
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def ids(self) -> np.ndarray:
        """Equal words have equal ids, counted from 0 within this batch."""
        if not len(self.values):
            return np.zeros(0, np.int64)
        return self.values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Longest runs of bytes for which ``inside`` (one flag per byte value) holds, never across two texts."""
    kept = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = kept[:-1]
    before[edge[:-1]] = False
    start = np.flatnonzero(kept & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = kept[1:]
    after[edge[1:]] = False
    end = np.flatnonzero(kept & ~after) + 1
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=ends[1:])
    return Words(binaries(data[kept], ends), start, end, np.searchsorted(start, offsets))


def text_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return words_of(data, offsets, ~WHITE)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for each ``i``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[bounds])


def owner(bounds: np.ndarray) -> np.ndarray:
    """For each element, the number of the run of ``bounds`` it is in."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def covered(starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any of the spans."""
    steps = np.bincount(starts, minlength=size + 1).astype(np.int64) - np.bincount(stops, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of whole numbers (the public finaliser of a well-known generator; constants are fixed values)."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
