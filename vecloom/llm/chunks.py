"""Documents packed into chunks, and questions that chunks ask each other through a shuffle.

A chunk is one row: some whole documents, a few megabytes of text. Two operators need to know, for very many small
keys of every chunk, what other chunks hold. They send keys in bulk: one message per chunk and bucket of the key
space. All messages of a bucket meet in one task, whose answers go back to the chunks. A chunk sends each distinct key
once, so a key that a third of all documents hold arrives once per chunk. Chunks lie in a bucketed table, so the
answers travel to the chunks and the text is never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from vecloom.llm.common import flat, freed, slices
from vecloom.session import ship_package, write_bucketed, write_table

#: Text per chunk; one longer document is a chunk by itself.
CHUNK_BYTES = 2 << 20
#: Text behind one bucket of keys, and behind one file of chunks.
BUCKET_BYTES, FILE_BYTES = 8 << 20, 48 << 20
#: Buckets that one task of an exchange has on average, at most.
BUCKETS_PER_TASK = 2
#: Most buckets of a bucketed table (Spark takes 100,000), and chunks from which on they are dealt to their files by a shuffle.
MOST_BUCKETS, MOST_FILES = 65_536, 500_000
#: Bits of a chunk's number for its input partition and for its place there; 24 bits are left for a row of the chunk.
PARTITION_BITS, PLACE_BITS = 21, 18
#: What a missing document id counts as: after all others.
NO_ID = 2**63 - 1

CHUNK = "chunk long, doc_id array<long>, sizes array<long>, data binary"
MESSAGE = "bucket int, chunk long, body binary"


def chunk_number(partition: int, place: int) -> int:
    """The number of the chunk at ``place`` of an input partition."""
    if partition >= 1 << PARTITION_BITS or place >= 1 << PLACE_BITS:
        raise ValueError(f"chunk {place} of partition {partition} has no number")
    return (partition << PLACE_BITS) + place


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    partition, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            data, offsets = flat(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk_number(partition, place)], pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([np.diff(offsets).tolist()], pa.list_(pa.int64())), pa.array([data.tobytes()], pa.binary())],
                ["chunk", "doc_id", "sizes", "data"])
            place += 1


def write_chunks(docs: DataFrame) -> tuple[DataFrame, int]:
    """The chunks of ``docs (doc_id long, text)`` as a bucketed table in the shared folder, and how many buckets keys should have.

    A writing task makes a file for each bucket it has a chunk of. That is a file per chunk, which does as long as chunks are
    few; more than ``MOST_FILES`` are dealt to the tasks of their buckets first, a file each. Beyond ``MOST_BUCKETS`` files
    of ``FILE_BYTES`` the files grow; they are read chunk by chunk.
    """
    spark = docs.sparkSession
    ship_package(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = min(max(partitions, -(-total // FILE_BYTES)), MOST_BUCKETS)
    packed = docs.select("doc_id", "text").mapInArrow(freed(_pack), CHUNK)
    if total // CHUNK_BYTES > MOST_FILES:
        packed = packed.repartition(files, "chunk")
    # small row groups, as a reader holds many rows at once and these are large
    chunks = write_bucketed(packed, "chunks", "chunk", files, {"compression": "zstd", "parquet.block.size": str(16 << 20)})
    return chunks, max(2 * partitions, -(-total // BUCKET_BYTES))


@dataclass
class Chunk:
    number: int
    data: np.ndarray
    offsets: np.ndarray
    doc_id: pa.Array
    #: Per document, its id as a number that can be compared.
    order: np.ndarray
    #: Answers by name: for each bucket in ascending order, its body.
    answers: dict[str, list[bytes]]
    #: Other columns that were joined to the chunk.
    extra: dict[str, list]

    def joined(self, name: str, kind: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind), *(np.frombuffer(body, kind) for body in self.answers[name])])

    def bits(self, name: str, counts: np.ndarray) -> np.ndarray:
        """Answers of one bit per key, where ``counts`` keys went to each bucket that got any."""
        found = [np.unpackbits(np.frombuffer(body, np.uint8), count=int(n)) for body, n in zip(self.answers[name], counts)]
        return np.concatenate([np.zeros(0, np.uint8), *found]).astype(bool)


def chunks_in(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        names = [n for n in batch.schema.names if n not in ("chunk", "doc_id", "sizes", "data")]
        for row in range(batch.num_rows):
            ids = batch.column("doc_id")[row].values
            sizes = batch.column("sizes")[row].values.to_numpy(zero_copy_only=False).astype(np.int64)
            answers, extra = {}, {}
            for name in names:
                found = batch.column(name)[row].as_py() or []
                if "bucket" in (f.name for f in batch.schema.field(name).type.value_type):
                    answers[name] = [a["body"] for a in sorted(found, key=lambda a: a["bucket"])]
                else:
                    extra[name] = found
            yield Chunk(batch.column("chunk")[row].as_py(), np.frombuffer(batch.column("data")[row].as_buffer(), np.uint8),
                        np.concatenate([[0], np.cumsum(sizes)]), ids, ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), answers, extra)


def _sent(chunks: DataFrame, messages: Callable[[Chunk], Iterator[tuple[int, bytes]]]) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_in(batches):
            sent = list(messages(chunk))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in sent], pa.int32()), pa.array([chunk.number] * len(sent), pa.int64()),
                 pa.array([body for _, body in sent], pa.binary())], ["bucket", "chunk", "body"])

    return chunks.mapInArrow(freed(send), MESSAGE)


def _by_bucket(sent: DataFrame, buckets: int) -> GroupedData:
    """Messages by bucket, in tasks that grow in number with the buckets, whatever the session's number of shuffle partitions."""
    partitions = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = -(-buckets // BUCKETS_PER_TASK)
    return (sent.repartition(tasks, "bucket") if tasks > partitions else sent).groupBy("bucket")


def gather(chunks: DataFrame, messages: Callable[[Chunk], Iterator[tuple[int, bytes]]],
           resolve: Callable[[list[bytes]], pa.Table], schema: str, buckets: int) -> DataFrame:
    """The rows that ``resolve`` makes of all bodies of a bucket, for each bucket that any chunk sent a message to."""
    def answer(table: pa.Table) -> pa.Table:
        return resolve(table.column("body").to_pylist())

    return _by_bucket(_sent(chunks, messages), buckets).applyInArrow(answer, schema)


def ask(chunks: DataFrame, messages: Callable[[Chunk], Iterator[tuple[int, bytes]]],
        resolve: Callable[[list[bytes]], list[bytes]], name: str, buckets: int) -> DataFrame:
    """``chunks`` with a column ``name``: for each message a chunk sent, ``(bucket, body)`` with the answer.

    ``messages`` yields (bucket, body) for a chunk; ``resolve`` takes all bodies of a bucket and answers each.
    """
    def answer(table: pa.Table) -> pa.Table:
        return table.set_column(2, "body", pa.array(resolve(table.column("body").to_pylist()), pa.binary()))

    found = write_table(_by_bucket(_sent(chunks, messages), buckets).applyInArrow(answer, MESSAGE), name)
    back = found.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "body")).alias(name))
    return chunks.join(back.hint("shuffle_hash"), "chunk", "left")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of 64-bit keys, of even width."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def cut(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each bucket starts in a sorted list of buckets (with the end), and which buckets those are."""
    heads = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else np.zeros(0, np.int64)
    return np.append(heads, len(buckets)), buckets[heads].astype(np.int64)


def small(numbers: np.ndarray) -> np.ndarray:
    """Numbers in the narrowest of three types."""
    if len(numbers) and (numbers.min() < 0 or numbers.max() >= 2**32):
        return numbers.astype("<i8")
    return numbers.astype("<u2" if not len(numbers) or numbers.max() < 2**16 else "<u4")


def wide(data: bytes, count: int) -> np.ndarray:
    """What :func:`small` made, as 64-bit numbers."""
    kind = {2: "<u2", 4: "<u4", 8: "<i8"}[len(data) // count] if count else "<u2"
    return np.frombuffer(data, kind).astype(np.int64)
