"""A file format of token ids with access to any token: directly addressable codes.

An id is cut into levels of eight bits, lowest first. Level ``k`` holds one byte for each id that needs it, and a bitmap
that says which of its ids go on in level ``k + 1``. A rank directory holds the ones before every 512 bits of a
bitmap, so the place of an id in the next level is a directory entry plus a count over at most 512 bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from vecloom.llm.common import flat, freed, slices, table, text_words
from vecloom.llm.pieces import PieceCoder, held
from vecloom.session import new_path, ship_package

#: First bytes of a block; fixed value of the format.
MAGIC = b"DAC1"
#: Tokens after which a block is closed. A document is never cut, so a longer one makes a longer block.
BLOCK_TOKENS = 1 << 18
#: Bits of a bitmap per entry of its rank directory.
STRETCH = 512
#: A tokenizer file above this size is refused: it goes to every worker.
LARGEST = 64 << 20
#: Fixed value: the id that ends each document in the registered query.
END_ID = 2

BLOCKS = ("part int, block int, before long, n_tokens long, doc_id array<long>, doc_tokens array<long>, codes binary")


def pack(ids: np.ndarray) -> bytes:
    """Ids of up to 32 bits as one block: magic, id count, level count, then per level count, chunks, bitmap, directory."""
    left, levels = ids.astype(np.uint32), []
    while True:
        more = left > 0xFF
        bits = np.zeros(-(-len(left) // STRETCH) * STRETCH, np.uint8)
        bits[:len(left)] = more
        ones = np.cumsum(bits.reshape(-1, STRETCH).sum(axis=1, dtype=np.uint32), dtype=np.uint32)
        directory = np.concatenate([[0], ones[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        levels.append(struct.pack("<I", len(left)) + (left & 0xFF).astype(np.uint8).tobytes()
                      + np.packbits(bits, bitorder="little").tobytes() + directory.tobytes())
        if not more.any():
            return MAGIC + struct.pack("<IB", len(ids), len(levels)) + b"".join(levels)
        left = left[more] >> 8


def _levels(codes: bytes) -> tuple[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    if codes[:4] != MAGIC:
        raise ValueError("not a block of token codes")
    total, count = struct.unpack_from("<IB", codes, 4)
    at, levels = 9, []
    for _ in range(count):
        size, = struct.unpack_from("<I", codes, at)
        stretches = -(-size // STRETCH)
        at += 4
        chunks = np.frombuffer(codes, np.uint8, size, at)
        at += size
        bitmap = np.frombuffer(codes, np.uint8, stretches * STRETCH // 8, at)
        at += len(bitmap)
        levels.append((chunks, bitmap, np.frombuffer(codes, "<u4", stretches, at)))
        at += 4 * stretches
    return total, levels


def unpack(codes: bytes) -> np.ndarray:
    """All ids of a block."""
    total, levels = _levels(codes)
    ids, going = np.zeros(total, np.uint32), None
    for k, (chunks, bitmap, _) in enumerate(levels):
        if going is None:
            going = np.arange(total)
        ids[going] |= chunks.astype(np.uint32) << np.uint32(8 * k)
        going = going[np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)]
    return ids


def pick(codes: bytes, places: np.ndarray) -> np.ndarray:
    """The ids at some places of a block. Touches only the chunks, bits and directory entries of those ids."""
    total, levels = _levels(codes)
    places = np.asarray(places, np.int64)
    if len(places) and (places.min() < 0 or places.max() >= total):
        raise IndexError("no such token in the block")
    ids, going = np.zeros(len(places), np.uint32), np.arange(len(places))
    for k, (chunks, bitmap, directory) in enumerate(levels):
        ids[going] |= chunks[places].astype(np.uint32) << np.uint32(8 * k)
        more = (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
        going, places = going[more], places[more]
        stretch = places // STRETCH
        window = np.unpackbits(bitmap.reshape(-1, STRETCH // 8)[stretch], axis=1, bitorder="little")
        earlier = np.arange(STRETCH) < (places % STRETCH)[:, None]
        places = directory[stretch] + (window & earlier).sum(axis=1)
    return ids


def _coder(definition: Broadcast) -> PieceCoder:
    return held(("word_bpe", definition.value), lambda: PieceCoder(Tokenizer.from_str(definition.value), lambda _: True, " "))


def _blocks(sent: Broadcast, end_id: int, block_tokens: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = _coder(sent), TaskContext.get().partitionId()
        block = before = 0
        held_ids, documents, sizes = [], [], []

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held_ids)
            row = [part, block, before, len(ids), documents, sizes, pack(ids)]
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                                                                     pa.list_(pa.int64()), pa.binary()])],
                ["part", "block", "before", "n_tokens", "doc_id", "doc_tokens", "codes"])

        for batch in batches:
            for rows in slices(batch, "text"):
                words = text_words(*flat(rows.column("text")))
                ids, bounds = coder.encode(words.values, words.first)
                n = rows.num_rows
                with_end = np.insert(ids, bounds[1:], np.uint32(end_id))
                bounds = bounds + np.arange(n + 1)
                names = rows.column("doc_id").to_pylist()
                at = 0
                while at < n:  # whole documents, until the block is full
                    room = block_tokens - sum(sizes)
                    to = max(at + (not sizes), int(np.searchsorted(bounds, bounds[at] + room, side="right")) - 1)
                    held_ids.append(with_end[bounds[at]:bounds[to]])
                    documents += names[at:to]
                    sizes += np.diff(bounds[at:to + 1]).tolist()
                    if to < n:
                        yield closed()
                        before += sum(sizes)
                        block, held_ids, documents, sizes = block + 1, [], [], []
                    at = to
        if sizes:
            yield closed()

    return code


def write_tokens(docs: DataFrame, definition: str, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode ``text``, end each document with ``end_id``, and write the ids at ``path`` in ascending order of ``doc_id``.

    The file is a Parquet folder with one row per block: its part and number in it, the tokens before it in the part,
    its documents with their token counts, and the codes. Parts in order hold ascending ids; null ids stand first, and
    rows with equal ids in order of their text. A null or empty text is the end id alone. The text is encoded word by
    word, so ids equal those of the whole text for tokenizers that drop white space.
    """
    spark = docs.sparkSession
    ship_package(spark)
    if len(definition) > LARGEST:
        raise ValueError(f"a tokenizer of {len(definition)} bytes is too large to send to every worker")
    sent = spark.sparkContext.broadcast(definition)
    placed = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    placed.mapInArrow(freed(_blocks(sent, end_id, block_tokens)), BLOCKS).write.mode("overwrite").parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``base``, the tokens of all parts before theirs: one small row per part, so a safe broadcast."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(parts), "part")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, from the files alone."""
    ship_package(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = memoryview(unpack(row["codes"]).astype("<u4").tobytes())
                ends = np.concatenate([[0], np.cumsum(np.array(row["doc_tokens"], np.int64))])
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_id"], pa.int64()), pa.array(ends[:-1] + row["base"] + row["before"]),
                     pa.array(row["doc_tokens"], pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _placed(spark, path).select("before", "base", "doc_id", "doc_tokens", "codes").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """``(place, token)`` for a table ``(place)`` of places in the whole stream of ids, each place once.

    Places meet the blocks they lie in by stretches of the stream, of which a block covers a few, so neither side is
    compared with all of the other. Only blocks that hold a wanted place go on, and none is decoded: each id is picked out of
    the codes. Null places and places beyond the stream have no row.
    """
    ship_package(spark)
    wide = F.lit(BLOCK_TOKENS).cast("bigint")
    start, end = F.col("base") + F.col("before"), F.col("base") + F.col("before") + F.col("n_tokens")
    blocks = _placed(spark, path).where("n_tokens > 0").select("part", "block", start.alias("start"), end.alias("end"), "codes")
    spans = blocks.select("part", "block", "start", "end", F.explode(F.sequence(
        F.call_function("div", F.col("start"), wide), F.call_function("div", F.col("end") - 1, wide))).alias("stretch"))
    wanted = places.select(F.col("place").cast("long").alias("place")).where("place >= 0").distinct().withColumn(
        "stretch", F.call_function("div", F.col("place"), wide))
    met = wanted.join(spans, "stretch").where((F.col("place") >= F.col("start")) & (F.col("place") < F.col("end"))).select(
        F.col("part").alias("_part"), F.col("block").alias("_block"), "place")

    def read(block: pa.Table, here: pa.Table) -> pa.Table:
        asked = here["place"].to_numpy()
        if not block.num_rows or not len(asked):
            return pa.schema([("place", pa.int64()), ("token", pa.int64())]).empty_table()
        found = pick(block["codes"][0].as_py(), asked - block["start"][0].as_py())
        return pa.table({"place": asked, "token": found.astype(np.int64)})

    same = (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block"))
    held_ = blocks.join(met.select("_part", "_block").distinct(), same, "left_semi").select("part", "block", "start", "codes")
    return held_.groupBy("part", "block").cogroup(met.groupBy("_part", "_block")).applyInArrow(read, "place long, token long")


def word_tokenizer() -> str:
    """The public word-end tokenizer installed beside the tokenizer libraries."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def op8_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(table(spark, folder, "documents", "doc_id", "text"), word_tokenizer(), path)
    return read_documents(spark, path)
