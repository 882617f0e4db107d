"""Byte-level byte-pair encoding and decoding."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from vecloom.llm.common import binaries, flat, freed, slices, table
from vecloom.llm.pieces import PieceCoder, held, let_go
from vecloom.session import ship_package

#: A tokenizer above this size is refused: it goes to every worker.
LARGEST = 64 << 20


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it can be seen, else one from U+0100 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in seen else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def tokenizer_of(ranks: dict[bytes, int], pattern: str) -> str:
    """A tokenizers-library definition that merges as a rank file does.

    There, two neighbours merge if their joint bytes are a token, lowest rank first. So every way of cutting a token
    into two tokens becomes a merge, in order of the joint rank; a piece that is a token by itself stays whole.
    """
    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda pair: pair[1]):
        cuts = [(ranks[token[:i]], ranks[token[i:]], i) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        merges.extend((name[token[:i]], name[token[i:]]) for _, _, i in sorted(cuts))
    tokenizer = Tokenizer(models.BPE(vocab={name[token]: rank for token, rank in ranks.items()}, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    tokenizer.decoder = decoders.ByteLevel()
    return tokenizer.to_str()


def byte_table(definition: str) -> list[bytes]:
    """The bytes of each id: the byte-to-character mapping reversed. Unused ids have none."""
    back = {character: byte for byte, character in enumerate(byte_characters())}
    vocabulary = json.loads(definition)["model"]["vocab"]
    found = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for name, token in vocabulary.items():
        found[token] = bytes(back[c] for c in name)
    return found


def stands_alone(piece: bytes) -> bool:
    """Whether a piece starts and ends as :func:`safe_cuts` makes pieces inside a text, so that such pieces can be joined."""
    return (len(piece) > 1 and piece[0] == 0x20 and (0x20 < piece[1] < 0x7F or piece[1] == 0xC3)
            and (0x20 < piece[-1] < 0x7F or piece[-2] == 0xC3))


def safe_cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Texts cut before single blanks between two visible characters, where no piece of the pattern can cross.

    A byte counts as visible if it is ASCII and not white space, or belongs to a letter of U+00C0 to U+00FF. Other
    places stay uncut, which is slower but never wrong. Returns the pieces and the first piece of each text.
    """
    n = len(data)
    ascii_seen = (data > 0x20) & (data < 0x7F)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    if n > 2:
        before[1:] = ascii_seen[:-1]
        before[2:] |= data[:-2] == 0xC3
        after[:-1] = ascii_seen[1:] | (data[1:] == 0xC3)
    cut = (data == 0x20) & before & after
    inner = np.flatnonzero(cut)
    inner = inner[~np.isin(inner, offsets)]
    # a text that is empty has no piece; a cut never lies at the edge of a text
    edges = offsets[:-1][np.diff(offsets) > 0]
    starts = np.sort(np.concatenate([edges, inner]), kind="stable")
    return binaries(data, np.append(starts, n)), np.searchsorted(starts, offsets)


def decode(ids: np.ndarray, bounds: np.ndarray, table_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in order and where each starts. Characters split over ids come together again as bytes."""
    data, ends = flat(table_.take(pa.array(ids)))
    return data, ends[bounds]


def _coder(definition: Broadcast) -> PieceCoder:
    return held(("byte_bpe", definition.value), lambda: PieceCoder(Tokenizer.from_str(definition.value), stands_alone, ""))


def encoded(docs: DataFrame, definition: str) -> DataFrame:
    """``docs`` with a column ``ids``: the token ids of ``text`` as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Other columns, also one named ``ids`` before (it is replaced), stay as they
    are; repeated rows stay repeated. The definition is broadcast after a check of its size.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = _sent(spark, definition)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(sent)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = coder.encode(*safe_cuts(*flat(part.column("text"))))
                made = binaries(ids.astype("<u4").view(np.uint8), 4 * bounds).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, "ids"])
        let_go()

    plain = docs.drop("ids")
    return plain.mapInArrow(freed(encode), plain.withColumn("ids", F.lit(b"")).schema)


def encoded_with_offsets(docs: DataFrame, definition: str) -> DataFrame:
    """``(doc_id, token, start, end)`` arrays per document: ids and the characters of the text each covers.

    A token that holds part of a character covers that whole character, as the tokenizers library counts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = _sent(spark, definition)
    key = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _coder(sent).tokenizer
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                found = tokenizer.encode_batch([t or "" for t in part.column("text").to_pylist()], add_special_tokens=False)
                lists = [pa.array(x, pa.list_(pa.int32())) for x in (
                    [e.ids for e in found], [[a for a, _ in e.offsets] for e in found], [[b for _, b in e.offsets] for e in found])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], ["doc_id", "token", "start", "end"])

    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {key}, token array<int>, start array<int>, end array<int>")


def decoded(coded: DataFrame, definition: str) -> DataFrame:
    """``coded`` with a column ``decoded``: the bytes of its column ``ids``. An id without bytes adds none."""
    spark = coded.sparkSession
    ship_package(spark)
    sent = _sent(spark, definition)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(byte_table(sent.value), pa.large_binary())
        for batch in batches:
            for part in slices(batch, "ids"):
                raw, offsets = flat(part.column("ids"))
                data, bounds = decode(raw.view("<u4"), offsets // 4, known)
                yield pa.RecordBatch.from_arrays([*part.columns, binaries(data, bounds).cast(pa.binary())], [*part.schema.names, "decoded"])

    plain = coded.drop("decoded")
    return plain.mapInArrow(freed(back), plain.withColumn("decoded", F.lit(b"")).schema)


def _sent(spark: SparkSession, definition: str) -> Broadcast:
    if len(definition) > LARGEST:
        raise ValueError(f"a tokenizer of {len(definition)} bytes is too large to send to every worker")
    return spark.sparkContext.broadcast(definition)


def digests(docs: DataFrame, definition: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: each text encoded, the ids decoded, both digested."""
    both = decoded(encoded(docs.select("doc_id", "text"), definition).drop("text"), definition)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def multilingual() -> str:
    """The definition of the public multilingual rank file installed beside the tokenizer libraries."""
    import public_tokenizers

    return tokenizer_of(read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents", "doc_id", "text"), multilingual())
