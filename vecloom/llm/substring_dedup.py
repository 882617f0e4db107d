"""Substring dedup over windows of words, behind a count-min prefilter."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from vecloom.llm.chunks import Chunk, ask, bucket_of, chunks_in, cut, small, wide, write_chunks
from vecloom.llm.common import Words, covered, freed, mix, owner, sha256_hex, sums, table, text_words

#: Words of a window.
WINDOW = 13
#: Bits of a sketch cell: each bucket of the key space has 2^24 counters in each of the two rows of its sketch.
CELL_BITS = 24
_STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # fixed values: odd multipliers


def fingerprints(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first word of each window that lies in one text, and two independent 64-bit hashes of its words."""
    at = np.arange(len(words.values))
    at = at[at + window <= words.first[1:][owner(words.first)]]
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    coded = words.values.dictionary_encode()
    hashed = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist()), "<u8").reshape(-1, 2)
    place = coded.indices.to_numpy(zero_copy_only=False)
    both = []
    for side, step in enumerate(_STEPS):
        each = np.ascontiguousarray(hashed[:, side])[place]
        total = np.zeros(len(each) - window + 1, np.uint64)
        for j in range(window):
            total *= step
            total += each[j:len(each) - window + 1 + j]
        both.append(mix(total[at]))
    return at, both[0], both[1]


class Sketched:
    """The windows of a chunk as they are put to the sketch: for each row, their order by bucket and cell."""

    def __init__(self, chunk: Chunk, buckets: int, window: int) -> None:
        self.words = text_words(chunk.data, chunk.offsets)
        self.at, self.one, self.two = fingerprints(self.words, window)
        self.bucket = bucket_of(self.one, buckets)
        low = np.uint64((1 << CELL_BITS) - 1)
        self.keys = [(self.bucket << np.uint64(CELL_BITS)) | (side & low) for side in (self.one, self.two)]

    def messages(self) -> Iterator[tuple[int, bytes]]:
        ordered = [np.sort(keys) for keys in self.keys]
        heads, names = cut(ordered[0] >> np.uint64(CELL_BITS))
        for a, b, bucket in zip(heads[:-1].tolist(), heads[1:].tolist(), names.tolist()):
            body = []
            for keys in ordered:
                cells = keys[a:b]
                high = np.bincount((cells >> np.uint64(16)).astype(np.int64) & 0xFF, minlength=256)
                body += [high.astype("<u4").tobytes(), (cells & np.uint64(0xFFFF)).astype("<u2").tobytes()]
            yield bucket, b"".join(body)

    def repeated(self, chunk: Chunk) -> np.ndarray:
        """Which windows the merged sketch counts twice or more in both of its rows."""
        flags = np.ones(len(self.at), bool)
        orders = [np.argsort(keys, kind="stable") for keys in self.keys]
        counts = np.diff(cut(self.bucket[orders[0]])[0])
        bits = chunk.bits("sketch", 2 * counts)
        starts = np.concatenate([[0], np.cumsum(2 * counts)])
        for row, order in enumerate(orders):
            take = np.concatenate([np.zeros(0, np.int64), *(np.arange(a + row * n, a + (row + 1) * n) for a, n in zip(starts.tolist(), counts.tolist()))])
            flags[order] &= bits[take]
        return flags


def _cells(body: bytes) -> list[np.ndarray]:
    n = (len(body) - 2048) // 4
    rows = []
    for start in (0, 1024 + 2 * n):
        high = np.frombuffer(body, "<u4", 256, start).astype(np.int64)
        rows.append((np.repeat(np.arange(256), high) << 16) | np.frombuffer(body, "<u2", n, start + 1024))
    return rows


def merge_sketches(bodies: list[bytes]) -> list[bytes]:
    """Add the sketches of all chunks up, and tell each which of its cells count two or more. Counters stop at two."""
    rows = [_cells(body) for body in bodies]
    counters = np.zeros((2, 1 << CELL_BITS), np.uint8)
    for cells in rows:
        for counter, own in zip(counters, cells):
            heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            distinct, times = own[heads], np.diff(np.append(heads, len(own)))
            counter[distinct] = np.minimum(counter[distinct] + np.minimum(times, 2), 2)
    return [np.packbits(np.concatenate([counter[own] >= 2 for counter, own in zip(counters, cells)])).tobytes() for cells in rows]


class Suspects:
    """The windows of a chunk that the sketch calls repeated, each distinct one once with the smallest document that has it."""

    def __init__(self, chunk: Chunk, buckets: int, window: int) -> None:
        seen = Sketched(chunk, buckets, window)
        self.words = seen.words
        keep = np.flatnonzero(seen.repeated(chunk))
        document = chunk.order[owner(self.words.first)[seen.at[keep]]]
        order = np.lexsort((document, seen.two[keep], seen.one[keep]))
        keep, self.document = keep[order], document[order]
        self.at, one, two = seen.at[keep], seen.one[keep], seen.two[keep]
        new = np.ones(len(keep), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        self.distinct = np.cumsum(new) - 1
        self.one, self.two, self.first = one[new], two[new], self.document[new]
        self.heads, self.names = cut(bucket_of(self.one, buckets))

    def messages(self) -> Iterator[tuple[int, bytes]]:
        for a, b, bucket in zip(self.heads[:-1].tolist(), self.heads[1:].tolist(), self.names.tolist()):
            yield bucket, b"".join([struct.pack("<I", b - a), self.one[a:b].tobytes(), self.two[a:b].tobytes(), small(self.first[a:b]).tobytes()])

    def removed(self, chunk: Chunk) -> np.ndarray:
        """Which words lie in a window that a smaller document has too."""
        elsewhere = chunk.bits("windows", np.diff(self.heads))
        lost = elsewhere[self.distinct] | (self.document > self.first[self.distinct])
        return self.at[lost]


def smaller_holder(bodies: list[bytes]) -> list[bytes]:
    """Group the windows of all chunks exactly, by 128-bit fingerprint, and tell each whether a smaller document than its own has it."""
    counts = [struct.unpack_from("<I", body)[0] for body in bodies]
    one = np.concatenate([np.frombuffer(body, "<u8", n, 4) for body, n in zip(bodies, counts)])
    two = np.concatenate([np.frombuffer(body, "<u8", n, 4 + 8 * n) for body, n in zip(bodies, counts)])
    document = np.concatenate([wide(body[4 + 16 * n:], n) for body, n in zip(bodies, counts)])
    order = np.lexsort((document, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    least = document[order][new][np.cumsum(new) - 1]
    found = np.zeros(len(order), bool)
    found[order] = document[order] > least
    return [np.packbits(part).tobytes() for part in np.split(found, np.cumsum(counts)[:-1])]


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, kept_sha256)``: each text without the words of windows an earlier document has.

    A window is ``window`` consecutive words of one text; its words go if the same words also start in a document with a
    smaller id. Windows are judged on the input. ``kept`` holds the other words, joined by one blank.

    First pass: every chunk of documents sends a count-min sketch of its windows, as the sorted cells that are not
    zero; sketches are added up per bucket of the key space. Counters only overestimate, so no repeated window is
    lost. Second pass: windows that count two or more in both rows are grouped exactly. Sketches grow with the input.

    Null and empty texts have no words. Rows with one id are one document and never remove each other's words; all
    rows without an id are one document after all others. Other columns are ignored.
    """
    def sketch(chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        return Sketched(chunk, buckets, window).messages()

    def windows(chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        return Suspects(chunk, buckets, window).messages()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_in(batches):
            suspects = Suspects(chunk, buckets, window)
            words, starts = suspects.words, suspects.removed(chunk)
            gone = covered(starts, starts + window, len(words.values))
            kept = []
            values, left = words.values.to_pylist(), ~gone
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                kept.append(b" ".join([values[i] for i in (np.flatnonzero(left[a:b]) + a).tolist()]))
            yield pa.RecordBatch.from_arrays(
                [chunk.doc_id, pa.array(words.counts()), pa.array(sums(gone, words.first)), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array([sha256_hex(k) for k in kept])], ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    chunks, buckets = write_chunks(docs)
    asked = ask(ask(chunks, sketch, merge_sketches, "sketch", buckets), windows, smaller_holder, "windows", buckets)
    return asked.mapInArrow(freed(finish), "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents", "doc_id", "text")).drop("kept")


OP10_SQL = r"""
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
wins AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos, w FROM words WHERE len(w) >= 13),
keyed AS (SELECT doc_id, pos, list_slice(w, pos, pos + 12) AS win FROM wins),
least AS (SELECT win, min(doc_id) AS first FROM keyed GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM keyed k JOIN least l ON k.win = l.win AND k.doc_id > l.first),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words),
kept AS (SELECT e.doc_id, count(g.pos) AS n_removed, string_agg(e.word, ' ' ORDER BY e.pos) FILTER (WHERE g.pos IS NULL) AS text
         FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id"""
