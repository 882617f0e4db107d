"""Exact substring dedup by a distributed merge sort of suffixes.

Suffixes matter only to the depth of the shortest repeat, and only where a repeat can be. Each window of that many
bytes chooses one of its k-grams, the first with the least hash. Equal windows choose alike, so a window that other
documents have too chooses a k-gram that other documents have too. A suffix is taken at each chosen k-gram that a first
exchange finds in two or more documents. Suffixes at a k-gram that very many chunks have are dealt by the text around it
too, so that none gathers in one bucket. Every chunk sorts its suffixes and sends them front-coded; each bucket merges the
sorted runs of all chunks by a loser tree that keeps common prefixes and never compares them again. The merged order
comes with the longest common prefix of neighbours, from which equal windows are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vecloom.llm.chunks import Chunk, ask, bucket_of, chunks_in, cut, small, wide, write_chunks
from vecloom.llm.common import covered, freed, mix, owner, sha256_hex, sums, table

#: Bytes of the shortest repeat, and of the k-grams by which repeats are found.
DEPTH, GRAM = 50, 24
#: k-grams in a window, and bytes that can stand before the chosen one.
CHOICES = DEPTH - GRAM + 1
BEFORE = CHOICES - 1
#: Positions whose k-grams are hashed at once.
BLOCK = 1 << 20
#: A suffix record: DEPTH bytes from the k-gram on, the BEFORE bytes in front of it backwards, the least and largest
#: number of bytes by which a window of the document can start before the k-gram, and padding to whole words.
RECORD = 80
#: A k-gram that so many chunks have is hot: its suffixes are dealt by the text around it too, in SIDES copies.
HOT_CHUNKS, SIDES = 1000, 4
#: Windows of one copy, by how many bytes they start before the k-gram, and the bytes all windows of a copy share.
STRIDE = -(-CHOICES // SIDES)
COMMON = DEPTH - STRIDE + 1
_STEPS = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]  # fixed values: odd multipliers


def choices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one chosen k-gram: its place, its hash, and the first and last window. Windows lie in one text."""
    n = len(data)
    found: list[list[np.ndarray]] = [[], [], [], []]
    room = np.repeat(offsets[1:], np.diff(offsets))  # where the text of each byte ends
    for start in range(0, n - DEPTH + 1, BLOCK):
        stop = min(start + BLOCK, n - DEPTH + 1)
        piece = data[start:stop + DEPTH - 1].tobytes() + bytes(8)
        m = stop - start + CHOICES - 1
        h = np.zeros(m, np.uint64)
        for step, at in zip(_STEPS, range(0, GRAM, 8)):
            h += np.ndarray(m, "<u8", piece, at, (1,)) * step
            h ^= h >> np.uint64(29)
        h *= _STEPS[-1]
        h ^= h >> np.uint64(32)
        least, place, span = h, np.zeros(m, np.uint8), 1
        while span < CHOICES:  # the first least of spans twice as long, and at last of CHOICES
            shift = min(span, CHOICES - span)
            left, right = least[:-shift], least[shift:]
            place = np.where(left <= right, place[:-shift], place[shift:] + np.uint8(shift))
            least = np.minimum(left, right)
            span += shift
        window = np.flatnonzero(np.arange(start + DEPTH, stop + DEPTH) <= room[start:stop])
        if not len(window):
            continue
        chosen = window + place[window]
        heads = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        tails = np.append(heads[1:], len(window)) - 1
        # least hashes are small numbers; mixed again they spread evenly over the buckets
        for kind, values in zip(found, (chosen[heads] + start, mix(least[window[heads]]), window[heads] + start, window[tails] + start)):
            kind.append(values)
    return tuple(np.concatenate([np.zeros(0, kind), *parts]).astype(kind) for parts, kind in zip(found, (np.int64, np.uint64, np.int64, np.int64)))


class Grams:
    """The chosen k-grams of a chunk: each distinct one once, and whether two documents here have it."""

    def __init__(self, chunk: Chunk, buckets: int) -> None:
        self.place, hashed, self.low, self.high = choices(chunk.data, chunk.offsets)
        self.document = owner(chunk.offsets)[self.place] if len(self.place) else np.zeros(0, np.int64)
        order = np.argsort(hashed, kind="stable")
        ordered = hashed[order]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(order) else np.zeros(0, np.int64)
        self.number = np.zeros(len(order), np.int64)
        self.number[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
        self.hash = ordered[heads]
        self.many = np.zeros(len(heads), bool)
        if len(heads):
            documents = chunk.order[self.document[order]]
            self.many = np.minimum.reduceat(documents, heads) < np.maximum.reduceat(documents, heads)
        self.heads, self.names = cut(bucket_of(self.hash, buckets))

    def messages(self) -> Iterator[tuple[int, bytes]]:
        for a, b, bucket in zip(self.heads[:-1].tolist(), self.heads[1:].tolist(), self.names.tolist()):
            yield bucket, self.hash[a:b].astype("<u4").tobytes() + np.packbits(self.many[a:b]).tobytes()


def shared_grams(bodies: list[bytes], hot_chunks: int) -> list[bytes]:
    """Tell each chunk which of its k-grams two or more documents have, and, if any is, which are hot. Hashes may fall
    together; no shared one is missed."""
    counts = [_entries(body) for body in bodies]
    cells = np.concatenate([np.frombuffer(body, "<u4", n) for body, n in zip(bodies, counts)])
    many = np.concatenate([np.unpackbits(np.frombuffer(body, np.uint8, -1, 4 * n), count=n) for body, n in zip(bodies, counts)])
    order = np.argsort(cells, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], cells[order][1:] != cells[order][:-1]]))
    sizes = np.diff(np.append(heads, len(order)))
    shared, hot = np.zeros(len(order), bool), np.zeros(len(order), bool)
    shared[order] = np.repeat((sizes > 1) | (np.maximum.reduceat(many[order], heads) > 0), sizes)
    hot[order] = np.repeat(sizes >= hot_chunks, sizes)
    ends = np.cumsum(counts)[:-1]
    return [np.packbits(part).tobytes() + (np.packbits(some).tobytes() if some.any() else b"") for part, some in zip(np.split(shared, ends), np.split(hot, ends))]


def gram_answers(bodies: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`shared_grams` told a chunk of its k-grams: shared ones, and hot ones."""
    shared, hot = [np.zeros(0, np.uint8)], [np.zeros(0, np.uint8)]
    for body, n in zip(bodies, counts.tolist()):
        raw, size = np.frombuffer(body, np.uint8), -(-n // 8)
        shared.append(np.unpackbits(raw[:size], count=n))
        hot.append(np.unpackbits(raw[size:], count=n) if len(raw) > size else np.zeros(n, np.uint8))
    return np.concatenate(shared).astype(bool), np.concatenate(hot).astype(bool)


def _entries(body: bytes) -> int:
    """How many entries of 33 bits a message holds."""
    n = len(body) * 8 // 33
    return n if 4 * n + -(-n // 8) == len(body) else n - 1


class Suffixes:
    """The suffixes of a chunk at shared k-grams, as a sorted run per bucket; equal ones once, with the smallest document."""

    def __init__(self, chunk: Chunk, buckets: int) -> None:
        grams = Grams(chunk, buckets)
        shared, hot = gram_answers(chunk.answers["grams"], np.diff(grams.heads))
        keep = np.flatnonzero(shared[grams.number])
        self.place, self.low, self.high = grams.place[keep], grams.low[keep], grams.high[keep]
        bucket = bucket_of(grams.hash[grams.number[keep]], buckets)
        if hot.any():
            keep, bucket = self._sides(chunk, keep, hot[grams.number[keep]], grams.hash[grams.number[keep]], bucket, buckets)
        position = grams.document[keep]
        start, stop = chunk.offsets[position], chunk.offsets[position + 1]
        records = np.zeros((len(keep), RECORD), np.uint8)
        padded = np.concatenate([np.zeros(BEFORE, np.uint8), chunk.data, np.zeros(DEPTH, np.uint8)])
        around = np.lib.stride_tricks.sliding_window_view(padded, BEFORE + DEPTH)[self.place] if len(keep) else np.zeros((0, BEFORE + DEPTH), np.uint8)
        records[:, :DEPTH] = around[:, BEFORE:]
        records[:, :DEPTH][np.arange(DEPTH) >= (stop - self.place)[:, None]] = 0
        records[:, DEPTH:DEPTH + BEFORE] = around[:, BEFORE - 1::-1] if BEFORE else 0
        records[:, DEPTH:DEPTH + BEFORE][np.arange(BEFORE) >= (self.place - start)[:, None]] = 0
        records[:, DEPTH + BEFORE] = np.maximum(0, self.place + DEPTH - stop)
        records[:, DEPTH + BEFORE + 1] = np.minimum(BEFORE, self.place - start)
        document = chunk.order[position]
        keys = records.view(">u8").astype(np.uint64)
        order = np.lexsort((document, *(keys[:, c] for c in range(keys.shape[1] - 1, -1, -1)), bucket))
        records, bucket, keys = records[order], bucket[order], keys[order]
        self.place, self.low, self.high, self.document = self.place[order], self.low[order], self.high[order], document[order]
        new = np.ones(len(order), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1) | (bucket[1:] != bucket[:-1])
        self.number = np.cumsum(new) - 1
        self.records, self.first = records[new], self.document[new]
        self.heads, self.names = cut(bucket[new])

    def _sides(self, chunk: Chunk, keep: np.ndarray, hot: np.ndarray, hashed: np.ndarray, bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Put copies in place of the suffixes at hot k-grams, each for some of its windows, in the bucket of the bytes that
        all of these share; so equal windows still meet, and a k-gram in very many texts is spread over the buckets."""
        places, lows, highs, keeps, names = [self.place[~hot]], [self.low[~hot]], [self.high[~hot]], [keep[~hot]], [bucket[~hot]]
        place, low, high, kept, hashed = self.place[hot], self.low[hot], self.high[hot], keep[hot], hashed[hot]
        for side in range(SIDES):
            near = side * STRIDE
            first, last = np.maximum(low, place - (near + STRIDE - 1)), np.minimum(high, place - near)
            some = np.flatnonzero(first <= last)
            mixed = hashed[some].copy()
            for at in range(COMMON):
                mixed = (mixed ^ chunk.data[place[some] - near + at].astype(np.uint64)) * _STEPS[0]
                mixed ^= mixed >> np.uint64(29)
            for kind, values in zip((places, lows, highs, keeps, names), (place[some], first[some], last[some], kept[some], bucket_of(mix(mixed + np.uint64(side)), buckets))):
                kind.append(values)
        self.place, self.low, self.high = (np.concatenate(x) for x in (places, lows, highs))
        return np.concatenate(keeps), np.concatenate(names)

    def messages(self) -> Iterator[tuple[int, bytes]]:
        for a, b, bucket in zip(self.heads[:-1].tolist(), self.heads[1:].tolist(), self.names.tolist()):
            yield bucket, front_code(self.records[a:b], self.first[a:b])

    def removed(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Spans of bytes, from and to, under the windows that a smaller document has too."""
        found = chunk.joined("suffixes", "<u4")[self.number]
        found = np.where(self.document > self.first[self.number], np.uint32(2**CHOICES - 1), found)
        nearest, farthest = (self.place - self.high).astype(np.uint32), (self.place - self.low).astype(np.uint32)
        wanted = (np.uint32(2) << farthest) - (np.uint32(1) << nearest)  # the windows that chose this k-gram here
        found &= wanted
        whole = found == wanted
        some = np.flatnonzero((found != 0) & ~whole)
        sizes = self.high[some] - self.low[some] + 1
        ends = np.cumsum(sizes)
        window = np.repeat(self.low[some] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        offset = np.repeat(self.place[some], sizes) - window
        single = window[(np.repeat(found[some], sizes) >> offset.astype(np.uint32)) & 1 == 1]
        return np.concatenate([self.low[whole], single]), np.concatenate([self.high[whole], single]) + DEPTH


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Of each row and the one before it."""
    if not len(rows):
        return np.zeros(0, np.int64)
    apart = np.ones((len(rows), rows.shape[1] + 1), bool)
    apart[1:, :-1] = rows[1:] != rows[:-1]
    apart[0, 0] = True
    return apart.argmax(axis=1)


def front_code(records: np.ndarray, documents: np.ndarray) -> bytes:
    """A sorted run: the common prefix of each suffix with the one before it, and what follows that prefix."""
    rows = records[:, :DEPTH]
    shared = common_prefixes(rows).astype(np.uint8)
    tails = rows[np.arange(DEPTH) >= shared[:, None]]
    plain = b"".join([shared.tobytes(), tails.tobytes(), records[:, DEPTH:DEPTH + BEFORE + 2].tobytes()])
    packed = pa.compress(plain, codec="zstd", asbytes=True)
    return struct.pack("<III", len(records), len(plain), len(packed)) + packed + small(documents).tobytes()


def front_decode(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(records, common prefixes, documents) of a run."""
    n, size, packed = struct.unpack_from("<III", body)
    plain = np.frombuffer(pa.decompress(body[12:12 + packed], size, codec="zstd"), np.uint8)
    shared = plain[:n].astype(np.int64)
    written = np.arange(DEPTH) >= shared[:, None]
    records = np.zeros((n, RECORD), np.uint8)
    rows = np.zeros((n, DEPTH), np.uint8)
    tails = int(written.sum())
    rows[written] = plain[n:n + tails]
    source = np.maximum.accumulate(np.where(written, np.arange(n)[:, None], 0), axis=0)
    records[:, :DEPTH] = np.take_along_axis(rows, source, axis=0)
    records[:, DEPTH:DEPTH + BEFORE + 2] = plain[n + tails:].reshape(n, BEFORE + 2)
    return records, shared, wide(body[12 + packed:], n)


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs of equally long strings: for each string in order its run, its place there, and its common
    prefix with the string before it.

    A loser tree over the runs' first strings. Each string knows its common prefix with the last string put out: the one
    with the longer prefix is smaller, and only at equal prefixes are bytes compared, from the prefix on.
    """
    width = 1
    while width < len(runs):
        width *= 2
    strings = [run[0] for run in runs] + [[]] * (width - len(runs))
    prefixes = [run[1] for run in runs]
    places, limits = [0] * width, [len(s) for s in strings]
    heads: list[bytes | None] = [s[0] if s else None for s in strings]
    known = [0] * width  # common prefix of each head with the last string put out
    losers = [0] * width

    def wins(a: int, b: int) -> int:
        """The run with the smaller head; ties go to the first run. The loser learns its prefix with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a
        if x is None:
            return b
        if known[a] != known[b]:
            return a if known[a] > known[b] else b
        at = known[a]
        while at < DEPTH:
            to = min(at + 8, DEPTH)
            p, q = int.from_bytes(x[at:to]), int.from_bytes(y[at:to])
            if p != q:
                same = at + (8 * (to - at) - (p ^ q).bit_length()) // 8
                known[b if p < q else a] = same
                return a if p < q else b
            at = to
        known[max(a, b)] = DEPTH
        return min(a, b)

    tops = list(range(width))
    while len(tops) > 1:  # play the first round from the leaves up
        level, nodes = len(tops) // 2, []
        for i in range(level):
            a, b = tops[2 * i], tops[2 * i + 1]
            winner = wins(a, b)
            losers[level + i] = b if winner == a else a
            nodes.append(winner)
        tops = nodes
    winner = tops[0]
    from_run, from_place, common = [], [], []
    while heads[winner] is not None:
        place = places[winner]
        from_run.append(winner)
        from_place.append(place)
        common.append(known[winner])
        place += 1
        places[winner] = place
        if place < limits[winner]:
            heads[winner], known[winner] = strings[winner][place], prefixes[winner][place]
        else:
            heads[winner] = None
        node = (winner + width) // 2
        while node:
            rival = losers[node]
            best = wins(winner, rival)
            if best != winner:
                losers[node], winner = winner, best
            node //= 2
    return from_run, from_place, common


def smaller_suffixes(bodies: list[bytes]) -> list[bytes]:
    """Merge the runs of a bucket and tell each suffix by which windows a smaller document has it.

    Bit ``i`` of an answer: the window that starts ``i`` bytes before the k-gram stands in a smaller document than the
    suffix's own. Such windows agree in the next ``DEPTH - i`` bytes, so they lie together in the merged order with no
    smaller common prefix between them, and in the ``i`` bytes before.
    """
    decoded = [front_decode(body) for body in bodies]
    counts = [len(records) for records, _, _ in decoded]
    runs = []
    for records, shared, _ in decoded:
        raw = records[:, :DEPTH].tobytes()
        runs.append(([raw[at:at + DEPTH] for at in range(0, len(raw), DEPTH)], shared.tolist()))
    run, place, common = (np.array(x, np.int64) for x in merge_runs(runs))
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    order = starts[run] + place
    records = np.concatenate([records for records, _, _ in decoded])[order]
    document = np.concatenate([documents for _, _, documents in decoded])[order]
    back = np.ascontiguousarray(records[:, DEPTH:DEPTH + BEFORE])
    words = np.zeros((len(back), -(-BEFORE // 8) * 8), np.uint8)
    words[:, :BEFORE] = back
    keys = words.view(">u8").astype(np.uint64)
    sorted_ = np.lexsort([keys[:, c] for c in range(keys.shape[1] - 1, -1, -1)])
    back_common = common_prefixes(back[sorted_])
    least, most = records[:, DEPTH + BEFORE], records[:, DEPTH + BEFORE + 1]
    answers = np.zeros(len(order), np.uint32)
    before = np.zeros(len(order), np.int64)
    for i in range(CHOICES):
        before[sorted_] = np.cumsum(back_common < i)
        has = np.flatnonzero((least <= i) & (i <= most))
        key = (np.cumsum(common < DEPTH - i)[has] << 32) | before[has]
        by_key = np.argsort(key, kind="stable")
        ordered = key[by_key]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(has) else np.zeros(0, np.int64)
        if len(heads) == len(has):
            continue
        owners = document[has][by_key]
        smallest = np.repeat(np.minimum.reduceat(owners, heads), np.diff(np.append(heads, len(has))))
        answers[has[by_key[owners > smallest]]] |= np.uint32(1 << i)
    unsorted = np.zeros(len(order), "<u4")
    unsorted[order] = answers
    return [part.tobytes() for part in np.split(unsorted, np.cumsum(counts)[:-1])]


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256)``: each text, as UTF-8, without repeated strings.

    A byte goes if it lies in a string of 50 bytes that also starts in a document with a smaller id. Strings may overlap,
    lie in one document each, and are judged on the input. ``n_spans`` counts the longest runs of removed bytes, and
    ``kept`` joins the other bytes, which need not be whole characters.

    Null and empty texts, and texts of fewer than 50 bytes, lose nothing. Rows with one id are one document and never
    remove each other's bytes; all rows without an id are one document after all others. Other columns are ignored.
    """
    def grams(chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        return Grams(chunk, buckets).messages()

    def suffixes(chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        return Suffixes(chunk, buckets).messages()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_in(batches):
            gone = covered(*Suffixes(chunk, buckets).removed(chunk), len(chunk.data))
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
            begins[inner] = gone[inner]
            left, removed = chunk.data[~gone], sums(gone, chunk.offsets)
            sizes = np.diff(chunk.offsets)
            ends = np.concatenate([[0], np.cumsum(sizes - removed)])
            kept = [left[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [chunk.doc_id, pa.array(sizes), pa.array(removed), pa.array(sums(begins, chunk.offsets)), pa.array(kept, pa.binary()),
                 pa.array([sha256_hex(k) for k in kept])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    chunks, buckets = write_chunks(docs)
    asked = ask(ask(chunks, grams, partial(shared_grams, hot_chunks=HOT_CHUNKS), "grams", buckets), suffixes, smaller_suffixes, "suffixes", buckets)
    return asked.mapInArrow(freed(finish), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(table(spark, folder, "documents", "doc_id", "text")).drop("kept")
