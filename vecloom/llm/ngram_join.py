"""Similarity join on word shingles by chosen paths."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.chunks import Chunk, ask, bucket_of, chunks_in, cut, gather, write_chunks
from vecloom.llm.common import freed, mix, owner, set_aside, table, text_words
from vecloom.llm.components import components, join_counted
from vecloom.session import write_table

#: Words of a shingle, and the least Jaccard similarity of a link.
SHINGLE, LEAST = 5, 0.8
#: Independent runs. At similarity LEAST two sets share a path of three tokens in one run with probability 0.37 or more,
#: so all runs miss such a pair with probability below 2e-5; they miss it at the first token with 4e-11.
RUNS, DEEPEST = 24, 3
#: Members up to which a bucket is compared as it is. A larger one is split by one more token, at most DEEPEST in all.
SMALL = 200
#: Members of a block; larger buckets and groups are compared block by block.
BLOCK = 4096
#: Members of a block where whole sets are compared.
SET_BLOCK = 512
#: Bytes of a signature, and equal ones from which two sets may be similar. A link falls below with probability 2e-7.
SIGNATURE, MAYBE = 64, 35
#: Documents of a chunk are numbered in this many bits of a vertex; with a chunk's number these are 63.
ROW_BITS = 24

_SEED = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier


@dataclass(frozen=True)
class Limits:
    """Sizes at which work is split. They change the plan, never the links."""

    small: int = SMALL
    block: int = BLOCK
    set_block: int = SET_BLOCK


@dataclass
class Sets:
    """Sorted distinct shingle hashes of some texts; text ``d`` has ``tokens[first[d]:first[d + 1]]``."""

    tokens: np.ndarray
    first: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> Sets:
    """Hashes of runs of ``shingle`` words; a text of fewer words, but not none, is one shingle."""
    words = text_words(data, offsets)
    if not len(words.values):
        return Sets(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    coded = words.values.dictionary_encode()
    each = np.frombuffer(b"".join(xxhash.xxh3_64_digest(w) for w in coded.dictionary.to_pylist()), "<u8")[coded.indices.to_numpy(zero_copy_only=False)]
    counts = words.counts()
    many = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    text = np.repeat(np.arange(len(many)), many)
    ends = np.concatenate([[0], np.cumsum(many)])
    at = words.first[text] + np.arange(ends[-1]) - ends[text]
    stop = words.first[1:][text]
    hashed = np.zeros(len(at), np.uint64)
    for j in range(shingle):
        word = np.where(at + j < stop, each[np.minimum(at + j, len(each) - 1)], np.uint64(j))
        hashed = (hashed ^ word) * _SEED
        hashed ^= hashed >> np.uint64(32)
    hashed = mix(hashed)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        hashed[a:b].sort()
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (text[1:] != text[:-1])
    return Sets(hashed[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(many)))]))


def _some(sets: Sets, rows: np.ndarray) -> Sets:
    sizes = sets.sizes()[rows]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    take = np.repeat(sets.first[rows] - ends[:-1], sizes) + np.arange(ends[-1])
    return Sets(sets.tokens[take], ends)


def _limits(sets: Sets, least: float) -> np.ndarray:
    """Per token, what its draw must stay below for it to be chosen: each set chooses 1 / ``least`` tokens on average."""
    limit = np.minimum(1.0, 1.0 / (least * np.maximum(sets.sizes(), 1)))
    return np.repeat((limit * 2.0**32).astype(np.uint64), sets.sizes())


def _chosen(sets: Sets, salt: np.ndarray | np.uint64, limits: np.ndarray) -> np.ndarray:
    """Places of the tokens that are chosen at a node. Sets choose alike among the tokens they share, so two similar sets
    choose a common one on average."""
    drawn = sets.tokens ^ salt
    drawn *= _SEED
    drawn ^= drawn >> np.uint64(31)
    drawn *= np.uint64(0xD6E8FEB86659FD93)
    drawn >>= np.uint64(32)
    return np.flatnonzero(drawn < limits)


def first_paths(sets: Sets, least: float) -> list[bytes]:
    """For each set the paths of one token that it chooses in all runs, as 64-bit numbers."""
    text, limits = owner(sets.first), _limits(sets, least)
    member, path = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for run in range(RUNS):
        salt = mix(np.array([run + 1], np.uint64))[0]
        at = _chosen(sets, salt, limits)
        member.append(text[at])
        path.append(mix(sets.tokens[at] + salt))
    member, path = np.concatenate(member), np.concatenate(path)
    order = np.argsort(member, kind="stable")
    bounds = np.searchsorted(member[order], np.arange(len(sets.sizes()) + 1)).tolist()
    path = path[order].astype("<u8")
    return [path[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def texts_at(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the texts, one after another."""
    parts = [data[offsets[r]:offsets[r + 1]] for r in rows.tolist()]
    return np.concatenate([np.zeros(0, np.uint8), *parts]), np.concatenate([[0], np.cumsum(np.diff(offsets)[rows])]).astype(np.int64)


def signatures(sets: Sets) -> np.ndarray:
    """A byte of the least hash under each of SIGNATURE hash functions; no set may be empty."""
    found = np.zeros((len(sets.sizes()), SIGNATURE), np.uint8)
    for k in range(SIGNATURE):
        salt = mix(np.array([k + 1000], np.uint64))[0]
        drawn = sets.tokens ^ salt
        drawn *= _SEED
        drawn ^= drawn >> np.uint64(31)
        found[:, k] = mix(np.minimum.reduceat(drawn, sets.first[:-1])) & np.uint64(0xFF)
    return found


class Paths:
    """The chosen paths of a chunk's representatives, level by level, as far as answers are there.

    The paths of one token came with the representatives, so only texts with something to split or to compare are
    made into sets again.
    """

    def __init__(self, chunk: Chunk, buckets: int, least: float, shingle: int, limits: Limits) -> None:
        self.chunk, self.shingle, self.buckets, self.limits = chunk, shingle, buckets, limits
        held = sorted(chunk.extra["sets"], key=lambda s: s["row"])
        self.rows = np.array([s["row"] for s in held], np.int64)
        path = np.frombuffer(b"".join(s["paths"] for s in held), "<u8")
        member = np.repeat(np.arange(len(held)), [len(s["paths"]) // 8 for s in held])
        #: What ends here: (member, path, how many have the path), and what is still to be asked for.
        self.settled: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._ask(member, path)
        for level in range(1, DEEPEST + 1):
            if f"paths{level}" not in chunk.answers:
                break
            many = chunk.joined(f"paths{level}", "<u4").astype(np.int64)[self.distinct]
            deep = (many > limits.small) & (level < DEEPEST)
            here = (many > 1) & ~deep
            self.settled.append((self.member[here], self.path[here], many[here]))
            used, place = np.unique(self.member[deep], return_inverse=True)
            nodes = _some(self._sets(used), place)
            at = _chosen(nodes, np.repeat(self.path[deep], nodes.sizes()), _limits(nodes, least))
            node = owner(nodes.first)[at]
            self._ask(self.member[deep][node], mix(self.path[deep][node] ^ mix(nodes.tokens[at] + np.uint64(level))))

    def _sets(self, members: np.ndarray) -> Sets:
        return shingle_sets(*texts_at(self.chunk.data, self.chunk.offsets, self.rows[members]), self.shingle)

    def _ask(self, member: np.ndarray, path: np.ndarray) -> None:
        order = np.lexsort((member, path))
        member, path = member[order], path[order]
        once = np.ones(len(path), bool)  # a set is on a path once
        once[1:] = (path[1:] != path[:-1]) | (member[1:] != member[:-1])
        self.member, self.path = member[once], path[once]
        new = np.ones(len(self.path), bool)
        new[1:] = self.path[1:] != self.path[:-1]
        self.distinct = np.cumsum(new) - 1
        self.asked, self.times = self.path[new], np.bincount(self.distinct, minlength=int(new.sum()))

    def messages(self) -> Iterator[tuple[int, bytes]]:
        heads, names = cut(bucket_of(self.asked, self.buckets))
        for a, b, bucket in zip(heads[:-1].tolist(), heads[1:].tolist(), names.tolist()):
            yield bucket, self.asked[a:b].astype("<u8").tobytes() + self.times[a:b].astype("<u4").tobytes()

    def members(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, entries) of all settled paths: group key, vertex and signature. Big groups are dealt into pairs of blocks."""
        member, path, many = (np.concatenate(x) for x in zip(*self.settled))
        if not len(member):
            return
        used, place = np.unique(member, return_inverse=True)
        drawn = signatures(self._sets(used))
        vertex = (np.uint64(self.chunk.number) << np.uint64(ROW_BITS)) + self.rows[member].astype(np.uint64)
        take, key = dealt(path, vertex, many, self.limits.block)
        yield from entries(key, vertex[take], drawn[place[take]], self.buckets)


def dealt(key: np.ndarray, vertex: np.ndarray, many: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(which entry, key of its group) so that any two entries of a key meet in a group of about two blocks or less."""
    blocks = -(-many // block)
    own = (mix(vertex) % np.maximum(blocks, 1).astype(np.uint64)).astype(np.int64)
    times = np.where(blocks > 1, blocks, 1)
    take = np.repeat(np.arange(len(key)), times)
    ends = np.cumsum(times)
    other = np.arange(len(take)) - np.repeat(ends - times, times)
    mine = own[take]
    low, high = np.minimum(mine, other).astype(np.uint64), np.maximum(mine, other).astype(np.uint64)
    pair = mix(key[take] + mix((low << np.uint64(32)) | high))
    return take, np.where(blocks[take] > 1, pair, key[take])


def entries(key: np.ndarray, vertex: np.ndarray, drawn: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(key, kind="stable")
    key, vertex, drawn = key[order], vertex[order], drawn[order]
    heads, names = cut(bucket_of(key, buckets))
    for a, b, bucket in zip(heads[:-1].tolist(), heads[1:].tolist(), names.tolist()):
        yield bucket, struct.pack("<I", b - a) + key[a:b].tobytes() + vertex[a:b].tobytes() + drawn[a:b].tobytes()


def count_paths(bodies: list[bytes]) -> list[bytes]:
    """How many sets of all chunks are on each path."""
    counts = [len(body) // 12 for body in bodies]
    path = np.concatenate([np.frombuffer(body, "<u8", n) for body, n in zip(bodies, counts)])
    times = np.concatenate([np.frombuffer(body, "<u4", n, 8 * n) for body, n in zip(bodies, counts)])
    order = np.argsort(path, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], path[order][1:] != path[order][:-1]]))
    total = np.add.reduceat(times[order].astype(np.int64), heads)
    many = np.zeros(len(path), "<u4")
    many[order] = np.repeat(np.minimum(total, 2**32 - 1), np.diff(np.append(heads, len(path))))
    return [part.tobytes() for part in np.split(many, np.cumsum(counts)[:-1])]


def maybe_links(bodies: list[bytes]) -> pa.Table:
    """``(u, v)``: in each group, a spanning forest of the pairs whose signatures may belong to a link."""
    counts = [struct.unpack_from("<I", body)[0] for body in bodies]
    key = np.concatenate([np.frombuffer(body, "<u8", n, 4) for body, n in zip(bodies, counts)])
    vertex = np.concatenate([np.frombuffer(body, "<u8", n, 4 + 8 * n) for body, n in zip(bodies, counts)]).astype(np.int64)
    drawn = np.concatenate([np.frombuffer(body, np.uint8, SIGNATURE * n, 4 + 16 * n).reshape(n, SIGNATURE) for body, n in zip(bodies, counts)])
    order = np.lexsort((vertex, key))
    key, vertex, drawn = key[order], vertex[order], drawn[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(heads, len(key)))
    two = heads[sizes == 2]
    close = two[(drawn[two] == drawn[two + 1]).sum(axis=1) >= MAYBE]
    pairs = [np.stack([vertex[close + 1], vertex[close]], axis=1)]
    for head, size in zip(heads[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        own, open_ = drawn[head:head + size], np.arange(1, size)
        reached, root = [0], 0
        while len(open_):  # breadth first; what is reached is compared no more
            if not reached:
                root, open_ = int(open_[0]), open_[1:]
                reached = [root]
                continue
            near = (own[open_] == own[reached.pop()]).sum(axis=1) >= MAYBE
            if near.any():
                pairs.append(np.stack([vertex[head + open_[near]], np.full(int(near.sum()), vertex[head + root])], axis=1))
                reached += open_[near].tolist()
                open_ = open_[~near]
    found = np.unique(np.concatenate(pairs), axis=0)
    return pa.table({"u": pa.array(found[:, 0], pa.int64()), "v": pa.array(found[:, 1], pa.int64())})


def similar(sets: list[np.ndarray], least: float) -> np.ndarray:
    """Which of the sets have a Jaccard similarity of ``least`` or more, as a square of flags; exact."""
    sizes = np.array([len(s) for s in sets], np.float64)
    token = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    order = np.argsort(token, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], token[order][1:] != token[order][:-1]]))
    times = np.diff(np.append(heads, len(token)))
    column = np.repeat(np.arange(len(heads)), times)
    shared = np.repeat(times > 1, times)  # a token of one set is in no intersection
    names, column = np.unique(column[shared], return_inverse=True)
    row = member[order][shared]
    common = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, len(names), 8192):
        here = (column >= start) & (column < start + 8192)
        table_ = np.zeros((len(sets), min(8192, len(names) - start)), np.float32)
        table_[row[here], column[here] - start] = 1
        common += table_ @ table_.T
    np.fill_diagonal(common, sizes)
    # common / (a + b - common) >= least, in numbers of four digits, without division
    share = round(least * 10000)
    return common * (10000 + share) >= share * (sizes[:, None] + sizes[None, :])


def exact_links(least: float):
    def resolve(bodies: list[bytes]) -> pa.Table:
        """``(vertex, links, root)``: per group the weight of linked sets, and a root of each tree of links."""
        key, vertex, weight, half, sets = [], [], [], [], []
        for body in bodies:
            n, = struct.unpack_from("<I", body)
            numbers = np.frombuffer(body, "<i8", 5 * n, 4).reshape(5, n)
            tokens = np.frombuffer(body, "<u8", -1, 4 + 40 * n)
            key.append(numbers[0]), vertex.append(numbers[1]), weight.append(numbers[2]), half.append(numbers[3])
            sets += np.split(tokens, np.cumsum(numbers[4])[:-1])
        key, vertex, weight, half = (np.concatenate(x) for x in (key, vertex, weight, half))
        order = np.lexsort((vertex, key))
        heads = np.append(np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])), len(key))
        found = []
        for a, b in zip(heads[:-1].tolist(), heads[1:].tolist()):
            own = order[a:b]
            link = similar([sets[i] for i in own.tolist()], least)
            np.fill_diagonal(link, False)
            if half[own].min() >= 0:  # two different blocks: pairs inside one are counted elsewhere
                link &= half[own][:, None] != half[own][None, :]
            root = np.arange(len(own))
            while True:  # the least number reached over links
                better = np.minimum(root, np.where(link, root[None, :], len(own)).min(axis=1))
                better = better[better]
                if (better == root).all():
                    break
                root = better
            found.append(np.stack([vertex[own], link @ weight[own], vertex[own][root]], axis=1))
        rows = np.concatenate(found)
        return pa.table({n: pa.array(rows[:, i], pa.int64()) for i, n in enumerate(("vertex", "links", "root"))})

    return resolve


def near_duplicates(docs: DataFrame, least: float = LEAST, shingle: int = SHINGLE, limits: Limits = Limits()) -> DataFrame:
    """``(doc_id, class_id, n_links, text_hash, first)`` for every row of ``docs (doc_id long, text)``.

    Two documents are linked if the Jaccard similarity of their sets of ``shingle`` words is ``least`` or more.
    ``n_links`` counts the other rows a row is linked to; ``class_id`` is the smallest document id that can be reached over
    links. ``first`` marks the one row of each class that stays when near copies go: that with the smallest id, then the
    smallest chunk and place. ``text_hash`` is Spark's ``xxhash64`` of the text, to find the row again.

    1. Rows with equal sets are one set from here on, however many there are.
    2. Chosen paths: in each of 24 runs a set chooses about 1 / ``least`` of its tokens; sets that choose the same token
       share a path. Chunks ask how many sets are on each path. Paths of over 200 sets are split by one more token, up to
       three. What shares a path and may be similar by its signature is tied into loose groups.
    3. Inside a loose group all sets are compared exactly, block by block, so a link between two sets of one group
       cannot be missed, whatever the runs found.

    No pairs are ever written out: only trees of them. Null and empty texts have no shingles and no links, and are each a
    class of their own. A text of fewer words is one shingle. Equal rows are linked. Rows without an id count as the
    largest; a class of such rows alone has the class id null.
    """
    chunks, buckets = write_chunks(docs)
    seeds = write_table(chunks.mapInArrow(freed(_identities(shingle, least)), "vertex long, doc_id long, text_hash long, size int, digest binary, paths binary"), "identities")
    some = seeds.where("size > 0")
    lead = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("order"), "vertex")).alias("lead")
    classes = write_table(some.groupBy("digest").agg(lead, F.count(F.lit(1)).alias("n"), F.first("paths").alias("paths")).select(
        "digest", F.col("lead.vertex").alias("set"), F.col("lead.order").alias("least_id"), "n", "paths"), "classes")  # equal sets have equal paths
    by_chunk = classes.select(F.shiftright("set", ROW_BITS).alias("chunk"), F.struct(
        F.col("set").bitwiseAND((1 << ROW_BITS) - 1).cast("int").alias("row"), "n", "paths").alias("_set")).groupBy("chunk").agg(F.collect_list("_set").alias("sets"))
    started = chunks.join(by_chunk.hint("shuffle_hash"), "chunk")

    def paths(chunk: Chunk) -> Paths:
        return Paths(chunk, buckets, least, shingle, limits)

    asked = started
    for level in range(1, DEEPEST + 1):
        asked = ask(asked, lambda chunk: paths(chunk).messages(), count_paths, f"paths{level}", buckets)
    maybe = write_table(gather(asked, lambda chunk: paths(chunk).members(), maybe_links, "u long, v long", buckets), "maybe")
    loose = write_table(components(maybe), "loose")
    groups = loose.groupBy("root").agg(F.count(F.lit(1)).alias("many"), F.count(F.lit(1)).alias("n"))
    sized = write_table(join_counted(loose, write_table(groups, "groups"), "root"), "sized")
    wanted = sized.select(F.shiftright("vertex", ROW_BITS).alias("chunk"), F.struct(
        F.col("vertex").bitwiseAND((1 << ROW_BITS) - 1).cast("int").alias("row"), "root", "many").alias("_group")).groupBy("chunk").agg(
            F.collect_list("_group").alias("groups"))
    linked = gather(started.join(wanted.hint("shuffle_hash"), "chunk"), _sets_of_groups(buckets, shingle, limits.set_block), exact_links(least),
                    "vertex long, links long, root long", buckets)
    links = write_table(linked, "links")
    roots = components(links.select(F.col("vertex").alias("u"), F.col("root").alias("v"))).withColumnRenamed("vertex", "set")
    counted = links.groupBy(F.col("vertex").alias("set")).agg(F.sum("links").alias("links"))
    sets = write_table(classes.join(counted, "set", "left").join(roots, "set", "left").select(
        "digest", "set", "n", "least_id", F.coalesce("root", "set").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "sets")
    best = write_table(sets.groupBy("class").agg(F.min(F.struct("least_id", "set")).alias("best"), F.count(F.lit(1)).alias("n")), "best")
    named = write_table(join_counted(sets.withColumnRenamed("n", "rows"), best, "class").select(
        "digest", F.col("rows").alias("n"), "n_links", F.col("best.least_id").alias("class_id"), F.col("best.set").alias("stays")), "named")
    rows = join_counted(some, named, "digest").select("doc_id", _id("class_id"), "n_links", "text_hash", (F.col("vertex") == F.col("stays")).alias("first"))
    return rows.unionByName(seeds.where("size = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                                          "text_hash", F.lit(True).alias("first")))


def _id(name: str) -> Column:
    return F.when(F.col(name) != 2**63 - 1, F.col(name)).alias(name)


def _identities(shingle: int, least: float):
    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_in(batches):
            sets = shingle_sets(chunk.data, chunk.offsets, shingle)
            n = len(sets.sizes())
            if n >= 1 << ROW_BITS:
                raise ValueError("too many documents in a chunk")
            digests = [xxhash.xxh3_128_digest(sets.tokens[a:b].tobytes()) for a, b in zip(sets.first[:-1].tolist(), sets.first[1:].tolist())]
            texts = [xxhash.xxh64_intdigest(chunk.data[a:b].tobytes(), 42) for a, b in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array((chunk.number << ROW_BITS) + np.arange(n)), chunk.doc_id, pa.array(np.array(texts, np.uint64).astype(np.int64)),
                 pa.array(sets.sizes(), pa.int32()), pa.array(digests, pa.binary()), pa.array(first_paths(sets, least), pa.binary())],
                ["vertex", "doc_id", "text_hash", "size", "digest", "paths"])

    return identify


def _sets_of_groups(buckets: int, shingle: int, block: int):
    def messages(chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        weights = {s["row"]: s["n"] for s in chunk.extra["sets"]}
        rows = np.array([g["row"] for g in chunk.extra["groups"]], np.int64)
        root = np.array([g["root"] for g in chunk.extra["groups"]], np.int64).astype(np.uint64)
        many = np.array([g["many"] for g in chunk.extra["groups"]], np.int64)
        sets = shingle_sets(*texts_at(chunk.data, chunk.offsets, rows), shingle)
        vertex = ((chunk.number << ROW_BITS) + rows).astype(np.uint64)
        take, key = dealt(mix(root), vertex, many, block)
        blocks = -(-many // block)
        own = (mix(vertex) % np.maximum(blocks, 1).astype(np.uint64)).astype(np.int64)
        other = np.arange(len(take)) - np.searchsorted(take, take)
        half = np.where((blocks[take] > 1) & (other != own[take]), own[take], -1)
        order = np.argsort(key, kind="stable")
        take, key, half = take[order], key[order], half[order]
        heads, names = cut(bucket_of(key, buckets))
        weight = np.array([weights[r] for r in rows.tolist()], np.int64)
        for a, b, bucket in zip(heads[:-1].tolist(), heads[1:].tolist(), names.tolist()):
            part = _some(sets, take[a:b])
            numbers = np.stack([key[a:b].astype(np.int64), vertex[take[a:b]].astype(np.int64), weight[take[a:b]], half[a:b], part.sizes()])
            yield bucket, struct.pack("<I", b - a) + numbers.astype("<i8").tobytes() + part.tokens.tobytes()

    return messages


def drop_near_duplicates(docs: DataFrame, least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` of each class of :func:`near_duplicates`, with all columns, whatever they are called.

    Of rows equal in id and text that with the least hash of all its columns stays, so the same one in every run. Rows
    without words are classes of their own and stay.
    """
    aside, back = set_aside(docs, ("__id", "__hash", "__row", "__first"))
    found = near_duplicates(docs.select("doc_id", "text"), least, shingle).where("first").select(
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    keyed = aside.withColumns({"__id": F.coalesce("doc_id", F.lit(2**63 - 1)), "__hash": F.xxhash64(F.coalesce("text", F.lit("")))})
    worded = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    told = [F.col(f"`{f.name}`") for f in aside.schema if "map<" not in f.dataType.simpleString()]  # maps have no hash
    whole = F.struct(*[F.col(f"`{c}`") for c in aside.columns])
    kept = keyed.where(worded).join(found.hint("shuffle_hash"), ["__id", "__hash"]).groupBy("__id", "__hash").agg(
        F.min_by(whole, F.xxhash64(*told)).alias("__row"))
    return kept.select("__row.*").unionByName(aside.where(~worded)).withColumnsRenamed(back).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents", "doc_id", "text")).select("doc_id", "class_id", "n_links")
