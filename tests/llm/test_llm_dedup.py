"""Line, substring, suffix and near-copy dedup against plain models."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from vecloom.llm.chunks import PARTITION_BITS, PLACE_BITS, Chunk, chunk_number
from vecloom.llm.components import components
from vecloom.llm.line_dedup import dedup_lines, drop_repeated_lines
from vecloom.llm.ngram_join import LEAST, ROW_BITS, SHINGLE, Limits, Paths, _identities, count_paths, drop_near_duplicates, maybe_links, near_duplicates, similar
from vecloom.llm.substring_dedup import substring_dedup
from vecloom.llm import suffix_dedup as suffix_module
from vecloom.llm.suffix_dedup import DEPTH, common_prefixes, front_code, front_decode, merge_runs, suffix_dedup

LAST = 2**63 - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def order(doc_id):
    return LAST if doc_id is None else doc_id


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def mixed(seed: int, sep: str = "") -> list[tuple]:
    """Texts that share passages, with rows that are null, empty, repeated, without an id, or very repetitive."""
    r = random.Random(seed)
    base = [sep.join(r.choice(["ab", "c", "dé", "日", "e\n"]) for _ in range(150)) for _ in range(4)]
    docs = []
    for i in range(120):
        text = ""
        for _ in range(r.randint(0, 4)):
            start = r.randint(0, 200)
            text += r.choice(base)[start:start + r.randint(10, 160)] + sep.join(r.choice("xyz") for _ in range(r.randint(0, 30))) + sep
        docs.append((None if i % 40 == 7 else i, text))
    docs += [(500, None), (501, ""), (502, "a" * 300), (503, "a" * 120 + "b"), (504, "ab " * 100), (505, "b" + "ab " * 60), (7, docs[9][1]),
             docs[3], docs[3], (None, docs[5][1]), (506, "q" * 49), (507, "q" * 50), (508, " \t\n")]
    r.shuffle(docs)
    return docs


def run(spark, docs, operator):
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    return sorted((tuple(row) for row in operator(frame).collect()), key=str)


def spans(units: list, size: int, docs: list[tuple]) -> list[list[bool]]:
    """For each document, which of its units lie in a run of ``size`` that a smaller document has."""
    first: dict = {}
    for (doc_id, _), u in zip(docs, units):
        for p in range(len(u) - size + 1):
            key = u[p:p + size]
            first[key] = min(first.get(key, LAST), order(doc_id))
    found = []
    for (doc_id, _), u in zip(docs, units):
        gone = [False] * len(u)
        for p in range(len(u) - size + 1):
            if first[u[p:p + size]] < order(doc_id):
                gone[p:p + size] = [True] * size
        found.append(gone)
    return found


@pytest.mark.parametrize("hot_chunks", [1000, 1, 3])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot_chunks):
    """With a low limit all or many k-grams are hot, and their suffixes are dealt by the text around them."""
    monkeypatch.setattr(suffix_module, "HOT_CHUNKS", hot_chunks)
    docs = mixed(1)
    units = [(text or "").encode() for _, text in docs]
    wanted = []
    for (doc_id, _), data, gone in zip(docs, units, spans(units, DEPTH, docs)):
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        wanted.append((doc_id, len(data), sum(gone), runs, digest(kept)))
    assert run(spark, docs, lambda d: suffix_dedup(d).drop("kept")) == sorted(wanted, key=str)


def test_a_hot_phrase_is_spread_over_the_buckets():
    """Many texts share a phrase shorter than a window, in ever different surroundings."""
    r = random.Random(6)
    phrase = b"a phrase that stands in very many texts"[:37]
    texts = [bytes(r.choice(b"abcdefghijklmnop") for _ in range(60)) + phrase + bytes(r.choice(b"abcdefghijklmnop") for _ in range(60)) for _ in range(3000)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets, buckets = np.arange(3001) * 157, 64
    largest = {}
    for hot in (False, True):
        chunk = Chunk(0, data, offsets, pa.array(range(3000)), np.arange(3000), {}, {})
        grams = suffix_module.Grams(chunk, buckets)
        bodies = [body for _, body in grams.messages()]
        chunk.answers["grams"] = [suffix_module.shared_grams([body, body], 2 if hot else 3)[0] for body in bodies]
        sizes = np.diff(suffix_module.Suffixes(chunk, buckets).heads)
        largest[hot] = sizes.max() / (sizes.sum() / buckets)
    assert largest[False] > 2 and largest[True] < 1.3


def test_substring_dedup_equals_brute_force(spark):
    docs = mixed(2, " ")
    units = [tuple(WORD.findall(text or "")) for _, text in docs]
    wanted = []
    for (doc_id, _), words, gone in zip(docs, units, spans(units, 13, docs)):
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        wanted.append((doc_id, len(words), sum(gone), digest(kept.encode())))
    assert sum(w[2] for w in wanted) > 1000
    assert run(spark, docs, lambda d: substring_dedup(d).drop("kept")) == sorted(wanted, key=str)


def test_line_dedup_equals_a_plain_model(spark):
    docs = mixed(3) + [(900, "A long LINE here\n\nshort\nA long line here"), (901, "  a long line HERE\t\nmine alone is long"), (902, "short\nshort")]
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})
    holders: dict = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(order(doc_id))
    wanted = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        lost = [len(k := key(line)) >= 10 and len(holders[k]) > 1 and order(doc_id) > min(holders[k]) for line in lines]
        wanted.append((doc_id, "\n".join(line for line, x in zip(lines, lost) if not x), len(lines), sum(lost)))
    assert run(spark, docs, dedup_lines) == sorted(wanted, key=str)


def test_dropping_lines_keeps_columns_with_clashing_names(spark):
    rows = [(1, "the same long line", "x", 5), (2, "the same long line", "y", 6), (2, None, None, None)]
    found = drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string, hash string, n_lines int"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted([rows[0], (2, "", "y", 6), (2, "", None, None)], key=str)


def near_model(docs):
    sets = []
    for _, text in docs:
        words = WORD.findall(text or "")
        sets.append({tuple(words[j:j + 5]) for j in range(max(1, len(words) - 4))} if words else set())
    parent, links = list(range(len(docs))), [0] * len(docs)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 10 * common >= 8 * (len(sets[a]) + len(sets[b]) - common):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least: dict = {}
    for a, (doc_id, _) in enumerate(docs):
        least[root(a)] = min(least.get(root(a), LAST), order(doc_id))
    return [(doc_id, None if least[root(a)] == LAST else least[root(a)], links[a]) for a, (doc_id, _) in enumerate(docs)]


@pytest.fixture(scope="module")
def copies():
    r, docs = random.Random(3), []
    vocabulary = [f"w{i}" for i in range(400)]
    for size, many in [(3, 2), (8, 5), (60, 30), (200, 250), (60, 1), (5, 4), (120, 6)]:
        base = [r.choice(vocabulary) for _ in range(size)]
        for _ in range(many):
            text = list(base)
            for _ in range(r.randint(0, max(1, size // 30))):
                text[r.randrange(size)] = r.choice(vocabulary)
            docs.append((len(docs) * 3 % 997, " ".join(text)))
    return docs + [(None, docs[0][1]), (2000, None), (2001, ""), (2002, " \n"), (2003, "a b"), (2004, "a\tb"), (None, None),
                   (5, docs[3][1]), (None, "zz yy xx"), docs[9], docs[9]]


@pytest.mark.parametrize("limits", [Limits(), Limits(small=10, block=50, set_block=20)])
def test_similarity_join_equals_brute_force(spark, copies, limits):
    """With small limits paths are split to the end, and groups are compared block by block."""
    wanted = near_model(copies)
    assert max(w[2] for w in wanted) > 100
    assert run(spark, copies, lambda d: near_duplicates(d, limits=limits).select("doc_id", "class_id", "n_links")) == sorted(wanted, key=str)


@pytest.mark.parametrize("partition", [128, 255, 256, 10000, 2**PARTITION_BITS - 1])
def test_vertices_of_many_partitions(partition):
    """Vertices are the same numbers in both places that make them, fit 63 bits and differ between chunks."""
    text = " ".join(f"w{i}" for i in range(40)).encode()
    numbers = [chunk_number(partition, 3), chunk_number(partition - 1, 3)]
    chunks = [Chunk(n, np.frombuffer(text * 2, np.uint8), np.array([0, len(text), 2 * len(text)]), pa.array([1, 2]), np.array([1, 2]), {}, {}) for n in numbers]
    batch = pa.table({"chunk": numbers, "doc_id": [[1, 2]] * 2, "sizes": [[len(text)] * 2] * 2, "data": [text * 2] * 2}).to_batches()
    rows = [row for found in _identities(SHINGLE, LEAST)(iter(batch)) for row in found.to_pylist()]
    seeds = [row["vertex"] for row in rows]
    assert seeds == [(n << ROW_BITS) + row for n in numbers for row in (0, 1)] and max(seeds) < 2**63
    for chunk, row in zip(chunks, rows[1::2]):
        chunk.extra["sets"] = [{"row": 1, "n": 1, "paths": row["paths"]}]
    paths = lambda: [Paths(c, 1, LEAST, SHINGLE, Limits()) for c in chunks]
    answers = count_paths([body for p in paths() for _, body in p.messages()])
    for chunk, body in zip(chunks, answers):
        chunk.answers["paths1"] = [body]
    links = maybe_links([body for p in paths() for _, body in p.members()])
    assert set(links.column("u").to_pylist() + links.column("v").to_pylist()) == {seeds[1], seeds[3]}


def test_chunks_without_a_number_fail():
    assert PARTITION_BITS + PLACE_BITS + ROW_BITS == 63
    for partition, place in [(2**PARTITION_BITS, 0), (0, 2**PLACE_BITS)]:
        with pytest.raises(ValueError):
            chunk_number(partition, place)


def test_similarity_join_over_many_partitions(spark, copies):
    found = near_duplicates(spark.createDataFrame(copies, SCHEMA).repartition(140)).select("doc_id", "class_id", "n_links")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(near_model(copies), key=str)


def test_one_row_of_each_class_stays(spark, copies):
    docs = spark.createDataFrame([(*d, "a", i) for i, d in enumerate(copies)], SCHEMA + ", first string, text_hash int")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    wanted = near_model(copies)
    worded = {w[1] for w, d in zip(wanted, copies) if WORD.search(d[1] or "")}
    assert len(rows) == len(worded) + sum(not WORD.search(d[1] or "") for d in copies)
    assert {r.doc_id for r in rows if WORD.search(r.text or "")} == worded


def test_of_rows_equal_in_id_and_text_the_same_one_always_stays(spark):
    text = "one two three four five six seven"
    rows = [(1, text, f"s{i}", i, None) for i in range(20)] + [(None, text + " eight nine", "n", 1, 2)] * 3 + [(3, "", "e", 5, 5)] * 2
    docs = spark.createDataFrame(rows, SCHEMA + ", __id string, __hash int, vertex long")
    once, again = (drop_near_duplicates(docs.repartition(n)).collect() for n in (1, 7))
    assert sorted(map(str, once)) == sorted(map(str, again)) and docs.columns == drop_near_duplicates(docs).columns
    kept = [tuple(r) for r in once]
    assert len(kept) == 4 and kept.count((3, "", "e", 5, 5)) == 2 and (None, text + " eight nine", "n", 1, 2) in kept
    assert sum(r[0] == 1 and r in rows for r in kept) == 1


def test_exact_similarity_at_the_threshold():
    a, b = np.arange(9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64)
    assert similar([a, b], 0.8)[0, 1] and not similar([a, np.arange(2, 11, dtype=np.uint64)], 0.8)[0, 1]


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(5, 3), (3, 9), (9, 9), (7, 7), (50, 5), (-4, 60)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "u long, v long")).collect()))
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 3 for i in (3, 5, 9, 50)}, -4: -4, 60: -4}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_merged_runs_are_sorted_with_their_common_prefixes():
    r = random.Random(4)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))).ljust(DEPTH, r.choice([b"a", b"c"])) for _ in range(400)]
    runs, k = [], 7
    for i in range(k):
        own = sorted(strings[i::k])
        rows = np.frombuffer(b"".join(own), np.uint8).reshape(-1, DEPTH)
        runs.append((own, common_prefixes(rows).tolist()))
    run_, place, common = merge_runs(runs + [([], [])])
    merged = [runs[a][0][b] for a, b in zip(run_, place)]
    assert merged == sorted(strings)
    assert common == common_prefixes(np.frombuffer(b"".join(merged), np.uint8).reshape(-1, DEPTH)).tolist()


def test_front_coded_runs_come_back():
    r = np.random.default_rng(0)
    rows = r.integers(97, 100, (50, 80), np.uint8)
    rows[:, 78:] = 0
    rows = rows[np.lexsort(rows[:, ::-1].T)]
    documents = r.integers(0, 2**40, 50)
    records, shared, back = front_decode(front_code(rows, documents))
    assert (records == rows).all() and (back == documents).all() and (shared == common_prefixes(rows[:, :DEPTH])).all()


@pytest.mark.parametrize("operator", [suffix_dedup, substring_dedup, dedup_lines, near_duplicates, drop_near_duplicates])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
