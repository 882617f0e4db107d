"""Mixing sources, auditing them, and hard negatives, against plain models."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_queries import database, difference
from vecloom.llm import hard_negatives, source_audit, source_mix
from vecloom.llm.source_audit import OP12_SQL, audit_sources, sort_pointers
from vecloom.llm.source_mix import measured, mix_sources, mixed_documents

DOCS = "doc_id long, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# op 11 --------------------------------------------------------------------------------------------------------


def targets(sizes: dict, share: float = 1.5, most: int = 2) -> dict:
    """By the letter: share by weight, stop at the limit, share the excess again."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    found, left, open_ = dict.fromkeys(sizes, 0.0), share * sum(sizes.values()), set(sizes)
    while open_ and left > 1e-9:
        total, given = sum(weight[s] for s in open_), left
        for s in sorted(open_, key=str):
            found[s] += given * weight[s] / total
        left = sum(max(0.0, found[s] - most * sizes[s]) for s in open_)
        for s in list(open_):
            if found[s] >= most * sizes[s]:
                found[s] = float(most * sizes[s])
                open_.remove(s)
    return found


def walk(rows: list[tuple[int, int]], budget: int, walked: int) -> set[int]:
    """The hashes that a budget takes of ``(hash, size)``, by the rule of the plan."""
    low, shift, taken = 0, source_mix.HASH_BITS, set()
    while len(rows) > walked and shift >= source_mix.STEP_BITS:
        shift -= source_mix.STEP_BITS
        for bucket in sorted({h >> shift for h, _ in rows}):
            here = [r for r in rows if r[0] >> shift == bucket]
            size = sum(s for _, s in here)
            if budget < size:
                rows, low = here, bucket << shift
                break
            budget -= size
            taken |= {h for h, _ in here}
    units = Counter()
    for h, s in rows:
        units[h] += s
    spare = None
    for h in sorted(units):
        if units[h] <= budget:
            budget -= units[h]
            taken.add(h)
        elif spare is None or units[h] < units[spare]:
            spare = h
    if spare is not None and units[spare] - budget < budget:
        taken.add(spare)
    return taken


@pytest.mark.parametrize("walked", [512, 4])
def test_mix_equals_brute_force(spark, monkeypatch, walked):
    monkeypatch.setattr(source_mix, "WALKED", walked)
    r = random.Random(3)
    rows = [(i, r.choice([None, "", " a  b\n", "x " * r.randint(1, 400), "é ü z"]), r.choice(["hot"] * 6 + ["a", "B", "é", "", None, "z\U0001F600", "￿"])) for i in range(600)]
    rows += [(None, "same text", "a")] * 3 + [(7000, "w " * 3000, "B")]
    docs = spark.createDataFrame(rows, DOCS)
    sizes, sources = [len(WORD.findall(t or "")) for _, t, _ in rows], defaultdict(int)
    for (_, _, s), n in zip(rows, sizes):
        sources[s] += n
    wanted = targets(sources)
    found = mix_sources(docs).collect()
    assert sorted((str(x.doc_id), x.size) for x in found) == sorted((str(i), n) for (i, _, _), n in zip(rows, sizes))
    hashes = defaultdict(list)
    for x in measured(docs).collect():
        hashes[x.source].append((x._hash, x.size))
    known = {(x.doc_id, x.text, x.source): x._hash for x in measured(docs).collect()}
    chosen = {}
    for s in sources:
        aim = int(wanted[s] + 0.5)
        base = min(aim // sources[s], 2) if sources[s] else 0
        chosen[s] = base, walk(hashes[s], aim - base * sources[s], walked)
    for x in found:
        assert x.source_size == sources[x.source] and x.target == pytest.approx(wanted[x.source])
        base, extra = chosen[x.source]
        assert x.copies == base + (known[x.doc_id, x.text, x.source] in extra and base < 2)
    for s in sources:
        assert abs(sum(x.copies * x.size for x in found if x.source == s) - wanted[s]) <= max([n for (_, _, t), n in zip(rows, sizes) if t == s])


def test_mix_of_odd_tables(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    blank = mix_sources(spark.createDataFrame([(1, None, None), (2, "", "a"), (3, " \n", "a")], DOCS)).collect()
    assert [(x.size, x.source_size, x.target) for x in blank] == [(0, 0, 0.0)] * 3
    docs = spark.createDataFrame([(1, "a b c", "s", "kept", 9, 9)], DOCS + ", size_ string, size int, copies int")
    assert [(x.copies, x.size, x.size_) for x in mix_sources(docs).collect()] in ([(1, 3, "kept")], [(2, 3, "kept")])
    many = spark.createDataFrame([(i, "w " * (1 + i % 50), f"s{i % 2}") for i in range(2000)], DOCS)
    mixed = mixed_documents(many)
    assert mixed.columns == ["doc_id", "text", "source", "copy"] and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    words = {x.source: x.n for x in mixed.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()}
    aims = {x.source: x.target for x in mix_sources(many).select("source", "target").distinct().collect()}
    assert all(abs(words[s] - aims[s]) <= 50 for s in aims)


def test_larger_mixes_hold_smaller_ones(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "one") for i in range(3000)], DOCS)
    few, more = ({x.doc_id for x in mix_sources(docs, cycle=(1,), share=s).where("copies > 0").collect()} for s in (0.25, 0.5))
    assert len(few - more) <= 1 + source_mix.WALKED // 10 and len(more) > 1.8 * len(few)


def test_mix_query_comes_near_its_targets(spark, small):
    rows = source_mix.op11_source_mix(spark, small).toPandas()
    again = source_mix.op11_source_mix(spark, small).toPandas()
    assert rows.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source", "text").toPandas()
    docs["n"] = [len(WORD.findall(t or "")) for t in docs["text"]]
    both = rows.merge(docs, on="doc_id")
    assert (both["n"] == both["size"]).all() and (both["taken"] <= 2 * both["size"]).all()
    wanted = targets(docs.groupby("source")["n"].sum().to_dict())
    by_source = both.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), largest=("size", "max"))
    assert all(x.target == pytest.approx(wanted[s]) for s, x in by_source.iterrows())
    assert ((by_source["taken"] - by_source["target"]).abs() <= by_source["largest"]).all()


# op 12 --------------------------------------------------------------------------------------------------------


def test_pointers_are_sorted_by_their_words():
    r = random.Random(5)
    words = ["".join(r.choice("ab") for _ in range(r.choice([1, 2, 7, 8, 9, 16, 17, 40]))).encode() for _ in range(3000)] + ["é".encode() * 30, b"z" * 5000] * 3
    data = np.frombuffer(b" ".join(words), np.uint8)
    start = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    end = start + [len(w) for w in words]
    order, head = sort_pointers(data, start, end)
    assert [words[i] for i in order] == sorted(words)
    assert head.sum() == len(set(words)) and [words[i] for i in order[head]] == sorted(set(words))


def audited(rows: list[tuple], least: int, most: int = 50) -> list[tuple]:
    rows = [tuple(x or "" for x in row) for row in rows]
    term = re.compile(r"[a-z\x80-\U0010ffff]+")
    terms = [Counter(term.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))) for _, _, text in rows]
    found = []
    for lang in {x for x, _, _ in rows}:
        frequency = Counter(t for (x, _, _), words in zip(rows, terms) if x == lang for t in words)
        kept = sorted(t for t, n in frequency.items() if n >= least)
        counts = defaultdict(Counter)
        for (x, source, _), words in zip(rows, terms):
            if x == lang:
                counts[source].update({t: words[t] for t in kept if words[t]})
                counts[None].update({t: words[t] for t in kept if words[t]})

        def p(source, t):
            return 1 + 10**9 * (counts[source][t] + 5) // (sum(counts[source].values()) + 5 * len(kept))

        groups = {s for x, s, _ in rows if x == lang}
        for s in groups:
            pairs = [(o, sum(abs(p(s, t) - p(o, t)) for t in kept)) for o in groups if o != s]
            above = [(t, p(s, t) - p(None, t)) for t in kept if counts[s][t] and p(s, t) > p(None, t)]
            for part, items, limit in (("pair", pairs, 10**9), ("term", above, most)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda i: (-i[1], i[0].encode()))[:limit], 1):
                    found.append((lang, s, part, item, value, rank))
    return sorted(found)


@pytest.mark.parametrize("tile, shard, slice_", [(256, 500_000, 8 << 20), (2, 7, 50)])
def test_audit_equals_brute_force(spark, monkeypatch, tile, shard, slice_):
    for name, value in (("TILE_SOURCES", tile), ("SHARD_CELLS", shard), ("SHARD_BYTES", slice_), ("COLUMNS", 5)):
        monkeypatch.setattr(source_audit, name, value)
    r = random.Random(8)
    words = ["Der", "der", "é", "É", "don't", "x1y", "日本", "a" * 300, "\u0085", "_", "Z", "q\x7fq", *(f"w{i}" for i in "abcdefgh")]
    rows = [(r.choice(["en", "en", "de", None, ""]), r.choice(["s1", "s1", "S2", "é", "z", None, "\U0001F600"]), r.choice([None, "", "1 2", " ".join(r.choices(words, k=r.randint(1, 25)))]))
            for _ in range(250)] + [("en", "s1", "der der é")] * 40 + [("xx", "only", "alone"), ("yy", "none", "12"), ("yy", "other", None)]
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "lang string, source string, text string, n int, term string")
    found = sorted(map(tuple, audit_sources(docs, 6, 4).collect()))
    assert found == audited(rows, 6, 4) and {"pair", "term"} == {x[2] for x in found}


def test_audit_of_nothing_and_of_the_documents(spark, small):
    empty = audit_sources(spark.createDataFrame([], "lang string, source string, text string"))
    assert empty.count() == 0 and empty.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = source_audit.op12_source_audit(spark, small).toPandas()
    assert len(found) and difference(found, database(small).execute(OP12_SQL).df()) is None


def test_shares_of_huge_counts_are_exact(spark):
    n, total = 123_456_789_012_345, 9_876_543_210_123_456
    row = spark.createDataFrame([(n, total, 10**7)], "n long, total long, terms long").select(
        source_audit.share_of(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * 10**7)


# op 13 --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("m, k, n", [(1, 1, 1), (0, 5, 7), (40, 70, 33), (65, 129, 200), (128, 64, 300), (50, 0, 60)])
def test_products_are_exact(m, k, n):
    r = np.random.default_rng(m + k + n)
    a, b = (r.integers(-2**25, 2**25, (rows, k)) for rows in (m, n))
    assert (hard_negatives.product(a, b) == a @ b.T).all()


def mined(rows: list[tuple], anchors: set[int], positives: int = 5, negatives: int = 5) -> list[tuple]:
    found = []
    for at, (name, label, vector) in enumerate(rows):
        if name not in anchors:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), i, lab == label) for j, (i, lab, v) in enumerate(rows) if j != at)
        for minus, positive, _ in [s for s in scored if s[2]][:positives]:
            window = [s for s in scored if not s[2] and 80 * -minus <= 100 * -s[0] <= 100 * -minus]
            found += [(name, positive, rank, s[1], -minus, -s[0]) for rank, s in enumerate(window[:negatives], 1)]
    return sorted(found)


@pytest.mark.parametrize("sizes", [(2048, 16384, (128, 4096), 1024), (3, 17, (2, 5), 4)])
def test_negatives_equal_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("ANCHORS", "CANDIDATES", "AT_ONCE", "LEAST_CANDIDATES"), sizes):
        monkeypatch.setattr(hard_negatives, name, value)
    r = random.Random(11)
    rows = [(i, r.choice([0, 0, 0, 1, 2]), [r.randint(-9, 30) for _ in range(r.choice([0, 3, 70]))]) for i in range(150)]
    rows += [(200 + i, i % 2, [5, 5, 5]) for i in range(60)] + [(100, 1, [30, 2, 1]), (100, 0, [3, 20, 1]), (-100, 0, [1, 1, 1]), (10**12, 9, [1])]
    table = spark.createDataFrame([(*row, "x") for row in rows] + [(None, 1, [1], "x")], "id long, label int, vector array<long>, row string")
    found = hard_negatives.mine_negatives(table, F.col("id") % 50 == 0)
    wanted = mined(rows, {i for i, _, _ in rows if i % 50 == 0})
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) > 100
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]


def test_only_whole_rows_are_mined(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [1.0, 1.0]), (3, 1, None), (4, 1, [1.0, None]), (5, 1, [nan, 1.0]), (6, 1, [inf, 1.0]), (7, 1, [-inf, 1.0]), (8, 2, [])]
    table = spark.createDataFrame(rows, "id long, label int, v array<float>")
    assert sorted(map(tuple, hard_negatives.whole_vectors(table, "id", "label", "v").collect())) == [(1, 1, [128, -1]), (8, 2, [])]
    assert hard_negatives.mine_negatives(hard_negatives.whole_vectors(table.limit(0), "id", "label", "v"), F.col("id") == 1).count() == 0
    wide = spark.createDataFrame([(0, 1, [2.0**30] * 8)], "id long, label int, v array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.mine_negatives(hard_negatives.whole_vectors(wide, "id", "label", "v"), F.col("id") == 0)
