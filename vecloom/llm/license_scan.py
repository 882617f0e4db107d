"""Licence scans: spans of words compared with licence templates."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.common import flat, freed, slices, table
from vecloom.llm.decontaminate import item_words
from vecloom.llm.license_templates import known_licences
from vecloom.session import ship_package

#: Least Dice coefficient of a match.
LEAST = 0.9
#: Templates above this size together are refused: they go to every worker.
LARGEST = 16 << 20
#: Spans that are scored at once.
SCORED = 1 << 20
#: Spellings that count as one.
SAME = {b"licence": b"license", b"licences": b"licenses", b"licenced": b"licensed", b"sublicence": b"sublicense"}


class Templates:
    """The word bigrams of each template, and how many bigrams a span may have to be as similar as ``least``.

    With ``i`` common bigrams, sizes ``n`` and ``b``, Dice is 2 i / (n + b). As i is at most n and at most b, n must lie
    between b * least / (2 - least) and b * (2 - least) / least, and i must reach that lower bound.
    """

    def __init__(self, templates: dict[str, str], least: float) -> None:
        self.names, self.least = sorted(templates), least
        words = [[SAME.get(w, w) for w in item_words(pa.array([templates[name]])).values.to_pylist()] for name in self.names]
        self.vocabulary = sorted({w for own in words for w in own})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.lookup = pa.array([*self.vocabulary, *(w for w in SAME if w not in number)], pa.large_binary())
        self.meaning = np.array([*range(len(number)), *(number.get(SAME[w], -1) for w in SAME if w not in number)], np.int64)
        grams = [[number[a] * len(number) + number[b] for a, b in zip(own, own[1:])] for own in words]
        self.grams = np.unique(np.array([g for own in grams for g in own], np.int64))
        self.counts = [Counter(np.searchsorted(self.grams, own).tolist()) for own in grams]
        self.sizes = [len(own) for own in grams]
        self.low = [max(1, math.ceil(b * least / (2 - least) - 1e-9)) for b in self.sizes]
        self.high = [math.floor(b * (2 - least) / least + 1e-9) for b in self.sizes]

    def of_words(self, words: pa.Array) -> np.ndarray:
        """For each word, the template bigram it begins, or -1; the last word begins none."""
        found = pc.fill_null(pc.index_in(words, value_set=self.lookup), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.where(found < 0, -1, self.meaning[np.maximum(found, 0)])
        pair = np.full(len(ids), -1, np.int64)
        if len(ids) > 1:
            known = (ids[:-1] >= 0) & (ids[1:] >= 0)
            gram = ids[:-1] * len(self.vocabulary) + ids[1:]
            at = np.minimum(np.searchsorted(self.grams, gram), max(len(self.grams) - 1, 0))
            pair[:-1] = np.where(known & (len(self.grams) > 0) & (self.grams[at] == gram if len(self.grams) else False), at, -1)
        return pair


class Hits:
    """The bigrams of one template in some texts, ascending: bigram number, text, and the hit before which a span has to
    start no earlier for this one to count, as the template holds a bigram only so many times."""

    def __init__(self, at: np.ndarray, text: np.ndarray, gram: np.ndarray, counts: Counter, size: int, high: int) -> None:
        self.at, self.text, self.size, self.high = at, text, size, high
        order = np.lexsort((at, gram, text))
        many = np.zeros(int(gram.max()) + 1, np.int64)
        for g, n in counts.items():
            if g < len(many):
                many[g] = n
        back = np.arange(len(at)) - many[gram[order]]
        before = order[np.maximum(back, 0)]
        same = (back >= 0) & (gram[before] == gram[order]) & (text[before] == text[order])
        self.spent = np.full(len(at), -1, np.int64)
        self.spent[order] = np.where(same, before, -1)

    def best(self, start: np.ndarray, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each hit a span starts at, the largest coefficient and the first hit that it can end at, before word ``limit``."""
        dice, stop = [np.zeros(0)], [np.zeros(0, np.int64)]
        step = max(1, SCORED // self.high)
        for a in range(0, len(start), step):
            own = start[a:a + step, None]
            to = own + np.arange(self.high)
            inside = to < len(self.at)
            to = np.minimum(to, len(self.at) - 1)
            length = self.at[to] - self.at[own] + 1
            inside &= (self.text[to] == self.text[own]) & (length <= self.high)
            if limit is not None:
                inside &= self.at[to] + 1 < limit
            common = np.cumsum(inside & (self.spent[to] < own), axis=1)
            score = np.where(inside, 2 * common / (length + self.size), 0.0)
            end = score.argmax(axis=1)
            dice.append(score[np.arange(len(end)), end])
            stop.append(to[np.arange(len(end)), end])
        return np.concatenate(dice), np.concatenate(stop)


def word_matches(texts: pa.Array, templates: Templates) -> list[list[tuple[str, float, int, int]]]:
    """For each text the templates that it holds, with the best span of each, from any word to any word.

    Of all similar spans of all templates in a text, the most similar is taken first, then the next that shares no word
    with one taken before, and so on; ties go to the larger template, the first, then the shortest span.
    """
    data, offsets = flat(texts)
    words = item_words(texts)
    found: list[list[tuple[str, float, int, int]]] = [[] for _ in range(len(texts))]
    if not len(words.values):
        return found
    gram = templates.of_words(words.values)
    gram[words.first[1:][words.counts() > 0] - 1] = -1  # no bigram of two texts
    known = np.flatnonzero(gram >= 0)
    gram = gram[known]
    text = np.searchsorted(words.first, known, side="right") - 1
    hits: dict[int, Hits] = {}
    spans: dict[int, list[tuple[float, int, int, int, int, int]]] = {}
    for t, (counts, size, low, high) in enumerate(zip(templates.counts, templates.sizes, templates.low, templates.high)):
        if not size:
            continue
        mine = np.zeros(len(templates.grams), bool)
        mine[list(counts)] = True
        own = np.flatnonzero(mine[gram])
        for narrowed in (False, True):  # first all texts, then those where enough hits are near each other
            first = np.arange(max(0, len(own) - low + 1))
            last = own[first + low - 1]
            first = first[(text[last] == text[own[first]]) & (known[last] - known[own[first]] < high)]
            if not narrowed and len(first):
                own = own[np.isin(text[own], text[own[first]])]
        if not len(first):
            continue
        hits[t] = Hits(known[own], text[own], gram[own], counts, size, high)
        dice, stop = hits[t].best(first)
        for d, a, b in zip(dice.tolist(), first.tolist(), stop.tolist()):
            if d >= templates.least:
                spans.setdefault(int(text[own[a]]), []).append((-d, -size, int(known[own[a]]), int(known[own[b]]) + 1, t, a))
    newlines = np.concatenate([[0], np.cumsum(data == 0x0A)])
    for document, heap in spans.items():
        heapq.heapify(heap)
        taken: list[tuple[int, int]] = []
        named: dict[int, tuple[str, float, int, int]] = {}
        while heap:
            dice, size, start, stop, t, hit = heapq.heappop(heap)
            after = bisect_left(taken, (start + 1,))
            if after and taken[after - 1][1] >= start:
                continue
            if after < len(taken) and taken[after][0] <= stop:  # what ends before the taken span may still be similar
                scores, ends = hits[t].best(np.array([hit]), taken[after][0])
                if scores[0] >= templates.least:
                    heapq.heappush(heap, (-float(scores[0]), size, start, int(hits[t].at[ends[0]]) + 1, t, hit))
                continue
            insort(taken, (start, stop))
            lines = newlines[words.start[[start, stop]]] - newlines[offsets[document]]
            named.setdefault(t, (templates.names[t], -dice, int(lines[0]), int(lines[1])))
        found[document] = [named[t] for t in sorted(named)]
    return found


def license_matches(docs: DataFrame, licences: dict[str, str], least: float = LEAST) -> DataFrame:
    """``(doc_id, matches)``: the licence templates that each text holds, by name, with the coefficient and the lines.

    Texts and templates are normalised to lower-cased words without punctuation, and spellings of "licence" count as
    one. Every span of words is compared with every template by the Dice coefficient over word bigrams, counted
    with repeats; bounds on the size of a span and on the hits it needs leave few spans to compare. Of spans that share
    words only the most similar counts, so a version number decides. Null and empty texts
    match nothing; repeated rows and rows without an id are scanned each by itself; other columns are ignored.
    """
    if sum(map(len, licences.values())) > LARGEST:
        raise ValueError("the templates are too large to send to every worker")
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(licences)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(sent.value, least)
        kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32())]))
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [[dict(zip(("license", "dice", "first_line", "last_line"), m)) for m in own] for own in word_matches(part.column("text"), templates)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind)], ["doc_id", "matches"])

    return docs.select("doc_id", "text").mapInArrow(freed(scan), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, matches array<struct<license:string,dice:double,first_line:int,last_line:int>>")


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: how many licences it names, which (sorted, comma-joined), and the most similar, ties by name."""
    found = license_matches(table(spark, folder, "documents", "doc_id", "text"), known_licences())
    best = F.get(F.array_sort("matches", lambda a, b: F.when(a["dice"] != b["dice"], F.when(a["dice"] > b["dice"], -1).otherwise(1)).otherwise(
        F.when(a["license"] < b["license"], -1).otherwise(1))), F.lit(0))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_licenses"), F.array_join(F.array_sort("matches.license"), ",").alias("licenses"),
                        best["license"].alias("best_license"), best["dice"].alias("best_dice"))
