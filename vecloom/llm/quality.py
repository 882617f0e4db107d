"""Quality rules with repeats found by a suffix array of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vecloom.llm.common import WHITE, binaries, covered, flat, freed, owner, slices, sums, table, text_words
from vecloom.session import ship_package

#: Repeats of fewer words are no repeats.
REPEAT_WORDS = 5
#: Base rule: the fewest words, and the largest percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: The method's limits. Fixed values, as published for large text corpora: the percentage of word characters under repeats of
#: so many words or more. Longer repeats may cover less.
MOST_COVERED = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: And words in the longest repeat: half a page of running text, which no quotation or refrain repeats by chance.
LONGEST = 100

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "repeat_chars long, long_repeat_chars long, longest_repeat long, base_failed boolean, kept boolean")


def longest_repeats(ids: np.ndarray, first: np.ndarray, least: int = REPEAT_WORDS) -> np.ndarray:
    """For each word, how many words of the text from there on also start elsewhere in the same text; 0 if below ``least``.

    A suffix array by prefix doubling: level ``k`` ranks suffixes by their first 2^k words, and only suffixes that
    still tie are sorted again. The longest common prefix of neighbours is read off the levels, from the highest down.
    """
    n = len(ids)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    text = owner(first)
    stop = first[1:][text]
    key = (text << 32) | ids
    suffixes = np.argsort(key, kind="stable")
    slots, ordered = np.arange(n), key[suffixes]
    rank, levels, step = np.zeros(n, np.int64), [], 1
    while True:
        head = np.ones(len(slots), bool)
        head[1:] = ordered[1:] != ordered[:-1]
        bounds = np.append(np.flatnonzero(head), len(slots))
        sizes = np.diff(bounds)
        rank[suffixes[slots]] = np.repeat(slots[bounds[:-1]], sizes)
        levels.append(rank.astype(np.int32) if n < 2**31 else rank.copy())
        tied = np.repeat(sizes > 1, sizes)
        if not tied.any():
            break
        slots = slots[tied]
        members = suffixes[slots]
        further = members + step
        inside = further < stop[members]
        second = np.where(inside, rank[np.minimum(further, n - 1)] + 1, 0)
        key = (rank[members] << 32) | second
        order = np.argsort(key, kind="stable")
        suffixes[slots], ordered = members[order], key[order]
        step *= 2
    a, b = suffixes[:-1], suffixes[1:]
    sure = min(least.bit_length() - 1, len(levels) - 1)
    near = np.flatnonzero(levels[sure][a] == levels[sure][b])
    common = np.zeros(len(near), np.int64)
    left, right = a[near], b[near]
    for k in range(len(levels) - 1, -1, -1):
        x, y = left + common, right + common
        open_ = (x < stop[left]) & (y < stop[right])
        same = open_ & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)]) & (text[left] == text[right])
        common += same.astype(np.int64) << k
    common[common < least] = 0
    np.maximum.at(best, left, common)
    np.maximum.at(best, right, common)
    return best


def repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, its lines with a word that equal an earlier line of it."""
    newline = data == 0x0A
    breaks = np.flatnonzero(newline)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    document = np.sort(np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1]))
    skipped = np.concatenate([[0], np.cumsum(newline)])
    lines = binaries(data[~newline], np.append(starts - skipped[starts], len(data) - skipped[-1]))
    marks = np.concatenate([[0], np.cumsum(~WHITE[data])])
    some = np.diff(np.append(marks[starts], marks[-1])) > 0
    ids = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keys = np.sort((document[some] << 32) | ids[some])
    again = keys[1:][keys[1:] == keys[:-1]] >> 32
    return np.bincount(again, minlength=len(offsets) - 1)


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = flat(texts)
    words = text_words(data, offsets)
    n_words = words.counts()
    bounds = np.append(0, np.cumsum(words.end - words.start))
    letters, _ = flat(words.values)
    points = sums((letters & 0xC0) != 0x80, bounds)
    best = longest_repeats(words.ids(), words.first)
    word_chars, chars, fair = sums(points, words.first), {}, np.ones(len(n_words), bool)
    for least, most in MOST_COVERED.items():
        found = np.flatnonzero(best >= least)
        under = covered(found, found + best[found], len(best))
        chars[least] = sums(points * under, words.first)
        fair &= 100 * chars[least] <= most * word_chars
        if least == REPEAT_WORDS:
            repeated = sums(under, words.first)
    longest = np.zeros(len(n_words), np.int64)
    np.maximum.at(longest, owner(words.first), best)
    failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
    kept = ~failed & fair & (longest <= LONGEST)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": sums(SYMBOLS[data], offsets),
            "n_dup_lines": repeated_lines(data, offsets), "n_repeat_words": repeated, "repeat_chars": chars[REPEAT_WORDS],
            "long_repeat_chars": chars[max(MOST_COVERED)], "longest_repeat": longest, "base_failed": failed, "kept": kept}


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = measure(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, found.values())], ["doc_id", *found])


def quality_measures(docs: DataFrame) -> DataFrame:
    """One row of measures and the verdict per document.

    A repeat is a run of at least five words that stands at two or more places of one text; ``n_repeat_words`` counts
    the words under any repeat, ``repeat_chars`` their characters, ``long_repeat_chars`` those under repeats of ten words or
    more, ``longest_repeat`` the words of the longest. ``base_failed``: fewer than ten words, or over a fifth of the words
    under repeats. ``kept``: not failed, no repeat of over ``LONGEST`` words, and no more characters under repeats of 5, 6,
    ... 10 words or more than ``MOST_COVERED`` allows, 15 % down to 10 %. So the method decides where the base rule does not:
    on repeats of longer words than the others, and on long passages that stand twice.

    Null and empty texts have no words and fail. Rows with equal or null ids are judged each by itself. Texts are
    worked on in slices of bounded size; only one text longer than a slice takes memory beyond it.
    """
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(freed(_measured), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {MEASURES}")


def _good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield part.filter(pa.array(measure(part.column("text"))["kept"]))


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_measures` keeps, with all their columns."""
    ship_package(docs.sparkSession)
    return docs.mapInArrow(freed(_good), docs.schema)


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_measures(table(spark, folder, "documents", "doc_id", "text"))
