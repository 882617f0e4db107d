"""Clashing column names, empty and null tables, and texts longer than a slice, through the operators and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vecloom.llm import chunks as chunk_module
from vecloom.llm import decontaminate
from vecloom.llm.byte_bpe import digests, multilingual
from vecloom.llm.common import SLICE_BYTES
from vecloom.llm.decontaminate import benchmark_hits, contaminated
from vecloom.llm.line_dedup import dedup_lines, drop_repeated_lines
from vecloom.llm.ngram_join import near_duplicates
from vecloom.llm.quality import quality_measures
from vecloom.llm.source_audit import audit_sources
from vecloom.llm.source_mix import mix_sources
from vecloom.llm.substring_dedup import substring_dedup
from vecloom.llm.suffix_dedup import suffix_dedup
from vecloom.llm.tokens_file import read_documents, word_tokenizer, write_tokens
from vecloom.session import new_path

SCHEMA = "doc_id long, text string"
#: Every name that an operator of the pipeline gives a column it works with.
NAMES = ["__doc", "__text", "__lost", "__line", "__key", "__id", "__hash", "__row", "__first", "pos", "hash", "first", "last", "n", "n_lines", "n_dropped",
         "n_words", "n_hit", "item_ids", "hits", "kept", "base_failed", "vertex", "digest", "paths", "size", "chunk", "bucket", "body", "data", "sizes", "set", "sets",
         "class_id", "n_links", "text_hash", "root", "name", "block", "_kept___id", "two words"]


@pytest.fixture(scope="module")
def named(spark):
    """Documents with a column of each of these names, and what stands there per document."""
    r = random.Random(2)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(60)) + f"\na line that all share\nown line {i}" for i in range(12)]
    rows = [(i, text, *[f"{name}-{i}" for name in NAMES]) for i, text in enumerate([*texts, texts[0]])]
    return spark.createDataFrame(rows, ["doc_id", "text", *NAMES])


@pytest.mark.parametrize("stage", range(4))
def test_columns_of_any_name_come_through(spark, named, small, stage):
    found = corpus_pipeline.STAGES[stage][1](spark, named, small)
    assert found.columns == named.columns
    rows = found.collect()
    assert len(rows) in (12, 13) and all(row[name] == f"{name}-{row.doc_id}" for row in rows for name in NAMES)


def test_dedup_lines_keeps_other_columns(spark, named):
    found = dedup_lines(named)
    assert found.columns == [c for c in named.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    assert all(row["__doc"] == f"__doc-{row.doc_id}" and row.n_dropped in (0, 1, 2, 3) for row in found.collect())
    assert drop_repeated_lines(named).where("`__lost` IS NULL").count() == 0


@pytest.mark.parametrize("texts", [[], [None, None, "", " \n"], [None, "", "one two", "ten words are what the first rule wants at least here now"]])
def test_pipeline_on_empty_and_null_tables(spark, tmp_path, texts):
    rows = [(i if i else None, t, None, None, None) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [r.doc_id for r in found] == [i for i, t in enumerate(texts) if t and len(t.split()) >= 10]


@pytest.fixture(scope="module")
def long_text():
    r = random.Random(7)
    text = "\n".join(" ".join(f"{r.choice('abcdefgh')}{r.randrange(10**9):x}" for _ in range(12)) for _ in range(45_000))
    assert len(text) > SLICE_BYTES
    return text


def test_a_text_longer_than_a_slice(spark, long_text, tmp_path):
    """One long text, a copy of it, and short ones around it."""
    docs = spark.createDataFrame([(1, "a short text"), (2, long_text), (3, long_text), (4, "another short one")], SCHEMA).coalesce(1).orderBy("doc_id")
    data, words = long_text.encode(), long_text.split()
    nothing = hashlib.sha256(b"").hexdigest()
    assert {(r.doc_id, r.n_removed) for r in suffix_dedup(docs).collect()} == {(1, 0), (2, 0), (3, len(data)), (4, 0)}
    assert {(r.doc_id, r.n_words) for r in quality_measures(docs).collect()} == {(1, 3), (2, len(words)), (3, len(words)), (4, 3)}
    lines = {r.doc_id: (r.n_lines, r.n_dropped) for r in dedup_lines(docs).collect()}
    assert lines == {1: (1, 0), 2: (45_000, 0), 3: (45_000, 45_000), 4: (1, 0)}
    assert {(r.doc_id, r.class_id, r.n_links) for r in near_duplicates(docs).collect()} == {(1, 1, 0), (2, 2, 1), (3, 2, 1), (4, 4, 0)}
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(docs).collect()}
    assert found[3] == (len(words), len(words), nothing) and found[2][1] == 0
    coded = {r.doc_id: r for r in digests(docs, multilingual()).collect()}
    assert coded[2].decoded_sha256 == hashlib.sha256(data).hexdigest() and coded[2].ids_sha256 == coded[3].ids_sha256
    path = new_path(spark, "tokens")
    write_tokens(docs, word_tokenizer(), path)
    read = {r.doc_id: r for r in read_documents(spark, path).collect()}
    assert read[2].n_tokens == read[3].n_tokens > len(words) and read[3].start == read[2].start + read[2].n_tokens
    item = spark.createDataFrame([(1, " ".join(words[500:520])), (2, "not there at all")], "item_id long, text string")
    hit = {r.doc_id: (r.n_words, r.n_hit) for r in benchmark_hits(docs, item).collect()}
    assert hit[2] == hit[3] == (len(re.findall("[a-z0-9]+", long_text)), 20) and hit[1] == (3, 0)
    sourced = docs.select("*", F.lit("en").alias("lang"), (F.col("doc_id") % 2).cast("string").alias("source"))
    assert {(r.source, r.part) for r in audit_sources(sourced, 2).collect()} >= {("0", "pair"), ("1", "pair")}
    assert {r.doc_id: r.size for r in mix_sources(sourced).collect()} == {1: 3, 2: len(words), 3: len(words), 4: 3}


def test_chunks_go_on_beyond_the_largest_number_of_buckets(spark, monkeypatch):
    """With the limits lowered, chunks are dealt to few files by a shuffle, and exchanges have tasks of their own."""
    for name, value in (("MOST_BUCKETS", 4), ("MOST_FILES", 0), ("FILE_BYTES", 100), ("BUCKET_BYTES", 50), ("CHUNK_BYTES", 100)):
        monkeypatch.setattr(chunk_module, name, value)
    phrase = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(i, f"{phrase} own{i} words{i}") for i in range(40)], SCHEMA).repartition(6)
    chunks, buckets = chunk_module.write_chunks(docs)
    assert len(chunks.inputFiles()) <= 4 and buckets > 40
    assert {(r.doc_id, r.n_removed) for r in substring_dedup(docs).collect()} == {(i, 13 if i else 0) for i in range(40)}
    size = len(phrase) + len(" own")  # and the first digit of two, which an earlier document has too
    assert {(r.doc_id, r.n_removed) for r in suffix_dedup(docs).collect()} == {(0, 0)} | {(i, size + (i >= 10)) for i in range(1, 40)}


def test_equal_benchmark_items_are_one_and_blocks_stay_small(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(30))
    items = [(i, text) for i in range(3000)] + [(5000 + i, f"{text} other{i} " + " ".join(f"x{i}y{j}" for j in range(20))) for i in range(50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    seen = []
    make = decontaminate.Windows.__init__

    def sized(self, names, texts, window):
        seen.append(sum(map(len, texts)) + sum(len(n) + 8 for own in names for n in own))
        make(self, names, texts, window)

    monkeypatch.setattr(decontaminate.Windows, "__init__", sized)
    docs = spark.createDataFrame([(1, text), (2, "x7y3 " + " ".join(f"x7y{j}" for j in range(20))), (3, None)], SCHEMA)
    whole = benchmark_hits(docs, bench).withColumn("bad", contaminated()).orderBy("doc_id").collect()
    assert len(seen) == 1 and [len(r.item_ids) for r in whole] == [3050, 1, 0]
    seen.clear()
    cut = benchmark_hits(docs, bench, block_bytes=5_000).withColumn("bad", contaminated()).orderBy("doc_id").collect()
    assert cut == whole and len(seen) > 3 and sorted(seen)[-2] <= 5_000  # all ids of the 3,000 equal items are one entry
