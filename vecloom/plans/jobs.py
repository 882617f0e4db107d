"""The stages as jobs from folder to folder, with text files between them, and the run of all of them.

    python -m vecloom.plans.jobs STAGE FOLDER... [--settings FILE] [--set NAME=VALUE]... [--vocabulary RANK_FILE] [--rejected FOLDER]

    word-frequency INPUT OUTPUT
    shard-lines    INPUT OUTPUT
    tokenize       LINE_SHARDS OUTPUT
    shard-tokens   TOKENS MERGED OUTPUT
    embeddings     TOKEN_SHARDS OUTPUT LOSSES
    merge          PARTS OUTPUT
    similarity     EMBEDDINGS OUTPUT
    run            INPUT WORD_COUNT LINE_SHARDS TOKENS MERGED_TOKENS TOKEN_SHARDS EMBEDDINGS LOSSES MERGED_EMBEDDINGS NEIGHBOURS

``--settings`` names a file of ``name=value`` lines (blank lines and those from # on do not count) with any fields of
``Params``, and ``--set`` gives single ones, which win; the vocabulary size is that of the rank file unless it is set. A job replaces
its output. A missing input, or any failure, stops the run with Spark's error. Each stage but merge prints its counts as JSON:
lines, tokens, rows read and rejected, taken while the results are written. Rows that cannot be read go to the folder
``--rejected``, as ``reason TAB row``.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.operators.accounts import Judged, set_apart
from vecloom.operators.embeddings import dedupe_embeddings, format_embeddings, judge_embeddings
from vecloom.operators.lines import judge_numbered_lines, judge_token_lines, parse_token_shard, shard_lines, token_line_text, word_count_text
from vecloom.operators.similarity import format_neighbours, top_k_similar
from vecloom.operators.tokens import shard_texts, shard_tokens, token_stream, tokenize_lines, word_frequency
from vecloom.operators.training import train_embeddings
from vecloom.params import Params
from vecloom.plans.neighbours import name_neighbours
from vecloom.session import new_path, write_table
from vecloom.sources.sinks import merge_part_files, write_parquet, write_rejected, write_shards, write_text
from vecloom.sources.text_files import corpus_lines, numbered_corpus
from vecloom.sources.vocabulary import Vocabulary, vocabulary_size, vocabulary_table


def _values(spark: SparkSession, source: str) -> DataFrame:
    return corpus_lines(spark, source).withColumnRenamed("line", "value")


def _apart(judged: DataFrame, rejected: str | None) -> Judged:
    """Rows that can be read, and where asked for the others as files in the folder ``rejected``."""
    found = set_apart(judged)
    if rejected:
        write_rejected(found.rejected, rejected)
    return found


def _counts(found: Judged) -> dict[str, int]:
    return {"read": found.counts["read"], "rejected": found.counts["rejected"]}


def word_frequency_job(spark: SparkSession, source: str, target: str, vocabulary: Vocabulary) -> dict[str, int]:
    """Corpus files to ``text n id`` lines, by id. Counts the tokens and the distinct ones."""
    counts = write_table(word_frequency(corpus_lines(spark, source), vocabulary), "counts")  # ordering reads it twice
    return write_text(counts.select("token", "n", word_count_text().alias("value")), target, ["token"],
                      {"tokens": F.sum("n"), "distinct": F.count(F.lit(1))})


def shard_lines_job(spark: SparkSession, source: str, target: str, params: Params) -> dict[str, int]:
    """Corpus files to ``number TAB line`` files in ``shard=i`` folders. Counts the lines."""
    dealt = shard_lines(numbered_corpus(spark, source), params.num_shards)
    text = F.concat_ws("\t", F.col("line_no").cast("string"), "line")
    return write_shards(dealt.select("shard", "line_no", text.alias("value")), target, "line_no", {"lines": F.count(F.lit(1))})


def tokenize_job(spark: SparkSession, source: str, target: str, vocabulary: Vocabulary, rejected: str | None = None) -> dict[str, int]:
    """``number TAB line`` files to ``number TAB id id`` lines, in line order. Counts lines, tokens, and rows read and rejected."""
    found = _apart(judge_numbered_lines(_values(spark, source), strict=True), rejected)
    ordered = found.kept.repartitionByRange("line_no").sortWithinPartitions("line_no")
    tokenised = tokenize_lines(ordered, vocabulary)
    return _counts(found) | write_text(tokenised.select("tokens", token_line_text().alias("value")), target,
                                       counts={"lines": F.count(F.lit(1)), "tokens": F.sum(F.size("tokens"))})


def shard_tokens_job(spark: SparkSession, source: str, merged: str, target: str, params: Params, rejected: str | None = None) -> dict[str, int]:
    """``number TAB id id`` lines to the token stream (Parquet ``pos, token``) and to id lines in ``shard=i`` folders.

    Counts tokens, rows read and rejected, and the words of kept rows that are no ids.
    """
    judged = judge_token_lines(_values(spark, source))
    found = set_apart(judged, {"skipped": F.sum(F.when(F.col("reason").isNull(), F.col("skipped")))})
    if rejected:
        write_rejected(found.rejected, rejected)
    counts = write_parquet(token_stream(found.kept, ["line_no"]), merged, {"tokens": F.count(F.lit(1))})
    dealt = shard_tokens(spark.read.parquet(merged), params.num_shards_embeddings)
    write_shards(shard_texts(dealt), target, "line")
    return _counts(found) | {"skipped": found.counts["skipped"]} | counts


def embeddings_job(spark: SparkSession, source: str, target: str, losses: str, params: Params) -> dict[str, int]:
    """Id lines to ``id TAB [f,f,...]`` lines, by id, and to ``round rate loss stopped`` lines. Counts tokens and vectors."""
    order, path = ["file", "block", "seq"], new_path(spark, "ids")
    ids = parse_token_shard(_values(spark, source), order)
    counts = write_parquet(ids, path, {"tokens": F.sum(F.size("tokens"))})
    trained = train_embeddings(spark.read.schema(ids.schema).parquet(path), order, params)
    single = trained.embeddings.withColumn("embedding", F.col("embedding").cast("array<float>"))
    counts |= write_text(format_embeddings(single, digits=None), target, ["token"], {"vectors": F.count(F.lit(1))})
    rows = trained.history(spark)
    write_text(rows.select("round", F.concat_ws(" ", *[F.col(c).cast("string") for c in rows.columns]).alias("value")), losses, ["round"])
    return counts


def similarity_job(spark: SparkSession, source: str, target: str, params: Params, vocabulary: Vocabulary, rejected: str | None = None) -> dict[str, int]:
    """``id TAB [f,f,...]`` lines to ``text:id TAB text:id:sim ...`` lines, by id. The last line of an id counts.

    Counts rows read and rejected, and the tokens.
    """
    found = _apart(judge_embeddings(_values(spark, source), ["file", "block", "seq"], strict=True), rejected)
    ordered = found.kept.select("token", F.struct("file", "block", "seq").alias("loaded"), "embedding")
    embeddings = write_table(dedupe_embeddings(ordered, "token", "loaded").select("token", "embedding"), "dictionary")
    named = name_neighbours(top_k_similar(embeddings, params.neighbours), vocabulary_table(spark, vocabulary))
    return _counts(found) | write_text(write_table(format_neighbours(named), "neighbours"), target, ["token"], {"tokens": F.count(F.lit(1))})


def run(spark: SparkSession, paths: Sequence[str], params: Params, vocabulary: Vocabulary, rejected: str | None = None) -> dict[str, dict[str, int]]:
    """All jobs in order over the ten folders of the usage line; the counts of each by its stage."""
    corpus, counts, line_shards, tokens, merged, token_shards, embeddings, losses, dictionary, neighbours = paths
    apart = {stage: rejected and f"{rejected.rstrip('/')}/{stage}" for stage in ("tokenize", "shard-tokens", "similarity")}
    found = {"word-frequency": word_frequency_job(spark, corpus, counts, vocabulary),
             "shard-lines": shard_lines_job(spark, corpus, line_shards, params),
             "tokenize": tokenize_job(spark, line_shards, tokens, vocabulary, apart["tokenize"]),
             "shard-tokens": shard_tokens_job(spark, tokens, merged, token_shards, params, apart["shard-tokens"]),
             "embeddings": embeddings_job(spark, token_shards, embeddings, losses, params)}
    merge_part_files(spark, embeddings, dictionary)
    return found | {"similarity": similarity_job(spark, dictionary, neighbours, params, vocabulary, apart["similarity"])}


#: For each stage, how many folders it takes and whether it needs a vocabulary.
STAGES = {
    "word-frequency": (2, True), "shard-lines": (2, False), "tokenize": (2, True), "shard-tokens": (3, False),
    "embeddings": (3, False), "merge": (2, False), "similarity": (2, True), "run": (10, True)}


def settings(given: Sequence[str]) -> Params:
    """``Params`` with ``name=value`` settings, each read as the type of its default."""
    kinds = {f.name: type(f.default) for f in fields(Params)}
    chosen = {}
    for setting in given:
        name, found, value = setting.partition("=")
        if not found or name not in kinds:
            raise ValueError(f"no setting of this name: {setting}")
        kind = kinds[name]
        if kind is bool and value not in ("true", "false"):
            raise ValueError(f"true or false, not {value}")
        chosen[name] = value == "true" if kind is bool else kind(value)
    return Params(**chosen)


def setting_lines(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        lines = [line.partition("#")[0] for line in file]
    return ["=".join(part.strip() for part in line.split("=", 1)) for line in lines if line.strip()]


def main(arguments: Sequence[str]) -> int:
    parser = argparse.ArgumentParser(prog="vecloom.plans.jobs", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("folders", nargs="+")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--settings", metavar="FILE")
    parser.add_argument("--vocabulary", metavar="RANK_FILE")
    parser.add_argument("--rejected", metavar="FOLDER")
    chosen = parser.parse_args(arguments)
    folders, needs_vocabulary = STAGES[chosen.stage]
    if len(chosen.folders) != folders:
        parser.error(f"{chosen.stage} takes {folders} folders")
    if needs_vocabulary and not chosen.vocabulary:
        parser.error(f"{chosen.stage} needs --vocabulary")
    given = [*(setting_lines(chosen.settings) if chosen.settings else []), *chosen.set]
    try:
        params = settings(given)
    except ValueError as error:
        parser.error(str(error))

    spark = SparkSession.builder.appName("vecloom").getOrCreate()
    at = chosen.folders
    vocabulary = Vocabulary(chosen.vocabulary) if chosen.vocabulary else None
    if vocabulary and not any(s.startswith("vocab_size=") for s in given):
        params = replace(params, vocab_size=vocabulary_size(spark, vocabulary))
    if chosen.stage == "merge":
        return 0 if merge_part_files(spark, *at) else 1
    apart = chosen.rejected
    steps = {
        "word-frequency": lambda: word_frequency_job(spark, *at, vocabulary), "shard-lines": lambda: shard_lines_job(spark, *at, params),
        "tokenize": lambda: tokenize_job(spark, *at, vocabulary, apart), "shard-tokens": lambda: shard_tokens_job(spark, *at, params, apart),
        "embeddings": lambda: embeddings_job(spark, *at, params), "similarity": lambda: similarity_job(spark, *at, params, vocabulary, apart),
        "run": lambda: run(spark, at, params, vocabulary, apart)}
    print(json.dumps(steps[chosen.stage]()))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
