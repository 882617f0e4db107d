"""From text to nearest neighbours, end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.operators.embeddings import init_embeddings
from vecloom.operators.lines import number_lines
from vecloom.operators.sgns import labelled_pairs, sgns_gradient, sgns_step
from vecloom.operators.similarity import top_k_similar
from vecloom.operators.tokens import detokenize_ids, tokenize_lines
from vecloom.operators.training import TrainedEmbeddings, train_embeddings
from vecloom.operators.windows import negative_samples, skipgram_pairs, token_windows
from vecloom.params import Params
from vecloom.session import write_table
from vecloom.sources.vocabulary import Vocabulary, vocabulary_table


@dataclass
class NeighbourRun:
    """What an end-to-end run leaves: ``tokenised``, the training result, and the named neighbours."""

    tokenised: DataFrame
    trained: TrainedEmbeddings
    neighbours: DataFrame


def name_neighbours(neighbours: DataFrame, words: DataFrame) -> DataFrame:
    """``(token, text, rank, neighbour, neighbour_text, sim)`` with the texts from ``words`` ``(token, text)``."""
    named = detokenize_ids(detokenize_ids(neighbours, words), words, "neighbour", "neighbour_text")
    return named.select("token", "text", "rank", "neighbour", "neighbour_text", "sim")


def nearest_tokens(numbered: DataFrame, params: Params, vocabulary: Vocabulary) -> NeighbourRun:
    """``(line_no, line)`` in, each token's nearest tokens out.

    Tokenised text is written once: it is what all later steps read, and the tokenizer is the costly step.
    """
    spark = numbered.sparkSession
    tokenised = write_table(tokenize_lines(numbered, vocabulary), "tokenised")
    trained = train_embeddings(tokenised, ["line_no"], params)
    nearest = top_k_similar(trained.embeddings, params.neighbours)
    return NeighbourRun(tokenised, trained, name_neighbours(nearest, vocabulary_table(spark, vocabulary)))


def token_neighbours(documents: DataFrame, params: Params, vocabulary: Vocabulary) -> DataFrame:
    """:func:`nearest_tokens` over the lines of ``(doc_id, text)``."""
    return nearest_tokens(number_lines(documents), params, vocabulary).neighbours


def piece_triples(sequences: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """``(keys..., win_no, pair_no, c, o, n)``: every training triple of lists ``tokens``, as rows."""
    windows = token_windows(sequences, keys, params.window_size, params.stride)
    pairs = skipgram_pairs(windows, [*keys, "win_no"])
    return negative_samples(pairs, [*keys, "win_no", "pair_no"], params.vocab_size, params.seed)


def start_vectors(pairs: DataFrame, params: Params) -> DataFrame:
    """The start table for the tokens in labelled pairs ``(a, b, ...)``."""
    tokens = pairs.select(F.explode(F.array("a", "b")).alias("token")).distinct()
    return write_table(init_embeddings(tokens, params.embedding_dim, params.seed), "start")


def one_step_neighbours(sequences: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """The run in table operators only: triples, start vectors, one full gradient step, neighbours.

    The counted pairs are written, as start vectors, gradient and step all read them.
    """
    pairs = write_table(labelled_pairs(piece_triples(sequences, keys, params)), "pairs")
    start = start_vectors(pairs, params)
    moved = write_table(sgns_step(start, sgns_gradient(pairs, start, params.embedding_dim), params.learning_rate), "step")
    return top_k_similar(moved, params.neighbours)
