"""The registered queries: each operator over the whole given tables.

Arrays leave as text or as rows ``(key, dim, x)``, so that results compare by value in any engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.text import piece_ids_of, pieces_of
from vecloom.functions.vector import combine_vectors, dot, fixed_text, norm, reshape, tidy
from vecloom.operators import embeddings as emb
from vecloom.operators import lines as ln
from vecloom.operators import negatives, pruned, sgns, similarity, tokens, windows
from vecloom.operators.accounts import Judged, set_apart
from vecloom.operators.training import train_embeddings
from vecloom.params import Params
from vecloom.plans import neighbours as plan
from vecloom.session import new_path, write_table
from vecloom.sources.line_splits import nline_corpus
from vecloom.sources.sinks import merge_part_files, write_parquet, write_shards, write_text
from vecloom.sources.tables import read_table
from vecloom.sources.text_files import numbered_corpus
from vecloom.sources.vocabulary import Vocabulary, shared_vocabulary, vocabulary_table

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = Params()
#: Parts of a dealt output.
PARTS = 5
#: The length of the vectors in the table ``embeddings``.
VECTOR_WIDTH = 64
#: The length of vectors that are too wide to be added up element by element.
WIDE = 768
#: The power of a token's count by which it is drawn as a negative.
WEIGHT_POWER = 0.75
#: Two rounds that SQL can follow: one full step per shard, and a learning rate that falls between the rounds.
STEPS = Params(epochs=1, rounds=2, windows_per_shard=500, batch_pairs=2**31, decay_steps=1, decay_rate=0.5, negative_pool=64)

#: One round of two full steps, each followed by a probe.
PROBED = replace(STEPS, rounds=1, epochs=2, probe_steps=1, hold_out=16)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", ["doc_id", "text"], spread_by="doc_id")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return ln.document_lines(_documents(spark, folder))


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    return ln.number_lines(_documents(spark, folder))


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "conversations", ["conv_id", "turn", "role", "text"])


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])
    return table.withColumnRenamed("vec_id", "token")


def _vocabulary(spark: SparkSession) -> Vocabulary:
    """The public 50k rank file that is installed beside the tokenizer library."""
    import public_tokenizers

    return shared_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _vector_count(spark: SparkSession, folder: str) -> int:
    """The ids 0, 1, ... of the embedding table; pieces are folded into as many, so that every vector can be met."""
    return _vectors(spark, folder).count()


def _sequences(spark: SparkSession, folder: str, vocab_size: int) -> DataFrame:
    return _documents(spark, folder).select("doc_id", piece_ids_of(F.col("text"), vocab_size).alias("tokens"))


def _line_tokens(spark: SparkSession, folder: str, vocab_size: int) -> DataFrame:
    return _lines(spark, folder).select("doc_id", "pos", piece_ids_of(F.col("line"), vocab_size).alias("tokens"))


def _ids_text(column: str):
    return F.array_join(F.col(column).cast("array<string>"), " ")


def _elements(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    # the outer form, since a plain explode would have the vectors computed once more for an inferred filter
    return df.select(*keys, F.posexplode_outer(vector).alias("dim", "x")).where(F.col("x").isNotNull()).select(
        *keys, F.col("dim").cast("bigint").alias("dim"), tidy(F.col("x").cast("double")).alias("x"))


def _elements_of_ids(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.posexplode("tokens").alias("place", "token")).select(
        *keys, F.col("place").cast("bigint").alias("place"), "token")


def _piece_words(spark: SparkSession, folder: str) -> DataFrame:
    return ln.piece_vocabulary(ln.piece_frequency(_documents(spark, folder), "text"))


# text ---------------------------------------------------------------------------------------------------------


def corpus_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder)


def number_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(spark, folder)


def numbered_corpus_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "lines")
    write_text(_numbered(spark, folder).withColumnRenamed("line", "value"), path, ["line_no"])
    return numbered_corpus(spark, path)


def overwritten_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines written over another text: only the last writing is left."""
    path = new_path(spark, "lines")
    write_text(_turns(spark, folder).select("conv_id", "turn", F.col("text").alias("value")), path, ["conv_id", "turn"])
    write_text(_numbered(spark, folder).withColumnRenamed("line", "value"), path, ["line_no"])
    return numbered_corpus(spark, path)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return ln.order_lines(_turns(spark, folder), ["conv_id", "turn"])


def shard_lines(spark: SparkSession, folder: str) -> DataFrame:
    return ln.shard_lines(_numbered(spark, folder), PARAMS.num_shards)


def line_splits(spark: SparkSession, folder: str) -> DataFrame:
    return ln.line_splits(_numbered(spark, folder), PARAMS.lines_per_split).groupBy("split_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))


def nline_corpus_query(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus as text files, read in splits of so many lines, each a partition of its own."""
    path = new_path(spark, "lines")
    write_text(_numbered(spark, folder).withColumnRenamed("line", "value"), path, ["line_no"])
    return nline_corpus(spark, path, PARAMS.lines_per_split, "part-*")


def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    return ln.corpus_stats(_documents(spark, folder), PARAMS.vocab_size)


def split_words(spark: SparkSession, folder: str) -> DataFrame:
    return ln.split_words(_lines(spark, folder), ["doc_id", "pos"], "line")


def piece_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return ln.piece_frequency(_documents(spark, folder), "text")


def piece_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return _piece_words(spark, folder)


def format_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ln.format_word_counts(_piece_words(spark, folder))


def merged_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    parts, merged = new_path(spark, "parts"), new_path(spark, "merged")
    write_text(ln.format_word_counts(_piece_words(spark, folder)), parts, ["token"])
    merge_part_files(spark, parts, merged)
    return numbered_corpus(spark, merged, "part-*")


def part_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Word counts in as many parts as a job has reducers, a token in the part of its id modulo that number, read back."""
    path, counts = new_path(spark, "parts"), _piece_words(spark, folder)
    dealt = ln.deal(counts, "token", PARTS, "turn").select("shard", "token", ln.word_count_text().alias("value"))
    write_shards(dealt, path, "token")
    return spark.read.text(path).select(F.col("shard").cast("int").alias("part"), F.col("value").alias("line"))


def concat_by_line(spark: SparkSession, folder: str) -> DataFrame:
    lines = ln.document_lines(ln.dealt_documents(_documents(spark, folder)))
    words = ln.split_words(lines, ["doc_id", "pos"], "line")
    return ln.concat_by_line(words, ["doc_id", "pos"], "word_no", "word")


def _numbered_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = ln.document_lines(ln.dealt_documents(_documents(spark, folder)))
    forms = F.array(F.concat_ws("\t", F.col("doc_id").cast("string"), "line"), F.col("line"))
    return lines.select(F.explode_outer(forms).alias("value"))


def parse_numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    return ln.parse_numbered_lines(_numbered_rows(spark, folder))


def _token_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered id lists, each with what a broken file may hold: words, decimals, numbers beyond 32 bits, blank lists, no tab."""
    ids = F.concat_ws(" ", _ids_text("tokens"), F.lit("x1 4.5 99999999999 -7"), F.substring("line", 1, 20))
    lines = _numbered(spark, folder).select("line_no", "line", piece_ids_of(F.col("line"), PARAMS.vocab_size).alias("tokens"))
    made = lines.select(F.col("line_no").cast("string").alias("number"), ids.alias("ids"))
    # lines are numbered and ids made once; behind the outer explode no filter has them made again
    forms = [("number", F.lit("\t"), "ids"), ("number", F.lit("\t   ")), ("number", F.lit(" "), "ids"), (F.lit("n"), "number", F.lit("\t1 2"))]
    return made.select(F.explode_outer(F.array(*[F.concat(*form) for form in forms])).alias("value"))


def parse_token_lines(spark: SparkSession, folder: str) -> DataFrame:
    return ln.parse_token_lines(_token_rows(spark, folder)).select("line_no", _ids_text("tokens").alias("tokens"))


def parse_token_shard(spark: SparkSession, folder: str) -> DataFrame:
    rows = _line_tokens(spark, folder, PARAMS.vocab_size).select("doc_id", "pos", _ids_text("tokens").alias("value"))
    return _elements_of_ids(ln.parse_token_shard(rows, ["doc_id", "pos"]), ["doc_id", "pos"])


def format_token_lines(spark: SparkSession, folder: str) -> DataFrame:
    ids = piece_ids_of(F.col("line"), PARAMS.vocab_size)
    return ln.format_token_lines(_numbered(spark, folder).select("line_no", ids.alias("tokens")))


# tokens -------------------------------------------------------------------------------------------------------


def word_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.word_frequency(_documents(spark, folder), _vocabulary(spark), "text")


def line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.word_frequency(_lines(spark, folder), _vocabulary(spark), mode="per_line")


def tokenize_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.tokenize_lines(_lines(spark, folder), _vocabulary(spark)).select(
        "doc_id", "pos", _ids_text("tokens").alias("tokens"))


def detokenize_lines(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = _vocabulary(spark)
    return tokens.detokenize_lines(tokens.tokenize_lines(_lines(spark, folder), vocabulary), vocabulary)


def encoded_words(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encoded_words(_documents(spark, folder), _vocabulary(spark), "text")


def _bytes_of_tokens(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    """Per language, the bytes of all ids with how often they occur: nothing of the text is lost or counted twice."""
    vocabulary = _vocabulary(spark)
    documents = read_table(spark, folder, "documents", ["doc_id", "lang", "text"], spread_by="doc_id")
    counts = tokens.word_frequency(documents, vocabulary, "text", mode, ["lang"])
    sizes = vocabulary_table(spark, vocabulary).select("token", F.octet_length("bytes").alias("_size"))
    return counts.join(sizes, "token").groupBy("lang").agg(F.sum(F.col("n") * F.col("_size")).alias("n_bytes"))


def word_frequency_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return _bytes_of_tokens(spark, folder, "per_word")


def line_frequency_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return _bytes_of_tokens(spark, folder, "per_line")


def detokenize_ids(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents", ["doc_id", "lang", "text"], spread_by="doc_id")
    words = _piece_words(spark, folder)
    counts = documents.select("lang", F.explode(pieces_of(F.col("text"))).alias("piece")).groupBy("lang", "piece").agg(
        F.count(F.lit(1)).alias("n"))
    ids = counts.join(words.select("token", F.col("text").alias("piece")), "piece").select("lang", "token", "n")
    return tokens.detokenize_ids(ids, words)


def token_stream(spark: SparkSession, folder: str) -> DataFrame:
    tokenised = write_table(_line_tokens(spark, folder, PARAMS.vocab_size), "tokenised")
    return tokens.token_stream(tokenised, ["doc_id", "pos"])


def shard_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.shard_tokens(token_stream(spark, folder), PARAMS.num_shards_embeddings)


def shard_windows(spark: SparkSession, folder: str) -> DataFrame:
    found = windows.stream_windows(shard_tokens(spark, folder), PARAMS.window_size, PARAMS.stride)
    return found.select("shard", "win_no", _ids_text("window").alias("window"))


def distinct_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.distinct_tokens(_sequences(spark, folder, PARAMS.vocab_size))


def token_windows(spark: SparkSession, folder: str) -> DataFrame:
    found = windows.token_windows(_sequences(spark, folder, PARAMS.vocab_size), ["doc_id"], PARAMS.window_size, PARAMS.stride)
    return found.select("doc_id", "win_no", _ids_text("window").alias("window"))


def _pairs(spark: SparkSession, folder: str, vocab_size: int) -> DataFrame:
    found = windows.token_windows(_sequences(spark, folder, vocab_size), ["doc_id"], PARAMS.window_size, PARAMS.stride)
    return windows.skipgram_pairs(found, ["doc_id", "win_no"])


def skipgram_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder, PARAMS.vocab_size)


def negative_samples(spark: SparkSession, folder: str) -> DataFrame:
    return windows.negative_samples(
        _pairs(spark, folder, PARAMS.vocab_size), ["doc_id", "win_no", "pair_no"], PARAMS.vocab_size, PARAMS.seed)


def token_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every token with its stretch of the cumulative weights by which negatives are drawn."""
    return negatives.weighted_tokens(tokens.count_tokens(_sequences(spark, folder, PARAMS.vocab_size)), WEIGHT_POWER).spans


def negative_samples_weighted(spark: SparkSession, folder: str) -> DataFrame:
    weighted = negatives.weighted_tokens(tokens.count_tokens(_sequences(spark, folder, PARAMS.vocab_size)), WEIGHT_POWER)
    return negatives.negative_samples_weighted(
        _pairs(spark, folder, PARAMS.vocab_size), ["doc_id", "win_no", "pair_no"], weighted, PARAMS.seed)


# vectors ------------------------------------------------------------------------------------------------------


def _tabbed(texts: DataFrame, *parts: str) -> DataFrame:
    """The rows with white space around them."""
    return texts.select(F.concat(*[F.col("value") if p == "value" else F.lit(p) for p in parts]).alias("value"))


def _embedding_rows(spark: SparkSession, folder: str) -> DataFrame:
    texts = emb.format_embeddings(_vectors(spark, folder)).select("value")
    malformed = _turns(spark, folder).select(F.concat_ws("\t", "role", "text").alias("value"))
    rows = texts.unionAll(_tabbed(texts, "value", "\t")).unionAll(_tabbed(texts, "value", "x")).unionAll(_tabbed(texts, "\t", "value"))
    return rows.unionAll(malformed)


def parse_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return _elements(emb.parse_embeddings(_embedding_rows(spark, folder)), ["token"], "embedding")


def _strict_embedding_rows(spark: SparkSession, folder: str) -> DataFrame:
    texts = emb.format_embeddings(_vectors(spark, folder)).select("value")
    one_field = _turns(spark, folder).select(F.col("role").alias("value"))
    three_fields = _tabbed(texts, "value", "\t", "more")
    return texts.unionAll(_tabbed(texts, "value", "\t")).unionAll(_tabbed(texts, "\t ", "value", " \t")).unionAll(one_field).unionAll(three_fields)


def parse_embeddings_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _elements(emb.parse_embeddings(_strict_embedding_rows(spark, folder), strict=True), ["token"], "embedding")


def _judged(spark: SparkSession, folder: str) -> dict[str, Judged]:
    """Every parser over the rows of its query, and the vector parser over vectors, unreadable ones and none."""
    vectors = _vectors(spark, folder)
    rows = vectors.select("label", fixed_text(F.col("embedding")).alias("value")).unionAll(
        vectors.select("label", F.lit("[0.1,x]").alias("value"))).unionAll(vectors.select("label", F.lit(None).cast("string").alias("value")))
    return {
        "numbered lines": set_apart(ln.judge_numbered_lines(_numbered_rows(spark, folder))),
        "token lines": set_apart(ln.judge_token_lines(_token_rows(spark, folder))),
        "embeddings": set_apart(emb.judge_embeddings(_embedding_rows(spark, folder))),
        "strict embeddings": set_apart(emb.judge_embeddings(_strict_embedding_rows(spark, folder), strict=True)),
        "vectors": set_apart(emb.judge_vectors(rows, ["label"], "value"))}


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What each parser drops, row by row, and why."""
    found = None
    for parser, judged in _judged(spark, folder).items():
        rows = judged.rejected.select(F.lit(parser).alias("parser"), "reason", "value")
        found = rows if found is None else found.unionAll(rows)
    return found


def parser_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows each parser read, kept and dropped, as counted while the two sides were written."""
    counts = [(parser, j.counts["read"], j.counts["kept"], j.counts["rejected"]) for parser, j in _judged(spark, folder).items()]
    return spark.createDataFrame(counts, "parser string, n_read long, n_kept long, n_rejected long")


def observed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and tokens as counted while lines are written into shards and the token stream as a table."""
    one, numbered = F.count(F.lit(1)), _numbered(spark, folder)
    text = F.concat_ws("\t", F.col("line_no").cast("string"), "line")
    lines = write_shards(ln.shard_lines(numbered, PARAMS.num_shards).select("shard", "line_no", text.alias("value")), new_path(spark, "shards"), "line_no", {"n_lines": one})
    stream = write_parquet(token_stream(spark, folder), new_path(spark, "stream"), {"n_tokens": one, "vocab_size": F.max("token") + 1})
    return spark.createDataFrame([(lines["n_lines"], stream["n_tokens"], stream["vocab_size"])], "n_lines long, n_tokens long, vocab_size long")


def format_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return emb.format_embeddings(_vectors(spark, folder))


def dedupe_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return _elements(emb.dedupe_embeddings(_vectors(spark, folder), "label", "token"), ["label", "token"], "embedding")


def lookup_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    counts = tokens.count_tokens(_sequences(spark, folder, _vector_count(spark, folder)))
    return _elements(emb.lookup_embeddings(counts, _vectors(spark, folder)), ["token", "n"], "embedding")


def _occurrences(spark: SparkSession, folder: str) -> DataFrame:
    ids = write_table(_sequences(spark, folder, _vector_count(spark, folder)), "sequences")
    each = ids.select("doc_id", F.posexplode("tokens").alias("place", "token"))
    return emb.lookup_occurrences(each, _vectors(spark, folder)).drop("place")


def lookup_occurrence_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The vector of every occurrence, added up per document so that each of them counts."""
    return _elements(combine_vectors(_occurrences(spark, folder), ["doc_id"], "embedding", VECTOR_WIDTH), ["doc_id"], "embedding")


def lookup_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    """How many occurrences of a document have a vector, beside all elements of their mean."""
    found = _occurrences(spark, folder).withColumn("n", F.lit(1).cast("long"))
    counts = write_table(found.groupBy("doc_id").agg(F.sum("n").alias("n")), "counts")
    means = combine_vectors(found, ["doc_id"], "embedding", VECTOR_WIDTH, how="mean")
    return _elements(means.join(counts, "doc_id"), ["doc_id", "n"], "embedding")


def unknown_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return emb.unknown_tokens(tokens.count_tokens(_sequences(spark, folder, PARAMS.vocab_size)), _vectors(spark, folder))


def mean_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    texts = _vectors(spark, folder).select("label", fixed_text(F.col("embedding")).alias("value"))
    texts = texts.unionAll(texts.select("label", F.concat(F.lit(" \t"), "value", F.lit("\t")).alias("value")))
    unreadable = _vectors(spark, folder).select("label", F.lit("[0.1,x]").alias("value"))
    rows = emb.parse_vectors(texts.unionAll(unreadable), ["label"], "value")
    return _elements(emb.mean_embeddings(rows, VECTOR_WIDTH, "label"), ["label"], "embedding")


def wide_means(spark: SparkSession, folder: str) -> DataFrame:
    """Means of vectors of ``WIDE`` elements: each vector beside itself, as often as fits, every time a little larger."""
    places = F.sequence(F.lit(0), F.lit(WIDE - 1))
    wide = F.transform(places, lambda j: F.get("embedding", j % VECTOR_WIDTH).cast("double") * (F.call_function("div", j, F.lit(VECTOR_WIDTH)) + 1))
    rows = _vectors(spark, folder).select("label", F.col("token").alias("weight"), wide.alias("embedding"))
    return _elements(emb.mean_embeddings(rows, WIDE, "label", weight="weight"), ["label"], "embedding")


def vector_dot(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder).select("token", "embedding")
    following = vectors.select((F.col("token") - 1).alias("token"), F.col("embedding").alias("following"))
    return vectors.join(following, "token").select("token", tidy(dot(F.col("embedding"), F.col("following"))).alias("dot"))


def reshape_vectors(spark: SparkSession, folder: str) -> DataFrame:
    rows = _vectors(spark, folder).select("token", F.posexplode(reshape(F.col("embedding"), PARAMS.embedding_dim)).alias("row", "embedding"))
    return _elements(rows.withColumn("row", F.col("row").cast("long")), ["token", "row"], "embedding")


def vector_norm(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder).select("token", tidy(norm(F.col("embedding"))).alias("norm"))


def cosine_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _pairs(spark, folder, _vector_count(spark, folder)).select(F.col("c").alias("a"), F.col("o").alias("b")).distinct()
    return similarity.cosine_pairs(_vectors(spark, folder), pairs).select("a", "b", tidy(F.col("sim")).alias("sim"))


def top_k_similar(spark: SparkSession, folder: str) -> DataFrame:
    return similarity.top_k_similar(_vectors(spark, folder), PARAMS.neighbours)


def pruned_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`top_k_similar` with blocks of like direction, of which only those meet that can matter."""
    return pruned.pruned_neighbours(_vectors(spark, folder), PARAMS.neighbours).neighbours


def narrow_scores(spark: SparkSession, folder: str) -> DataFrame:
    return similarity.narrow_scores(top_k_similar(spark, folder))


def format_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    named = plan.name_neighbours(top_k_similar(spark, folder), _piece_words(spark, folder))
    return similarity.format_neighbours(named)


# training -----------------------------------------------------------------------------------------------------


def init_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    start = emb.init_embeddings(distinct_tokens(spark, folder), PARAMS.embedding_dim, PARAMS.seed)
    return _elements(start, ["token"], "embedding")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    triples = plan.piece_triples(_sequences(spark, folder, PARAMS.vocab_size), ["doc_id"], PARAMS)
    return write_table(sgns.labelled_pairs(triples), "pairs")


def sgns_loss(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _labelled(spark, folder)
    return sgns.sgns_loss(pairs, plan.start_vectors(pairs, PARAMS), PARAMS.embedding_dim).select("pairs", tidy(F.col("loss")).alias("loss"))


def sgns_gradient(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _labelled(spark, folder)
    return _elements(sgns.sgns_gradient(pairs, plan.start_vectors(pairs, PARAMS), PARAMS.embedding_dim), ["token"], "gradient")


def sgns_step(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _labelled(spark, folder)
    start = plan.start_vectors(pairs, PARAMS)
    moved = sgns.sgns_step(start, sgns.sgns_gradient(pairs, start, PARAMS.embedding_dim), PARAMS.learning_rate)
    return _elements(moved, ["token"], "embedding")


def piece_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Text to nearest neighbours over the whole vocabulary. It has no SQL, which would have to compare all ids with all."""
    return plan.one_step_neighbours(_sequences(spark, folder, PARAMS.vocab_size), ["doc_id"], PARAMS)


def _steps(spark: SparkSession, folder: str, params: Params = STEPS):
    sequences = write_table(_sequences(spark, folder, params.vocab_size), "sequences")
    return train_embeddings(sequences, ["doc_id"], params)


def train_two_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Two rounds with the settings ``STEPS``, which SQL can follow; ``train_embeddings`` has the full settings."""
    return _elements(_steps(spark, folder).embeddings, ["token"], "embedding")


def _losses(spark: SparkSession, folder: str, params: Params) -> DataFrame:
    return _steps(spark, folder, params).history(spark).select("round", tidy(F.col("rate")).alias("rate"), tidy(F.col("loss")).alias("loss"), "stopped")


def train_losses(spark: SparkSession, folder: str) -> DataFrame:
    """The losses of :func:`train_two_rounds`, with its small settings."""
    return _losses(spark, folder, STEPS)


def train_losses_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`train_losses` with negatives drawn by weight."""
    return _losses(spark, folder, replace(STEPS, negative_power=WEIGHT_POWER))


def train_probe(spark: SparkSession, folder: str) -> DataFrame:
    """The losses that shards take on their held-back pairs, in a round of two steps with a probe after each."""
    found = _steps(spark, folder, PROBED).probes
    return found.select("shard", "step", tidy(F.col("loss")).alias("loss"), "best")


def _trained(spark: SparkSession, folder: str, params: Params) -> DataFrame:
    lines = tokens.tokenize_lines(_lines(spark, folder), _vocabulary(spark))
    trained = train_embeddings(write_table(lines, "tokenised"), ["doc_id", "pos"], params)
    return _elements(trained.embeddings, ["token"], "embedding")


def train_embeddings_query(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder, PARAMS)


def train_round_robin(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder, replace(PARAMS, round_robin=True))


def token_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return plan.token_neighbours(_documents(spark, folder), PARAMS, _vocabulary(spark))


QUERIES: dict[str, Query] = {
    query.__name__: query for query in (
        corpus_lines, number_lines, numbered_corpus_files, overwritten_lines, order_lines, shard_lines, line_splits, corpus_stats,
        split_words, piece_frequency, piece_vocabulary, format_word_counts, part_word_counts, merged_word_counts, concat_by_line,
        parse_numbered_lines, parse_token_lines, parse_token_shard, format_token_lines,
        word_frequency, line_frequency, word_frequency_bytes, line_frequency_bytes, encoded_words, tokenize_lines, detokenize_lines, detokenize_ids, token_stream, shard_tokens,
        shard_windows, distinct_tokens, token_windows, skipgram_pairs, negative_samples, token_spans, negative_samples_weighted,
        parse_embeddings, parse_embeddings_strict, rejected_rows, parser_accounts, observed_counts, format_embeddings, dedupe_embeddings, lookup_embeddings, lookup_occurrences, lookup_occurrence_sums,
        unknown_tokens, mean_embeddings, wide_means, vector_dot, reshape_vectors, vector_norm, cosine_pairs, top_k_similar, pruned_neighbours, narrow_scores,
        format_neighbours,
        init_embeddings, sgns_loss, sgns_gradient, sgns_step, piece_neighbours, train_two_rounds, train_losses, train_losses_weighted, train_probe,
        token_neighbours)
}
QUERIES["nline_corpus"] = nline_corpus_query
QUERIES["train_embeddings"] = train_embeddings_query
QUERIES["train_round_robin"] = train_round_robin
