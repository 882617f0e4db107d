"""Training: shards of text train side by side and their vectors are averaged, round by round."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.hashing import draw_below
from vecloom.functions.text import whole_part
from vecloom.functions.vector import combine_vectors
from vecloom.operators.embeddings import hot_tokens, init_embeddings
from vecloom.operators.negatives import draw_tokens, weighted_tokens
from vecloom.operators.ordinal import running_offsets
from vecloom.operators.tokens import count_tokens, distinct_tokens, shard_tokens, token_stream
from vecloom.operators.windows import stream_stretches, window_count
from vecloom.params import Params
from vecloom.session import Rotation, ship_package, write_bucketed, write_table

#: The row of a shard's result that holds its mean loss instead of a vector; no token has this id.
LOSS_ROW = -1
#: The row of a probe: its loss, and as weight whether it is the best so far.
PROBE_ROW = -2
#: Windows whose shards are trained by one task at a time: at least, and at most where there are loads enough for all tasks.
LOAD_WINDOWS, MOST_LOAD_WINDOWS = 50_000, 400_000
_UPDATES = "token bigint, embedding array<double>, weight bigint"
_PROBED = _UPDATES + ", shard bigint, step bigint"


@dataclass
class TrainedEmbeddings:
    """The table ``(token, embedding)`` of all corpus tokens with the lowest loss.

    ``losses[i]`` is the mean loss of the table after ``i`` rounds, ``rates[i]`` the learning rate of the first step
    that follows it. ``best`` is the number of rounds behind ``embeddings``; ``stopped`` tells whether patience ran out.
    ``probes`` ``(round, shard, step, loss, best)`` are the losses that shards took on their held-back pairs, if asked to.
    """

    embeddings: DataFrame
    losses: list[float] = field(default_factory=list)
    rates: list[float] = field(default_factory=list)
    best: int = 0
    stopped: bool = False
    probes: DataFrame | None = None

    def history(self, spark: SparkSession) -> DataFrame:
        """``(round, rate, loss, stopped)``, one row per loss; ``stopped`` is true on the last if patience ran out."""
        last = len(self.losses) - 1
        rows = [(i, r, x, self.stopped and i == last) for i, (r, x) in enumerate(zip(self.rates, self.losses))]
        return spark.createDataFrame(rows, "round long, rate double, loss double, stopped boolean")


def training_segments(sequences: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """``(shard, win, n_windows, tokens)``: the corpus in segments of windows, each in one training shard.

    Window ``i`` of a segment begins at its token ``i * stride``; overlapping windows are not written out.
    Windows are numbered through the corpus, ``win`` being a segment's first, and ``windows_per_shard`` in a
    row make a shard: text in order, of bounded size, however long one document is. With ``round_robin`` the
    token stream is dealt over ``num_shards_embeddings`` streams first, as the sharding job does, and each
    stream's windows are shared out alike.
    """
    size, step, share = params.window_size, params.stride, params.windows_per_shard
    if params.round_robin:
        streams = F.lit(params.num_shards_embeddings)
        dealt = shard_tokens(token_stream(sequences, keys), params.num_shards_embeddings)
        return stream_stretches(dealt, size, step).select(
            (whole_part(F.col("first_win"), share) * streams + F.col("shard")).alias("shard"),
            (F.col("first_win") * streams + F.col("shard")).alias("win"), "n_windows", "tokens")

    counted = sequences.withColumn("_n", window_count(F.size("tokens"), size, step)).where(F.col("_n") > 0)
    starts = running_offsets(counted, keys, F.col("_n"))
    placed = counted.join(starts.hint("shuffle_hash"), keys)
    begin, end = F.col("offset"), F.col("offset") + F.col("_n")
    shards = F.sequence(whole_part(begin, share), whole_part(end - 1, share))
    parts = placed.select("tokens", begin.alias("_begin"), end.alias("_end"), F.explode(shards).alias("shard"))
    first = F.greatest(F.col("_begin"), F.col("shard") * F.lit(share))
    last = F.least(F.col("_end"), (F.col("shard") + 1) * F.lit(share))
    n_windows = (last - first).cast("int")
    skipped = (first - F.col("_begin")).cast("int") * F.lit(step)
    covered = F.slice("tokens", skipped + F.lit(1), (n_windows - 1) * F.lit(step) + F.lit(size))
    return parts.select("shard", first.alias("win"), n_windows.alias("n_windows"), covered.alias("tokens"))


def needed_tokens(segments: DataFrame, corpus: DataFrame, params: Params) -> DataFrame:
    """``(shard, place, token)``: the tokens of each shard (``place`` is NULL), and its pool of negatives (from 0).

    The pool holds ``negative_pool`` corpus tokens, each drawn by a hash of seed, shard and place: evenly, or by
    ``n ^ negative_power`` if that is set, with ``corpus`` ``(token, n)``. So a shard needs the vectors of its own text and of
    its pool, not of the whole vocabulary.
    """
    own = segments.select("shard", F.explode(F.array_distinct("tokens")).alias("token")).distinct()
    places = F.explode(F.sequence(F.lit(0), F.lit(params.negative_pool - 1))).alias("place")
    asked = segments.select("shard").distinct().select("shard", places)
    key = [params.seed, F.col("shard"), F.col("place")]
    if params.negative_power:
        drawn = draw_tokens(asked, weighted_tokens(corpus, params.negative_power), "token", *key)
    else:
        ranked = running_offsets(corpus.select("token"), ["token"]).withColumnRenamed("offset", "_rank")
        drawn = asked.withColumn("_rank", draw_below(max(corpus.count(), 1), *key)).join(ranked, "_rank")
    return own.select("shard", F.lit(None).cast("int").alias("place"), "token").union(drawn.select("shard", "place", "token"))


def load_needs(segments: DataFrame, corpus: DataFrame, params: Params, load: Column) -> DataFrame:
    """``(shard, place, token, pool_shard)`` like :func:`needed_tokens`, but ``shard`` is a load of shards: its tokens and those of the pools
    of its shards, each once, and these pools, with ``pool_shard`` the shard of the pool."""
    drawn = needed_tokens(segments, corpus, params).where(F.col("place").isNotNull())
    pools = write_table(drawn.select(load.alias("shard"), "place", "token", F.col("shard").cast("bigint").alias("pool_shard")), "pools")
    text = segments.select(F.col("load").alias("shard"), F.explode(F.array_distinct("tokens")).alias("token"))
    none = F.lit(None)
    return text.union(pools.select("shard", "token")).distinct().select(
        "shard", none.cast("int").alias("place"), "token", none.cast("bigint").alias("pool_shard")).union(pools)


def load_windows(sequences: DataFrame, params: Params, tasks: int) -> int:
    """How many windows make a load: more where the corpus has more than four small loads for each task, as a larger load gets a
    vector for more of its text."""
    counts = window_count(F.size("tokens"), params.window_size, params.stride)
    windows = sequences.where(F.col("tokens").isNotNull()).agg(F.sum(counts.cast("bigint"))).first()[0] or 0
    return min(max(LOAD_WINDOWS, windows // (4 * tasks)), MOST_LOAD_WINDOWS)


def train_embeddings(sequences: DataFrame, keys: list[str], params: Params) -> TrainedEmbeddings:
    """Train token vectors on lists ``tokens`` under the unique key ``keys``.

    All shards start from one shared, hash-drawn vector per corpus token. In a round, every shard gets the vectors of
    its own tokens and of its pool of negatives, runs ``epochs`` of SGD over all its pairs, and gives back what it
    changed; the new table is the mean per token, weighted by how often each shard touched it. Means are combined inside
    each task before anything is shuffled or written. Every table is judged by its loss, the last one too, and the one
    with the lowest loss is the result. Training stops after ``patience`` rounds in a row without a lower loss.

    The learning rate is ``lr * decay ^ (step // decay_steps)``, steps being the batches of a shard through all rounds.
    ``sequences`` is read several times; write tokenised text as a table first.

    With ``probe_steps`` a shard does not train on one pair in ``hold_out``, takes its loss on these before the first step
    and after every ``probe_steps`` steps, gives back its table with the lowest of them, and ends its round after
    ``patience`` probes in a row without a lower one.

    Small shards share a task's work: those of so many windows in a row, see :func:`load_windows`, are a load, which gets a vector
    once for all its shards and gives back one mean of what they changed.

    What loads need and the table they need it from are bucketed by token, alike, so a round moves vectors to their loads
    and partial means to their tokens and nothing else. The vectors of hot tokens, a bounded number, are broadcast.
    """
    spark = sequences.sparkSession
    ship_package(spark)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    load = whole_part(F.col("shard"), max(1, load_windows(sequences, params, tasks) // params.windows_per_shard))
    segments = write_bucketed(training_segments(sequences, keys, params).withColumn("load", load), "segments", "load", tasks)
    tokens = count_tokens(sequences) if params.negative_power else distinct_tokens(sequences)
    corpus = write_table(tokens, "corpus")
    needs = write_bucketed(load_needs(segments, corpus, params, load).repartition(tasks, "token"), "needs", "token", tasks)
    hot = hot_tokens(needs)
    tables = Rotation(spark, "round", "token", tasks)
    start = init_embeddings(corpus.select(F.col("token").cast("bigint").alias("token")), params.embedding_dim, params.seed)
    loss_row = spark.range(1).select(F.lit(LOSS_ROW).cast("bigint").alias("token"), F.lit(None).cast("array<double>").alias("embedding"))
    current = tables.write(start.unionByName(loss_row).repartition(tasks, "token"))

    result = TrainedEmbeddings(_words(current, corpus))
    patience = params.patience
    for number in range(params.rounds + 1):
        epochs = params.epochs if number < params.rounds else 0  # the last table is judged, not trained
        pairs = segments.groupBy("load").cogroup(pulled_vectors(needs, current, hot).groupBy("vector_shard"))
        probing = bool(params.probe_steps and epochs)
        updates = pairs.applyInArrow(_load_kernel(params, number, epochs), _PROBED if probing else _UPDATES)
        if probing:
            # means and probes are written, as both are read; a probe is the mean of itself
            probe = F.when(F.col("token") == PROBE_ROW, F.struct("shard", "step", (F.col("weight") == 1).alias("best"))).alias("probe")
            weight = F.when(F.col("token") == PROBE_ROW, 1).otherwise(F.col("weight")).alias("weight")
            both = write_table(combine_vectors(
                updates.select("token", probe, "embedding", weight), ["token", "probe"], "embedding", params.embedding_dim, how="mean", weight="weight"), "means")
            rows = both.where(F.col("token") == PROBE_ROW).select(
                F.lit(number).cast("bigint").alias("round"), "probe.shard", "probe.step", F.get("embedding", F.lit(0)).alias("loss"), "probe.best")
            result.probes = rows if result.probes is None else result.probes.unionByName(rows)
            means = both.where(F.col("token") != PROBE_ROW).select("token", "embedding")
        else:
            means = combine_vectors(updates, ["token"], "embedding", params.embedding_dim, how="mean", weight="weight")
        place = tables.latest
        merged = means
        if epochs:
            merged = tables.write(current.join(means.withColumnRenamed("embedding", "_new"), "token", "left").select(
                "token", F.coalesce("_new", "embedding").alias("embedding")))
        found = merged.where(F.col("token") == LOSS_ROW).first()
        if found is None or found["embedding"] is None:  # no pair in the whole corpus
            break
        result.losses.append(found["embedding"][0])
        result.rates.append(found["embedding"][1] if params.embedding_dim > 1 else params.learning_rate)
        if result.losses[-1] < min(result.losses[:-1], default=float("inf")):
            result.embeddings, result.best, patience = _words(current, corpus), number, params.patience
            tables.keep(place)
        else:
            patience -= 1
            result.stopped = patience <= 0
        if not epochs or result.stopped:
            break
        current = merged
    return result


def _words(table: DataFrame, corpus: DataFrame) -> DataFrame:
    """The table without the row of the loss, its ids of the corpus's type."""
    return table.where(F.col("token") != LOSS_ROW).select(F.col("token").cast(corpus.schema["token"].dataType).alias("token"), "embedding")


def pulled_vectors(needs: DataFrame, current: DataFrame, hot: list[int]) -> DataFrame:
    """``(vector_shard, place, token, embedding)``, and what else ``needs`` holds: each needed token with its vector, where it lies, and
    the pools without, as their tokens are needed ones.

    Both tables are bucketed by token, so neither is moved. A hot token, which very many shards need, meets its vector by a
    broadcast of the vectors of the hot tokens.
    """
    table = current.where(F.col("token") >= 0)
    if hot:
        few = F.col("token").isin(hot)
        often = needs.where(few).join(F.broadcast(table.where(few)), "token")
        found = needs.where(~few).join(table.hint("merge"), "token").unionByName(often)
    else:
        found = needs.join(table.hint("merge"), "token")
    more = [name for name in needs.columns if name not in ("shard", "place", "token")]
    vector = F.when(F.col("place").isNull(), F.col("embedding")).alias("embedding")
    return found.select(F.col("shard").alias("vector_shard"), "place", F.col("token"), vector, *more)


def _load_kernel(params: Params, number: int, epochs: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def train(segments: pa.Table, vectors: pa.Table) -> pa.Table:
        return train_load(segments, vectors, params, number, epochs)

    return train


def shard_triples(segments: pa.Table, pool: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, context and negative of every pair of neighbours in every window of a shard, in text order."""
    return numbered_triples(segments, pool, params)[:3]


def numbered_triples(segments: pa.Table, pool: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`shard_triples`, and the number of each pair.

    Pair ``p`` of window ``w`` has number ``w * window_size + p``. Windows take their negatives from the pool in turn, by that
    number modulo the pool, so a pair has the same negative wherever and whenever it is made.
    """
    flat, at, number = _numbered_pairs(segments, params)
    return flat[at], flat[at + 1], pool[number % len(pool)], number


def _numbered_pairs(segments: pa.Table, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of a shard's segments in text order, and for each pair the place of its centre among them and its number."""
    size, step = params.window_size, params.stride
    segments = segments.take(pa.array(np.argsort(segments["win"].to_numpy(), kind="stable")))
    lists = segments["tokens"].combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    windows = segments["n_windows"].to_numpy().astype(np.int64)
    turns = params.num_shards_embeddings if params.round_robin else 1  # how far the numbers of one segment's windows lie apart

    inside = _counting(windows)
    pairs = np.minimum(size, np.repeat(lengths, windows) - inside * step) - 1
    begins = np.repeat(np.cumsum(lengths) - lengths, windows) + inside * step
    window = np.repeat(segments["win"].to_numpy().astype(np.int64), windows) + inside * turns
    place = _counting(pairs)
    at = np.repeat(begins, pairs) + place
    return flat, at, np.repeat(window, pairs) * size + place


def _counting(sizes: np.ndarray) -> np.ndarray:
    """``0 1 .. n-1`` for each n in ``sizes``, in one array."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _matrix(vectors: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ids`` of all rows, the distinct ones in order, and the vectors of these as rows of a matrix."""
    ids = vectors["token"].to_numpy().astype(np.int64)
    tokens, first = np.unique(ids, return_index=True)
    lists = vectors["embedding"].combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    return ids, tokens, lists.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[first].astype(np.float64)


def train_shard(segments: pa.Table, vectors: pa.Table, params: Params, number: int, epochs: int) -> pa.Table:
    """One round of one shard: SGD over its pairs, on the vectors it uses.

    The row ``LOSS_ROW`` holds the mean loss before the first step and the rate of that step, weighted by the pairs.
    """
    probing = bool(params.probe_steps and epochs)
    if segments.num_rows == 0 or vectors.num_rows == 0:
        return _no_updates(probing)
    ids, tokens, matrix = _matrix(vectors)
    place = vectors["place"].to_numpy(zero_copy_only=False)
    drawn = np.flatnonzero(~np.isnan(place.astype(np.float64)))
    pool = ids[drawn[np.argsort(place[drawn], kind="stable")]]
    done = _trained(segments, tokens, matrix, pool, params, number, epochs)
    return _updates(done.names, done.rows, done.weights, [(done.shard, *probe) for probe in done.probes], probing) if done else _no_updates(probing)


def train_load(segments: pa.Table, vectors: pa.Table, params: Params, number: int, epochs: int) -> pa.Table:
    """:func:`train_shard` for the shards of a load, one by one, each from the same vectors. Their tables leave as one, the mean
    per token weighted by how often each of them touched it, added up as they come."""
    probing = bool(params.probe_steps and epochs)
    if segments.num_rows == 0 or vectors.num_rows == 0:
        return _no_updates(probing)
    pooled = vectors["pool_shard"].is_valid()
    _, tokens, matrix = _matrix(vectors.filter(pc.invert(pooled)))
    drawn_by, drawn_at, drawn = (vectors[name].filter(pooled).to_numpy().astype(np.int64) for name in ("pool_shard", "place", "token"))
    order = np.lexsort((drawn_at, drawn_by))
    drawn_by, drawn = drawn_by[order], drawn[order]
    held = segments["shard"].to_numpy()
    order = np.argsort(held, kind="stable")
    segments, held = segments.take(pa.array(order)).combine_chunks(), held[order]
    shards, begins = np.unique(held, return_index=True)
    names, probes = np.concatenate([[LOSS_ROW], tokens]), []
    total, weights = np.zeros((len(names), matrix.shape[1])), np.zeros(len(names), np.int64)
    for shard, begin, end in zip(shards, begins, [*begins[1:], len(held)]):
        mine = segments.slice(begin, end - begin)
        pool = drawn[np.searchsorted(drawn_by, shard):np.searchsorted(drawn_by, shard, "right")]
        used = np.searchsorted(tokens, np.union1d(pc.list_flatten(mine["tokens"]).to_numpy(), pool))
        done = _trained(mine, tokens[used], matrix[used], pool, params, number, epochs)
        if done:
            at = np.searchsorted(names, done.names)
            total[at] += done.rows * done.weights[:, None]
            weights[at] += done.weights
            probes += [(done.shard, *probe) for probe in done.probes]
    changed = weights > 0
    if not changed.any():
        return _no_updates(probing)
    return _updates(names[changed], total[changed] / weights[changed, None], weights[changed], probes, probing)


@dataclass
class _Trained:
    """What a shard gives back: ``names`` ``(token)``, their ``rows`` and ``weights``, and its probes ``(step, loss, best)``."""

    shard: int
    names: np.ndarray
    rows: np.ndarray
    weights: np.ndarray
    probes: list[tuple[int, float, bool]]


def _trained(segments: pa.Table, tokens: np.ndarray, matrix: np.ndarray, pool: np.ndarray, params: Params, number: int, epochs: int) -> _Trained | None:
    """One round of one shard on ``matrix``, the vectors of ``tokens``, which it may change; None without pairs."""
    probing = bool(params.probe_steps and epochs)
    flat, at, numbers = _numbered_pairs(segments, params)
    if not len(at):
        return None

    step = params.batch_pairs
    text, pool = np.searchsorted(tokens, flat), np.searchsorted(tokens, pool)
    n = pool[numbers % len(pool)]
    loss = _mean_loss(matrix, text[at], text[at + 1], n)
    back = probing & (numbers % params.hold_out == 0)
    if back.all():  # nothing to train on
        back[:] = False
    trained, nt = at[~back], n[~back]
    last = np.zeros(len(tokens), np.int64)
    batches = [_batch(text, trained[i:i + step], nt[i:i + step], last) for i in range(0, len(trained), step)] if epochs else []
    done = number * params.epochs * -(-len(trained) // step)
    rate = learning_rate(params, done)
    probes = Probes((text[at[back]], text[at[back] + 1], n[back]), params.patience) if back.any() else None
    if probes:
        probes.take(0, matrix)
    with np.errstate(over="ignore"):
        for turn in range(epochs * len(batches)):
            _descend(matrix, batches[turn % len(batches)], learning_rate(params, done + turn))
            if probes and (turn + 1) % params.probe_steps == 0 and not probes.take(turn + 1, matrix):
                break
    if probes:
        matrix = probes.matrix

    touches = sum(np.bincount(x, minlength=len(tokens)) for x in (text[trained], text[trained + 1], nt))
    report = np.zeros((1, matrix.shape[1]))
    report[0, :2] = [loss, rate][:matrix.shape[1]]
    rows = np.concatenate([report, matrix]) if epochs else report
    names = np.concatenate([[LOSS_ROW], tokens])[:len(rows)]
    weights = np.concatenate([[len(at)], touches])[:len(rows)]
    keep = weights > 0  # what only the pool holds and no pair has drawn is unchanged
    return _Trained(segments["shard"][0].as_py() if probing else 0, names[keep], rows[keep], weights[keep].astype(np.int64), probes.rows if probes else [])


def _updates(names: np.ndarray, rows: np.ndarray, weights: np.ndarray, taken: list[tuple[int, int, float, bool]], probing: bool) -> pa.Table:
    """A table and the probes ``(shard, step, loss, best)`` behind it."""
    columns = {}
    if probing:
        extra = np.zeros((len(taken), rows.shape[1]))
        extra[:, 0] = [x for _, _, x, _ in taken]
        columns = {"shard": np.array([0] * len(rows) + [s for s, _, _, _ in taken], np.int64),
                   "step": np.array([0] * len(rows) + [s for _, s, _, _ in taken], np.int64)}
        rows, names = np.concatenate([rows, extra]), np.concatenate([names, np.full(len(taken), PROBE_ROW)])
        weights = np.concatenate([weights, np.array([b for _, _, _, b in taken], np.int64)])
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.table({"token": names, "embedding": pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel())), "weight": weights, **columns})


class Probes:
    """Losses on held-back triples, the matrix with the lowest, and how long no lower one is waited for."""

    def __init__(self, triples: tuple[np.ndarray, np.ndarray, np.ndarray], patience: int) -> None:
        self.triples, self.patience, self.left = triples, patience, patience
        self.rows: list[tuple[int, float, bool]] = []
        self.lowest, self.matrix = np.inf, np.zeros((0, 0))

    def take(self, step: int, matrix: np.ndarray) -> bool:
        """Probe after ``step`` steps. False if the shard should stop."""
        loss = _mean_loss(matrix, *self.triples)
        best = not self.rows or loss < self.lowest
        self.rows.append((step, loss, best))
        if best:
            self.lowest, self.matrix, self.left = loss, matrix.copy(), self.patience
        else:
            self.left -= 1
        return self.left > 0


def learning_rate(params: Params, step: int) -> float:
    return params.learning_rate * params.decay_rate ** (step // params.decay_steps)


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0) + np.log1p(np.exp(-np.abs(x)))


def _loss(matrix: np.ndarray, c: np.ndarray, o: np.ndarray, n: np.ndarray) -> float:
    ones = np.ones(matrix.shape[1])
    own = matrix.take(c, axis=0)
    near = (own * matrix.take(o, axis=0)) @ ones
    far = (own * matrix.take(n, axis=0)) @ ones
    return float(_softplus(-near).sum() + _softplus(far).sum())


def _mean_loss(matrix: np.ndarray, c: np.ndarray, o: np.ndarray, n: np.ndarray) -> float:
    return sum(_loss(matrix, c[i:i + 4096], o[i:i + 4096], n[i:i + 4096]) for i in range(0, len(c), 4096)) / len(c)


@dataclass
class _Batch:
    """The triples of a step, laid out by the text they come from, so that a link of two neighbours is scored once for all its windows.

    ``rows`` are the vectors of the places of the text, in order, and then of the negatives, one per triple. ``links`` has for each
    negative the place of its centre: those of the first window that has a link come first, for all links in order, then those of
    the second, and so on; ``layers`` says which links these are, and where their negatives begin and end. ``weight`` is how
    many triples have a link, and 1 for each negative; places that are no neighbours are links that none has, with a negative of no weight.

    Of equal rows, the last one takes what all of them move by: ``extra`` are the others, in the order of ``heads``, the rows that
    take them, and ``starts`` is where each head's begin.
    """

    rows: np.ndarray
    links: np.ndarray
    weight: np.ndarray
    layers: list[tuple[int, int]]
    extra: np.ndarray
    starts: np.ndarray
    heads: np.ndarray


def _batch(text: np.ndarray, at: np.ndarray, n: np.ndarray, last: np.ndarray) -> _Batch:
    """The batch of the pairs ``at``, places in ``text``, and their negatives ``n``. ``last`` is scratch, a number per row of the table."""
    begin, end = at.min(), at.max() + 2
    if end - begin > 8 * len(at):  # windows lie far apart
        held = np.unique(np.concatenate([at, at + 1]))
        text, link = text[held], np.searchsorted(held, at)
    else:
        text, link = text[begin:end], at - begin
    times = np.bincount(link, minlength=len(text) - 1)
    none = np.flatnonzero(times == 0)
    link = np.concatenate([link, none])
    layer = _counting(np.maximum(times, 1))
    sorted_by = np.argsort(link, kind="stable")[np.argsort(layer, kind="stable")]
    weight = np.concatenate([times, sorted_by < len(n)]).astype(np.float64)
    links, n = link[sorted_by], np.concatenate([n, text[none]])[sorted_by]
    ends = np.cumsum(np.bincount(layer))
    rows = np.concatenate([text, n])
    own = np.arange(len(rows))
    last[rows] = own
    head = last[rows]
    extra = np.flatnonzero(head != own)
    extra = extra[np.argsort(head[extra], kind="stable")]
    heads, starts = np.unique(head[extra], return_index=True)
    return _Batch(rows, links, weight, [*zip(ends[:-1], ends[1:])], extra, starts, heads)


def _descend(matrix: np.ndarray, batch: _Batch, rate: float) -> None:
    """One step for a batch, in place: every row moves by the sum of its triples' derivatives.

    Rows are moved about as one item each, and added up as pairs of numbers, which numpy does in half the time.
    """
    many, width = len(batch.links), matrix.shape[1]
    whole, pair, ones = _row_kinds(width)
    table = matrix.view(whole).ravel()
    held = table.take(batch.rows)
    centre = held.take(batch.links).view(np.float64).reshape(many, width)
    own = held.view(np.float64).reshape(-1, width)
    text, negative, links = own[:-many], own[-many:], len(own) - many - 1
    product = np.empty((links + many, width))
    np.multiply(text[:-1], text[1:], out=product[:links])
    np.multiply(centre, negative, out=product[links:])
    pull = np.dot(product, ones[0])
    np.exp(np.negative(pull, out=pull), out=pull)  # where it overflows, the logistic value is 0
    pull += 1
    np.reciprocal(pull, out=pull)
    pull[:links] -= 1
    pull *= batch.weight
    pull *= rate
    pulls = np.dot(pull[:, None], ones, out=product)
    near, far = pulls[:links], pulls[links:]
    moves = np.empty_like(own)
    moved = moves.view(whole).ravel()
    np.multiply(near, text[1:], out=moves[:links])
    moves[links] = 0
    np.multiply(far, centre, out=moves[links + 1:])
    near *= text[:-1]
    moves[1:links + 1] += near
    far *= negative
    moves[:links] += far[:links]
    for begin, end in batch.layers:
        _add_rows(moved, batch.links[begin:end], far[begin:end], whole)
    if len(batch.extra):
        others = moved.take(batch.extra).view(pair).reshape(len(batch.extra), -1)
        _add_rows(moved, batch.heads, np.add.reduceat(others, batch.starts, axis=0).view(np.float64), whole)
    own -= moves
    np.put(table, batch.rows, held)  # the last of equal rows stays


def _add_rows(table: np.ndarray, rows: np.ndarray, more: np.ndarray, whole: np.dtype) -> None:
    """Add ``more`` to the ``rows``, all different, of a table of whole rows."""
    more += table.take(rows).view(np.float64).reshape(more.shape)
    np.put(table, rows, more.view(whole))


@lru_cache
def _row_kinds(width: int) -> tuple[np.dtype, type, np.ndarray]:
    """A row as one item, what its numbers are added up as, and a row of ones."""
    return np.dtype((np.void, 8 * width)), np.float64 if width % 2 else np.complex128, np.ones((1, width))


def _no_updates(probing: bool) -> pa.Table:
    kinds = [("token", pa.int64()), ("embedding", pa.list_(pa.float64())), ("weight", pa.int64())]
    return pa.schema(kinds + [("shard", pa.int64()), ("step", pa.int64())] * probing).empty_table()
