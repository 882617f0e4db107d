"""The settings of a run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Settings of the text-to-neighbours run.

    The first eleven are fixed values: a run with the defaults shards, windows and trains as users of
    the job configuration expect. The others belong to this engine.
    ``negative_power`` is the power of a token's count by which it is drawn as a negative; at 0 all are drawn alike.
    With ``probe_steps`` a shard holds back one pair in ``hold_out`` and takes its loss on these every so many steps.
    """

    num_shards: int = 20
    window_size: int = 8
    stride: int = 4
    num_shards_embeddings: int = 500
    vocab_size: int = 252975
    epochs: int = 10
    embedding_dim: int = 10
    learning_rate: float = 0.01
    decay_rate: float = 0.96
    decay_steps: int = 1000
    patience: int = 10

    neighbours: int = 5
    lines_per_split: int = 10_000
    rounds: int = 3
    windows_per_shard: int = 100_000
    batch_pairs: int = 1024
    negative_pool: int = 1024
    seed: int = 17
    round_robin: bool = False
    negative_power: float = 0.0
    probe_steps: int = 0
    hold_out: int = 64
