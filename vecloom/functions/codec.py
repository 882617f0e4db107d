"""The byte-pair tokenizer as an Arrow function: a batch of lines in, a batch of id lists out."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql.functions import arrow_udf

_NO_IDS = np.empty(0, np.int32)


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str):
    """One encoder per worker process; building it costs far more than a batch."""
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(p): int(r) for p, r in pairs}, special_tokens={})


def encoder(ranks: Broadcast, pattern: str) -> Callable:
    """Text to ids. Strings that look like special tokens are plain text; an empty text has no ids."""

    @arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding = _encoding(ranks.value, pattern)
        for batch in batches:
            # a list of ids takes ten times the memory of the array, so one text's is held at a time
            ids = [np.array(encoding.encode_ordinary(text.as_py()), np.int32) if text.is_valid else _NO_IDS for text in batch]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([_NO_IDS, *ids])
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=batch.is_null())

    return encode
