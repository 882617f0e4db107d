"""Token ids of many texts from the ids of their distinct pieces."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Distinct pieces a worker remembers before it forgets those it has met in one batch only.
REMEMBERED = 400_000
#: Pieces joined into one string for the tokenizer, and such strings handed over at once.
JOINED, AT_ONCE = 256, 16


class PieceCoder:
    """Encodes texts that are cut into pieces whose ids do not depend on one another.

    Each distinct piece is encoded once and remembered, up to a bound, for later batches of the same worker; beyond the
    bound only pieces that came back in a later batch stay, so the many that occur once do not drive out the frequent. New
    pieces for which ``joinable`` holds are encoded many in one string, with ``glue`` between them, and told apart by
    the offsets of their tokens; the others are encoded one by one.
    """

    def __init__(self, tokenizer, joinable: Callable[[bytes], bool], glue: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer, self.joinable, self.glue = tokenizer, joinable, glue
        self.place: dict[bytes, int] = {}
        self.ids, self.starts, self.again = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, bool)

    def _forget(self) -> None:
        """Start anew, or keep the pieces that came back, if they are not too many themselves."""
        stay = np.flatnonzero(self.again) if self.place else np.zeros(0, np.int64)
        stay = stay[:0] if len(stay) > REMEMBERED // 2 else stay
        names, sizes = list(self.place), (self.starts[stay + 1] - self.starts[stay])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        self.ids = self.ids[np.repeat(self.starts[stay] - ends[:-1], sizes) + np.arange(ends[-1])]
        self.starts, self.again = ends, np.zeros(len(stay), bool)
        self.place = {names[old]: new for new, old in enumerate(stay.tolist())}

    def _learn(self, pieces: list[bytes]) -> None:
        together = [p for p in pieces if self.joinable(p)]
        alone = [p for p in pieces if not self.joinable(p)]
        groups = [together[at:at + JOINED] for at in range(0, len(together), JOINED)] + [[p] for p in alone]
        counts, ids = [], [self.ids]
        for at in range(0, len(groups), AT_ONCE):
            some = [[p.decode("utf-8") for p in group] for group in groups[at:at + AT_ONCE]]
            found = self.tokenizer.encode_batch([self.glue.join(group) for group in some], add_special_tokens=False)
            for group, encoding in zip(some, found):
                starts = np.cumsum([0] + [len(p) + len(self.glue) for p in group])
                begins = np.fromiter((begin for begin, _ in encoding.offsets), np.int64)
                counts.append(np.bincount(np.searchsorted(starts, begins, side="right") - 1, minlength=len(group)))
                ids.append(np.array(encoding.ids, np.uint32))
        known = len(self.place)
        self.place.update(zip(together + alone, range(known, known + len(pieces))))
        self.ids = np.concatenate(ids)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(counts))])
        self.again = np.concatenate([self.again, np.zeros(len(pieces), bool)])

    def encode(self, pieces: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and where those of each text start; text ``d`` has pieces ``first[d]`` to ``first[d + 1]``."""
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(len(first), np.int64)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) > REMEMBERED:
            self._forget()
        known = self.place.get
        place = np.array([known(p, -1) for p in distinct], np.int64)
        self.again[place[place >= 0]] = True
        new = np.flatnonzero(place < 0)
        if len(new):
            self._learn([distinct[i] for i in new.tolist()])
            place[new] = [self.place[distinct[i]] for i in new.tolist()]
        place = place[coded.indices.to_numpy(zero_copy_only=False)]
        starts, sizes = self.starts[place], self.starts[place + 1] - self.starts[place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
        return self.ids[take], ends[first]


_held: dict[object, object] = {}


def let_go() -> None:
    """Forget what :func:`held` keeps; called when a task ends."""
    _held.clear()


def held(key: object, make: Callable[[], object]) -> object:
    """An object a worker makes once and keeps; only the latest is kept."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]
