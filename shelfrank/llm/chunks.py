"""Tokens of texts through a table of chunks that one worker has met before.

A chunk is a piece of text whose tokens do not depend on what stands around it. Texts are cut into
chunks, each different chunk is encoded once, and the ids of a text are gathered by index.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Chunks that one worker remembers; beyond, it starts anew. Bounds memory, not results.
REMEMBERED = 800_000


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start .. start + length - 1`` of every span, one after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total) + shift


class Numbers(dict):
    """Numbers chunks in the order in which they are first asked for; ``fresh`` are those without ids yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, chunk) -> int:
        self[chunk] = n = len(self)
        self.fresh.append(chunk)
        return n


class ChunkTable:
    """Ids per chunk. ``encode`` takes a list of new chunks and gives all their ids and the lengths."""

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], remembered: int | None = None):
        self.encode, self.remembered = encode, remembered
        self._clear()

    def _clear(self) -> None:
        self.index = Numbers()
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)

    def _grown(self, array: np.ndarray, need: int) -> np.ndarray:
        if need <= len(array):
            return array
        wider = np.zeros(max(need, 2 * len(array)), array.dtype)
        wider[: len(array)] = array
        return wider

    def _add(self, new: list) -> None:
        ids, lengths = self.encode(new)
        first = len(self.index) - len(new)
        self.ids = self._grown(self.ids, self.used + len(ids))
        self.starts = self._grown(self.starts, first + len(new))
        self.lengths = self._grown(self.lengths, first + len(new))
        self.ids[self.used : self.used + len(ids)] = ids
        self.lengths[first : first + len(new)] = lengths
        self.starts[first : first + len(new)] = self.used + np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.used += len(ids)

    def tokens(self, rows: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all rows (each a list of chunks), and the number of ids per row."""
        every = [c for row in rows for c in row]
        if not every:
            return np.zeros(0, np.int32), np.zeros(len(rows), np.int64)
        if len(self.index) > (REMEMBERED if self.remembered is None else self.remembered):
            self._clear()
        try:
            at = np.fromiter(map(self.index.__getitem__, every), np.int64, len(every))
            if self.index.fresh:
                self._add(self.index.fresh)
                self.index.fresh = []
        except BaseException:
            self._clear()  # no chunk may keep a number without ids
            raise
        lengths = self.lengths[at]
        ids = self.ids[spans(self.starts[at], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        per_row = np.cumsum([0, *map(len, rows)])
        return ids, ends[per_row[1:]] - ends[per_row[:-1]]
