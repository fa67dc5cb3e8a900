"""A run-length grammar of a sequence by recompression, with exact extension queries.

Two steps alternate until one symbol is left: a maximal block ``aaa`` becomes one
symbol (a, 3), then every pair of a left symbol and a right symbol next to it
becomes one symbol (the halves are drawn anew in each round, turned the way that
shortens more). Equal (parts) get equal names, so equal stretches are cut alike
except near their ends, and two suffixes are compared by whole symbols: upwards
while both positions begin a symbol, downwards where symbols differ. A query
takes a few steps on each of the O(log n) levels; queries run in lockstep on
arrays.
"""

from __future__ import annotations

import numpy as np

from .textarrays import mix


class Grammar:
    """The levels of a sequence of symbols (non-negative 64-bit integers)."""

    def __init__(self, symbols: np.ndarray) -> None:
        _, names = np.unique(symbols, return_inverse=True)
        names = np.append(names.astype(np.int64) + 1, 0)      # 0 ends the sequence and occurs nowhere else
        self._names: list[np.ndarray] = [names]
        self._first: list[np.ndarray] = []                    # of a symbol above: its first symbol here (and the end)
        self._up: list[np.ndarray] = []                       # of a symbol here: the one above
        self._blocks: list[bool] = []
        turn = 0
        while len(names) > 2:
            first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            if len(first) < len(names):
                size = np.diff(np.append(first, len(names)))
                names = self._put(names[first] * (len(names) + 1) + size, first, True)
            turn += 1
            left = mix(names.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1) == 0
            left[-1] = not left[-1]                           # the end joins no pair, whichever way it is turned
            forth, back = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
            forth[-1] = back[-1] = False
            pair = forth if forth.sum() >= back.sum() else back
            if pair.any():
                first = np.flatnonzero(np.append(True, ~pair))
                second = np.where(np.append(pair, False)[first], names[np.minimum(first + 1, len(names) - 1)] + 1, 0)
                names = self._put(names[first] * (names.max() + 2) + second, first, False)

    def _put(self, keys: np.ndarray, first: np.ndarray, blocks: bool) -> np.ndarray:
        """A level whose symbols begin at ``first``; symbols of equal keys get one name."""
        below = len(self._names[-1])
        ends = np.zeros(below, np.int64)
        ends[first[1:]] = 1
        self._up.append(np.cumsum(ends))
        self._first.append(np.append(first, below))
        self._blocks.append(blocks)
        _, names = np.unique(keys, return_inverse=True)
        names = names.astype(np.int64) + 1
        names[-1] = 0
        self._names.append(names)
        return names

    def _step(self, level: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Symbols of ``level`` to pass when those at p and q are equal: the rest of a block, else one."""
        if level < len(self._blocks) and self._blocks[level]:
            up, first = self._up[level], self._first[level]
            return np.minimum(first[up[p] + 1] - p, first[up[q] + 1] - q)
        return np.ones(len(p), np.int64)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j (i <> j, elementwise)."""
        p, q = i.astype(np.int64), j.astype(np.int64)
        top = len(self._up)
        stop = np.full(len(p), top)                           # the level where symbols were seen to differ
        going = np.arange(len(p))
        for level in range(top + 1):
            names, waiting = self._names[level], going
            while len(waiting):
                if level < top:                               # both begin a symbol above: decided there
                    up, first = self._up[level], self._first[level]
                    a, b = p[waiting], q[waiting]
                    waiting = waiting[(first[up[a]] != a) | (first[up[b]] != b)]
                a, b = p[waiting], q[waiting]
                same = names[a] == names[b]
                stop[waiting[~same]] = level
                going = going[~np.isin(going, waiting[~same], assume_unique=True)] if not same.all() else going
                waiting, step = waiting[same], self._step(level, a[same], b[same])
                p[waiting] += step
                q[waiting] += step
            if level < top:
                p[going], q[going] = self._up[level][p[going]], self._up[level][q[going]]
        for level in range(top, -1, -1):
            down = np.flatnonzero(stop >= level)
            waiting = down[stop[down] > level]
            while len(waiting):
                a, b = p[waiting], q[waiting]
                same = self._names[level][a] == self._names[level][b]
                waiting, step = waiting[same], self._step(level, a[same], b[same])
                p[waiting] += step
                q[waiting] += step
            if level:
                p[down], q[down] = self._first[level - 1][p[down]], self._first[level - 1][q[down]]
        return p - i
