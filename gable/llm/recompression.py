"""Recompression: a run-length grammar of a sequence, and longest common extensions on it.

The sequence is shrunk level by level. A block level replaces every maximal
block of equal symbols by one symbol of (symbol, length); a pair level deals
the symbols to two sides by a hash bit and replaces every pair (left, right) of
neighbours by one symbol. What a level does at a place depends on the symbols
beside it alone, so two equal stretches are parsed alike but for their ends.

A longest common extension climbs the levels while both places are at the edge
of a symbol of the next level (after at most one symbol or the rest of a block that
they share), and then comes down, taking what is still equal at each level.
It compares symbols, never hashes of stretches, and the lowest level is the
sequence itself, so it is exact. All queries go together as arrays.
"""

from __future__ import annotations

import numpy as np

from gable.llm.shingles import mix


class Grammar:
    """Levels of a sequence of numbers from 0; see the module.

    ``symbols[k]`` are the symbols of level k with a sign of its own at
    either end; ``first[k]`` says at which symbol of level k - 1 they begin (and one
    more entry, where the last one ends), ``parent[k]`` in which symbol of level k + 1 they are.
    """

    def __init__(self, sequence: np.ndarray):
        size = len(sequence)
        now = np.empty(size + 2, dtype=np.int64)
        now[1:-1] = sequence
        top = int(sequence.max()) + 1 if size else 0
        now[0], now[-1] = top, top + 1
        self.symbols, self.first, self.parent, self.blocks = [now], [None], [], [False]
        names = top + 2
        while len(now) > 3:
            block = len(self.symbols) % 2 == 1
            if block:
                starts = np.flatnonzero(np.concatenate([[True], now[1:] != now[:-1]]))
            else:
                left = self._left(now, names, len(self.symbols))
                joined = left[:-1] & ~left[1:]  # a pair starts here
                starts = np.flatnonzero(~np.concatenate([[False], joined]))
            lengths = np.diff(np.concatenate([starts, [len(now)]]))
            new = now[starts].copy()
            made = np.flatnonzero(lengths > 1)
            if len(made):
                second = lengths[made] if block else now[starts[made] + 1]
                _, name = np.unique(now[starts[made]] * np.int64(max(names, int(second.max()) + 1)) + second, return_inverse=True)
                new[made] = names + name
                names += int(name.max()) + 1
            elif not block and len(self.symbols) > 200:
                break  # no pair for so many levels: the rest is compared symbol by symbol
            self.parent.append(np.repeat(np.arange(len(starts)), lengths))
            self.first.append(np.concatenate([starts, [len(now)]]))
            self.symbols.append(new)
            self.blocks.append(block)
            now = new

    @staticmethod
    def _left(symbols: np.ndarray, names: int, level: int) -> np.ndarray:
        """Whether a symbol is of the left side: a bit of its mixed name, another one on each level."""
        return (mix(symbols.astype(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 63) - 1)) & np.uint64(1)).astype(bool)

    def _rest(self, k: int, at: np.ndarray, forward: bool) -> np.ndarray:
        """Symbols from ``at`` to the far edge of its parent, itself included."""
        up = self.parent[k][at]
        return self.first[k + 1][up + 1] - at if forward else at - self.first[k + 1][up] + 1

    def _near_edge(self, k: int, at: np.ndarray, forward: bool) -> np.ndarray:
        up = self.parent[k][at]
        return self.first[k + 1][up] == at if forward else self.first[k + 1][up + 1] - 1 == at

    def _advance(self, k: int, a: np.ndarray, b: np.ndarray, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """How far equal symbols at a and b reach at level k, and whether both come to an edge of the next level so."""
        step = np.ones(len(a), dtype=np.int64)
        if k + 1 < len(self.symbols) and self.blocks[k + 1]:  # a block's rest at once
            x, y = self._rest(k, a, forward), self._rest(k, b, forward)
            return np.minimum(x, y), x == y
        return step, np.ones(len(a), dtype=bool)

    def lce(self, i: np.ndarray, j: np.ndarray, forward: bool = True) -> np.ndarray:
        """How many symbols from i and j on (to the right, or to the left) are equal; i and j differ."""
        sign = 1 if forward else -1
        a, b = np.asarray(i, np.int64) + 1, np.asarray(j, np.int64) + 1
        begun, levels = a.copy(), len(self.symbols)
        stopped = np.full(len(a), levels - 1)
        live = np.arange(len(a))
        for k in range(levels - 1):
            x, y = a[live], b[live]
            edge = self._near_edge(k, x, forward) & self._near_edge(k, y, forward)
            equal = self.symbols[k][x] == self.symbols[k][y]
            inside = np.flatnonzero(~edge & equal)
            stays = ~edge & ~equal
            if len(inside):
                step, _ = self._advance(k, x[inside], y[inside], forward)
                x[inside] += sign * step
                y[inside] += sign * step
                a[live], b[live] = x, y
                at_edge = self._near_edge(k, x[inside], forward) & self._near_edge(k, y[inside], forward)
                stays[inside] = ~at_edge
            stopped[live[stays]] = k
            live = live[~stays]
            a[live], b[live] = self.parent[k][a[live]], self.parent[k][b[live]]
        for k in range(levels - 1, -1, -1):
            here = np.flatnonzero(stopped >= k)
            going = here
            while len(going):
                going = going[self.symbols[k][a[going]] == self.symbols[k][b[going]]]
                if len(going):
                    step, _ = self._advance(k, a[going], b[going], forward)
                    a[going] += sign * step
                    b[going] += sign * step
            if k:  # to the first (last) symbol below
                for at in (a, b):
                    at[here] = self.first[k][at[here]] if forward else self.first[k][at[here] + 1] - 1
        return (a - begun) * sign
