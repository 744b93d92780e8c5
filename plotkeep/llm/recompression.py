"""Run-length grammars by recompression, and common extensions on them, for whole arrays of symbols.

Two steps alternate until one symbol is left. Block compression replaces every
maximal block of one symbol by a new symbol. Pair compression splits the symbols
into a left and a right half and replaces each left symbol that a right one
follows, with it, by a new symbol. Equal stretches are so cut alike but for their
edges, and the common extension of two places is found by one comparison per
level: upwards while the symbols agree, then downwards into the first that
differ. All queries of a call go through the levels together.

A symbol is only ever joined by what stands beside it, so a level is kept as its
symbols and the bounds of the groups that become symbols of the next one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from plotkeep.llm.text import U64, mix

# Splits tried for a pair step; the one that joins most pairs is taken.
SPLITS = 3


@dataclass
class Level:
    """Symbols, then one that equals no other, and where the groups begin that make the next level's symbols."""

    symbols: np.ndarray
    bounds: np.ndarray
    blocks: bool  # equal symbols were grouped; else pairs

    def __post_init__(self) -> None:
        sizes = np.diff(self.bounds)
        self.group = np.append(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.int32(len(sizes)))

    def mirrored(self) -> Level:
        n = len(self.symbols) - 1
        return Level(np.append(self.symbols[n - 1::-1] if n else self.symbols[:0], self.symbols[-1]),
                     (n - self.bounds[::-1]).astype(np.int32), self.blocks)


def _named(symbols: np.ndarray, bounds: np.ndarray, keys: np.ndarray, grouped: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """The next level's symbols: the single ones stay, each kind of group gets a new one."""
    new = symbols[bounds[:-1]]
    kinds, name = np.unique(keys, return_inverse=True)
    new[grouped] = name.astype(np.int32) + np.int32(fresh)
    return new, fresh + len(kinds)


def _dense(symbols: np.ndarray) -> tuple[np.ndarray, int]:
    kinds, name = np.unique(symbols, return_inverse=True)
    return name.astype(np.int32), len(kinds)


class Grammar:
    """The levels over an array of symbols (integers from 0 on)."""

    def __init__(self, symbols: np.ndarray):
        symbols, fresh = _dense(symbols)
        self.levels: list[Level] = []
        while len(symbols) > 1:
            symbols, fresh = self._blocks(symbols, fresh)
            if len(symbols) > 1:
                symbols, fresh = self._pairs(symbols, fresh)
        self.top = len(symbols)

    def _add(self, symbols: np.ndarray, bounds: np.ndarray, blocks: bool) -> None:
        self.levels.append(Level(np.append(symbols, np.int32(-1)), bounds.astype(np.int32), blocks))

    def _blocks(self, symbols: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
        if len(starts) == len(symbols):  # nothing repeats
            return symbols, fresh
        bounds = np.append(starts, len(symbols))
        sizes = np.diff(bounds)
        grouped = np.flatnonzero(sizes > 1)
        keys = symbols[starts[grouped]].astype(np.int64) * (int(sizes.max()) + 1) + sizes[grouped]
        self._add(symbols, bounds, True)
        return _named(symbols, bounds, keys, grouped, fresh)

    def _pairs(self, symbols: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        best = None
        for split in range(SPLITS):
            left = (mix(symbols.astype(U64) + U64((len(self.levels) * SPLITS + split + 1) << 40)) & U64(1)).astype(bool)
            joined = np.flatnonzero(left[:-1] & ~left[1:])
            if best is None or len(joined) > len(best):
                best = joined
        if not len(best):  # by chance no pair in any split: join what begins with the first symbol
            best = np.flatnonzero((symbols[:-1] == symbols[0]) & (symbols[1:] != symbols[0]))
        first = np.ones(len(symbols) + 1, bool)
        first[best + 1] = False
        bounds = np.flatnonzero(first)
        grouped = np.searchsorted(bounds, best)
        keys = symbols[best].astype(np.int64) * (1 << 31) + symbols[best + 1]
        self._add(symbols, bounds, False)
        return _named(symbols, bounds, keys, grouped, fresh)

    def mirrored(self) -> Grammar:
        """The same grammar read from the other end."""
        other = Grammar.__new__(Grammar)
        other.levels, other.top = [level.mirrored() for level in self.levels], self.top
        return other

    def extension(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many symbols agree from the places ``one`` and ``two`` on (pairwise different; a place may be the end)."""
        i, j = one.astype(np.int64), two.astype(np.int64)
        went = np.arange(len(one))
        parted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # upwards: to the next level's symbols while these begin at both places
        for level in self.levels:
            symbols, bounds, group = level.symbols, level.bounds, level.group
            same = symbols[i] == symbols[j]
            begin_i, begin_j = bounds[group[i]] == i, bounds[group[j]] == j
            inside = same & ~(begin_i & begin_j)
            if level.blocks:
                # inside a block the rest of the shorter one agrees
                at = np.flatnonzero(inside)
                step = np.minimum(bounds[group[i[at]] + 1] - i[at], bounds[group[j[at]] + 1] - j[at])
            else:
                at, step = np.flatnonzero(inside), 1
            i[at] += step
            j[at] += step
            rises = same & (bounds[group[i]] == i) & (bounds[group[j]] == j)
            stays = ~rises
            parted.append((i[stays], j[stays], went[stays]))
            went, i, j = went[rises], group[i[rises]].astype(np.int64), group[j[rises]].astype(np.int64)
        # downwards: into the symbols that differ, past what their beginnings share
        down_i, down_j, down = i, j, went
        for level, (i, j, ids) in zip(reversed(self.levels), reversed(parted)):
            symbols, bounds, group = level.symbols, level.bounds, level.group
            down_i, down_j = bounds[down_i].astype(np.int64), bounds[down_j].astype(np.int64)
            shared = np.flatnonzero(symbols[down_i] == symbols[down_j])
            if level.blocks:
                at_i, at_j = down_i[shared], down_j[shared]
                step = np.minimum(bounds[group[at_i] + 1] - at_i, bounds[group[at_j] + 1] - at_j)
            else:
                step = 1
            down_i[shared] += step
            down_j[shared] += step
            down_i, down_j, down = np.concatenate([down_i, i]), np.concatenate([down_j, j]), np.concatenate([down, ids])
        length = np.empty(len(one), np.int64)
        length[down] = down_i - one[down]
        return length
