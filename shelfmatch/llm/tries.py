"""Double-array tries over sequences of whole numbers, built and walked by numpy.

A number is spelled in ``width`` digits of eight bits, high digit first.  The child of state s by digit d is
``base[s] + d``, if ``check`` there is s.  State 0 is the root.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_RADIX = 256


def digit_count(numbers: int) -> int:
    """Digits that spell all of 0 to ``numbers`` - 1."""
    return max(1, (max(numbers - 1, 1).bit_length() + 7) // 8)


def digits(numbers: np.ndarray, width: int) -> np.ndarray:
    """One row of digits per number."""
    shifts = np.arange(width - 1, -1, -1) * 8
    return (numbers[:, None] >> shifts) & (_RADIX - 1)


@dataclass
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    width: int

    def step(self, states: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The states after one more number each, -1 where there is none; all move at once, digit by digit."""
        out = np.full(len(states), -1, np.int32)
        alive = np.flatnonzero((states >= 0) & (numbers >= 0))
        at, spelled = states[alive], digits(numbers[alive], self.width)
        for k in range(self.width):
            to = self.base[at] + spelled[:, k]
            ok = self.check[to] == at
            alive, at, spelled = alive[ok], to[ok].astype(np.int32), spelled[ok]
        out[alive] = at
        return out


def _place(parents: np.ndarray, wanted: np.ndarray, base: np.ndarray, check: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Find room for the children (parents, digit ``wanted``, sorted) of one level; returns the grown arrays.

    Parents with many children go first.  All parents of about the same number propose a random base at once; those
    whose slots are free, and claimed by no other, are settled.  The room grows when too few are.
    """
    owner, first, sizes = np.unique(parents, return_index=True, return_counts=True)
    for low, high in ((65, 257), (17, 65), (5, 17), (2, 5), (1, 2)):
        pending = np.flatnonzero((sizes >= low) & (sizes < high))
        if len(pending):
            # a parent of n children finds room soon while the load is well under 1 / n
            spare = int(sizes[pending].sum() * max(1.5, low / 4))
            base, check = _grown(base, check, max(0, spare - int((check < 0).sum())))
        while len(pending):
            proposed = rng.integers(0, len(check) - 2 * _RADIX, len(pending))
            if low == 1:  # a single child fits into any free slot
                free = np.flatnonzero(check[_RADIX : -2 * _RADIX] < 0) + _RADIX
                taken = rng.permutation(free)[: len(pending)]
                proposed[: len(taken)] = taken - wanted[first[pending[: len(taken)]]]
            rows = np.repeat(np.arange(len(pending)), sizes[pending])
            offset = np.arange(len(rows)) - np.repeat(np.cumsum(sizes[pending]) - sizes[pending], sizes[pending])
            slots = proposed[rows] + wanted[first[pending][rows] + offset]
            claim = np.full(len(check), -1, np.int32)
            claim[slots] = rows
            good = np.bincount(rows, (check[slots] < 0) & (claim[slots] == rows), len(pending)) == sizes[pending]
            good &= proposed > 0
            held = good[rows]
            check[slots[held]] = owner[pending][rows[held]]
            base[owner[pending[good]]] = proposed[good]
            if good.mean() < 0.05:
                base, check = _grown(base, check, int(sizes[pending].sum()) + 4 * _RADIX)
            pending = pending[~good]
    return base, check


def _grown(base: np.ndarray, check: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
    by += by // 8 + 2 * _RADIX if by else 0
    return np.concatenate((base, np.ones(by, np.int32))), np.concatenate((check, np.full(by, -1, np.int32)))


def build(sequences: np.ndarray, numbers: int, seed: int = 0) -> tuple[DoubleArray, np.ndarray]:
    """A trie of the rows of ``sequences`` (padded at the end with -1), and the state that each row ends in.

    A prefix of a row that is no row itself has a state like any other.
    """
    width = digit_count(numbers)
    rng = np.random.default_rng(seed)
    base, check = np.ones(4 * _RADIX, np.int32), np.full(4 * _RADIX, -1, np.int32)
    check[0] = 0  # the root's own slot is taken
    states = np.zeros(len(sequences), np.int32)
    for column in sequences.T:
        rows = np.flatnonzero(column >= 0)
        spelled = digits(column[rows], width)
        for k in range(width):
            pairs = np.unique(states[rows].astype(np.int64) * _RADIX + spelled[:, k])
            if len(pairs):
                base, check = _place((pairs // _RADIX).astype(np.int32), pairs % _RADIX, base, check, rng)
            states[rows] = base[states[rows]] + spelled[:, k]
    base, check = _grown(base, check, _RADIX)  # any base plus any digit is inside
    return DoubleArray(base, check, width), states
