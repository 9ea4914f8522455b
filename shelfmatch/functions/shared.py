"""Best members of groups by how many items they share with a set, without pairing the members.

Each member of a group has a few items and a place.  Members are listed under every subset of their items, once per group,
subset and number of items, the first place only.  A set finds under each of its own subsets members that share at least that
subset; the largest shared subset of any member is one of them, so the best member is among what it finds, with its exact
share.  The work follows the members and the groups asked for, not their product.

Sets of more than ``MOST_ITEMS`` items that the other side has, too, are not listed (``listed``); a caller pairs them one by one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# items of a set that is listed: it has 2^MOST_ITEMS subsets at most
MOST_ITEMS = 5
# pairs of a name and a group looked up at once
NAMES = 1 << 17


def expanded(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range each position is from, and the positions, of ranges one behind the other."""
    which = np.repeat(np.arange(len(count)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)


def distinct_sets(sets: list) -> tuple[np.ndarray, list[frozenset]]:
    """The number of each set, and the sets by number."""
    numbers: dict[frozenset, int] = {}
    at = np.fromiter((numbers.setdefault(frozenset(s), len(numbers)) for s in sets), np.int64, len(sets))
    return at, list(numbers)


class Subsets:
    """Subsets of the sets of a side, as numbers that both sides share."""

    def __init__(self, sets: list[frozenset], known: set, numbers: dict, add: bool):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.listed = np.zeros(len(sets), bool)
        start, ids, shared = [], [], []
        for k, items in enumerate(sets):
            start.append(len(ids))
            own = sorted(items & known)
            self.listed[k] = len(own) <= MOST_ITEMS
            for n in range(len(own) + 1) if self.listed[k] else ():
                for some in combinations(own, n):
                    number = numbers.setdefault(some, len(numbers)) if add else numbers.get(some)
                    if number is not None:
                        ids.append(number)
                        shared.append(n)
        self.start = np.array(start, np.int64)
        self.count = np.diff(np.array([*start, len(ids)], np.int64))
        self.ids, self.shared = np.array(ids, np.int64), np.array(shared, np.int64)


class SharedItems:
    """Members (group, number of their set in ``right``, place) for look-ups by the sets of ``left``."""

    def __init__(self, left: list[frozenset], right: list[frozenset], group: np.ndarray, member_set: np.ndarray, place: np.ndarray, n_groups: int):
        known = set().union(*left) & set().union(*right)
        numbers: dict = {}
        self.n_groups = max(1, n_groups)
        self.right = Subsets(right, known, numbers, True)
        self.left = Subsets(left, known, numbers, False)
        count = self.right.count[member_set]
        which, at = expanded(self.right.start[member_set], count)
        key = self.right.ids[at] * self.n_groups + group[which]
        size, place = self.right.size[member_set][which], place[which]
        order = np.lexsort((place, size, key))
        key, size, place = key[order], size[order], place[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (size[1:] != size[:-1])
        self.key, self.size, self.place = key[first], size[first], place[first]

    def find(self, sets: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of a left set and a group: (position of the pair, items shared at least, items of the member, its place)."""
        # many pairs are alike
        pairs, same = np.unique(sets * self.n_groups + groups, return_inverse=True)
        sets, groups = pairs // self.n_groups, pairs % self.n_groups
        which, at = expanded(self.left.start[sets], self.left.count[sets])
        key = self.left.ids[at] * self.n_groups + groups[which]
        low, high = np.searchsorted(self.key, key), np.searchsorted(self.key, key, side="right")
        some, rows = expanded(low, high - low)
        count = np.bincount(which[some], minlength=len(pairs))
        pair, found = expanded((np.cumsum(count) - count)[same], count[same])
        return pair, self.left.shared[at[some[found]]], self.size[rows[found]], self.place[rows[found]]


class Overlap:
    """Best right sets by the Jaccard similarity of whole sets of tokens, each in two parts: ``core`` and ``rest``.

    Cores are compared core by core, rests are looked up.  Any parting of the tokens gives the same result; it is fast
    where many sets share a core.
    """

    def __init__(self, left: list, right: list, core):
        parts = [[(frozenset(t for t in s if core(t)), frozenset(t for t in s if not core(t))) for s in side] for side in (left, right)]
        (self.core_of, cores), (self.form, forms) = (distinct_sets([c for c, _ in side]) for side in parts)
        (self.rest_of, rests), (rest, right_rests) = (distinct_sets([r for _, r in side]) for side in parts)
        self.table = SharedItems(rests, right_rests, self.form, rest, np.arange(len(right)), len(forms))
        self.left_listed, self.right_listed = self.table.left.listed[self.rest_of], self.table.right.listed[rest]
        numbers: dict = {}
        self.cores, self.forms = ([np.array([numbers.setdefault(t, len(numbers)) for t in c], np.int64) for c in side] for side in (cores, forms))
        self.n_tokens = len(numbers)
        self.core_size, self.form_size = (np.array([len(c) for c in side], np.int64) for side in (self.cores, self.forms))

    def common(self, cores: np.ndarray, r0: int, r1: int) -> np.ndarray:
        """Tokens in common of some cores on the left and the forms from ``r0`` to ``r1``."""
        tokens = np.unique(np.concatenate([self.cores[c] for c in cores]))
        column = np.full(self.n_tokens, -1)
        column[tokens] = np.arange(len(tokens))
        tables = []
        for sets in ([self.cores[c] for c in cores], self.forms[r0:r1]):
            at = column[np.concatenate(sets)]
            rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            tables.append(np.zeros((len(sets), len(tokens)), np.float32))
            tables[-1][rows[at >= 0], at[at >= 0]] = 1
        return np.rint(tables[0] @ tables[1].T).astype(np.int64)

    def best(self, digits: int, least: float, slack: float, tile: tuple[int, int]) -> np.ndarray:
        """Per left set the rounded score and the first place of the best listed right set, as score x n + (n - 1 - place), or -1."""
        n = len(self.form)
        best = np.full(len(self.core_of), -1, np.int64)
        reached = np.full(len(self.core_of), least)
        n_rest = self.table.left.size[self.rest_of]

        def take(names, forms, common):
            pair, shared, size, place = self.table.find(self.rest_of[names], forms)
            both, li = common[pair] + shared, names[pair]
            whole = self.core_size[self.core_of[li]] + n_rest[li] + self.form_size[forms[pair]] + size
            rounded = np.rint(both / np.maximum(whole - both, 1) * 10**digits).astype(np.int64)
            np.maximum.at(best, li, rounded * n + (n - 1 - place))
            np.maximum.at(reached, li, rounded / 10**digits - 0.5 * 10**-digits - slack)

        order = np.flatnonzero(self.left_listed)
        order = order[np.argsort(self.core_of[order], kind="stable")]
        for l0 in range(0, len(order), tile[0]):
            names = order[l0 : l0 + tile[0]]
            cores, core = np.unique(self.core_of[names], return_inverse=True)
            for r0 in range(0, len(self.forms), tile[1]):
                r1 = min(len(self.forms), r0 + tile[1])
                common = self.common(cores, r0, r1)[core]
                # at most all of the rest is shared, and nothing else is there
                most = common + n_rest[names][:, None]
                bound = most / np.maximum((self.core_size[cores][core] + n_rest[names])[:, None] + self.form_size[r0:r1] - common, 1)
                # the most promising form of each name first, then what can still beat it
                li, gi = np.arange(len(names)), bound.argmax(axis=1)
                hopeful = bound[li, gi] >= reached[names]
                li, gi = li[hopeful], gi[hopeful]
                take(names[li], gi + r0, common[li, gi])
                bound[li, gi] = -np.inf
                li, gi = np.nonzero(bound >= reached[names][:, None])
                for at in range(0, len(li), NAMES):
                    some = slice(at, at + NAMES)
                    take(names[li[some]], gi[some] + r0, common[li[some], gi[some]])
        return best
