"""Names of one form are looked up by what they share, not paired."""

import random

import numpy as np
import pandas as pd
import pytest

from shelfmatch.functions.shared import SharedItems, distinct_sets
from shelfmatch.functions.similarity import Scoring
from shelfmatch.operators import best_match as B

from . import brute
from .test_best_match import described


def of_one_form(n, seed):
    random.seed(seed)
    out = {"agua natural"}
    while len(out) < n:
        out.add(" ".join(["agua natural", *(f"{random.randint(1, 60)}{u}" for u in random.sample(["ml", "pz", "g", "oz"], random.randint(0, 3)))]))
    return sorted(out)


@pytest.mark.parametrize("scoring", [Scoring(), Scoring.first_version()])
def test_names_of_one_form_are_not_paired(monkeypatch, scoring):
    left, right = of_one_form(1500, 1), of_one_form(1500, 2)
    compared = []
    distance = B._distance

    def counted(shared, a, b):
        compared.append(len(shared))
        return distance(shared, a, b)

    pairwise = B._Units.distance
    monkeypatch.setattr(B._Units, "distance", lambda self, li, ri: compared.append(len(li)) or pairwise(self, li, ri))
    monkeypatch.setattr(B, "_distance", counted)
    li, ri, confidence = B.score_block(described(left), described(right), scoring, 0.4)
    assert sum(compared) < 100 * (len(left) + len(right))
    some = random.sample(range(len(left)), 25)
    catalog = [(f"{i:05d}", x) for i, x in enumerate(right)]
    expected = brute.best([left[i] for i in some], catalog, 0.4, unit_weight=scoring.unit_weight, decay=scoring.decay, digits=scoring.digits)
    found = {left[a]: (f"{b:05d}", c) for a, b, c in zip(li, ri, confidence)}
    assert {left[i]: found[left[i]] for i in some if left[i] in found} == expected


def test_the_best_of_a_group_is_found():
    random.seed(5)
    sets = [[frozenset(random.sample("abcdefgh", random.randint(0, 4))) for _ in range(n)] for n in (60, 200)]
    group = np.array([random.randrange(6) for _ in sets[1]])
    (mine, left), (theirs, right) = (distinct_sets(s) for s in sets)
    table = SharedItems(left, right, group, theirs, np.arange(len(theirs)), 6)
    pairs = pd.MultiIndex.from_product([range(len(mine)), sorted(set(group))])
    names, groups = pairs.get_level_values(0).to_numpy(), pairs.get_level_values(1).to_numpy()
    pair, shared, size, place = table.find(mine[names], groups)
    for p, (k, g) in enumerate(zip(names, groups)):
        at = np.flatnonzero(pair == p)
        similar = [(-shared[i] / max(1, len(sets[0][k]) + size[i] - shared[i]), place[i]) for i in at]
        plain = [(-len(sets[0][k] & s) / max(1, len(sets[0][k] | s)), i) for i, s in enumerate(sets[1]) if group[i] == g]
        assert min(similar) == min(plain)
