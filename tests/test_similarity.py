import math
import random

import pytest
from pyspark.sql import functions as F

from shelfmatch.functions import similarity as S
from shelfmatch.functions.lcs import lcs_lengths
from shelfmatch.functions.similarity import Scoring

from . import brute


@pytest.fixture
def pairwise(spark):
    def run(fn, pairs):
        df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
        return [r[0] for r in df.select("i", fn(F.col("a"), F.col("b")).alias("v")).orderBy("i").select("v").collect()]
    return run


def random_names(n, seed=3):
    random.seed(seed)
    words = ["coca", "cola", "leche", "lala", "lalalala\x03light", "agua", "vino", "tinto", "a", "redbull", "&"]
    unit = ["355ml", "12pz", "1.5lt", "900g", "24pz", "6pz", "2lt", ".5lt"]
    return [" ".join(random.choices(words, k=random.randint(0, 4)) + random.choices(unit, k=random.randint(0, 3))) for _ in range(n)]


def test_lcs_lengths_of_any_length():
    random.seed(1)
    def text(n):
        return "".join(random.choice("abcdeñ é") for _ in range(n))
    sizes = [0, 1, 5, 20, 63, 64, 65, 127, 128, 129, 300]
    a = [text(random.choice(sizes)) for _ in range(150)]
    b = [text(random.choice(sizes)) for _ in range(150)]
    assert list(lcs_lengths(a, b)) == [brute.lcs(x, y) for x, y in zip(a, b)]


def test_units(apply):
    assert apply(S.extract_units, ["coca 355ml 12pz", "1.5lt .5kg", "x", "12 pz"]) == [["355ml", "12pz"], ["1.5lt", ".5kg"], [], []]
    assert apply(S.remove_units, ["coca 355ml 12pz", "agua 1.5lt", "355ml coca", "3lata x"]) == ["coca", "agua 1.", "coca", "3lata x"]


def test_token_sort_ratio(pairwise):
    pairs = [("b a", "a b"), ("", ""), ("a", ""), ("abc", "abd"), ("new york mets", "new york meats"), (None, "a")]
    assert pairwise(S.token_sort_ratio, pairs) == [100, 100, 0, 67, 96, None]


def test_dice(pairwise):
    assert pairwise(S.dice_distance, [("aab", "ab"), ("", ""), ("a", ""), ("ab", "bc")]) == [0.0, 0.0, 1.0, 0.5]


def test_unit_distance(pairwise):
    pairs = [("500ml", "12pz"), ("500ml", "500g"), ("a", "b"), ("500ml 12pz", "12pz"), ("500ml", "500ml"), ("500ml", "")]
    assert pairwise(S.unit_distance, pairs) == pytest.approx([1 - 1 / 5, 1 - 2 / 4, 0, 0.5, 0, 1])


def test_calibration(apply):
    assert apply(lambda x: S.calibrate(x, 1.01), [0.0, 1.0, 0.5], "x double") == pytest.approx([0, 1, math.exp(1 - 1 / 0.5**1.01)])


def test_confidence_agrees_with_plain_python(pairwise):
    left, right = random_names(300), random_names(300, 4)
    pairs = list(zip(left, right))
    got = pairwise(S.confidence, pairs)
    assert got == [brute.confidence(a, b) for a, b in pairs]
    assert all(0 <= c <= 1 for c in got)
    assert pairwise(S.confidence, [(b, a) for a, b in pairs]) == got
    assert set(pairwise(S.confidence, [(a, a) for a in left])) == {1.0}


def test_first_version_weights(pairwise):
    pairs = [(a, b) for a, b in zip(random_names(100), random_names(100, 9)) if brute.closeness(a, b) > 0.2]
    scoring = Scoring.first_version()
    got = pairwise(lambda a, b: S.confidence(a, b, scoring), pairs)
    assert got == [brute.confidence(a, b, 0.1, 1.1, 2) for a, b in pairs]


def test_least_raw_bounds_the_threshold():
    for t in (0.35, 0.4, 0.65, 0.9):
        x = Scoring().least_raw(t)
        assert round(math.exp(1 - 1 / (x - 1e-4) ** 1.01), 4) < t <= round(math.exp(1 - 1 / (x + 1e-4) ** 1.01), 4)
