"""Plain Python scoring of name pairs, written from the formulas, for small fixtures."""

import math
import re
import unicodedata


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[-1]))
        prev = row
    return prev[-1]


def percent(a, b):
    total = len(a) + len(b)
    return 100 if total == 0 else round((1 - (total - 2 * lcs(a, b)) / total) * 100)


def token_sort(s):
    return " ".join(sorted(re.sub(r"\W", " ", s).lower().split()))


def without_units(s):
    return re.sub(r"\d+[mltpzgok|]+(\s|$)", "", s).strip(" ")


def units(s):
    return re.findall(r"\d*\.?\d+[mltpzgok|]+", s)


def set_similarity(a, b):
    both = set(a) | set(b)
    return len(set(a) & set(b)) / len(both) if both else 1


def unit_distance(a, b):
    ua, ub = units(a), units(b)
    if len(ua) == 1 and len(ub) == 1:
        ua, ub = re.split(r"(\d+)", ua[0]), re.split(r"(\d+)", ub[0])
    return 1 - set_similarity(ua, ub)


def closeness(a, b, dice_weight=0.7):
    a, b = without_units(a), without_units(b)
    lev = (100 - percent(token_sort(a), token_sort(b))) * 0.01
    total = len(set(a)) + len(set(b))
    dice = 1 - 2.0 * len(set(a) & set(b)) / total if total else 0
    return 1 - (lev * (2 - dice_weight) + dice * dice_weight) / 2


def confidence(a, b, unit_weight=0.17, decay=1.01, digits=4):
    raw = closeness(a, b) - unit_distance(a, b) * unit_weight
    return 0.0 if raw <= 0 else round(math.exp(1 - 1 / raw**decay), digits)


def best(left, right, threshold, **weights):
    """{name: (id, confidence)}: highest confidence, then smallest id, at or above the threshold."""
    out = {}
    for a in left:
        scored = [(-confidence(a, b, **weights), i) for i, b in right]
        if scored and -min(scored)[0] >= threshold:
            out[a] = (min(scored)[1], -min(scored)[0])
    return out


def fold(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
