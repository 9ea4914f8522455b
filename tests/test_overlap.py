"""A scorer of the caller that looks its tokens up."""

from registry.matching import TokenOverlap

from .test_best_match import described
from .test_shared import of_one_form


def test_tokens_of_one_core_are_not_scored_in_pairs(monkeypatch):
    left, right = of_one_form(700, 3), of_one_form(700, 4) + ["agua natural " + " ".join(f"{k}pz" for k in range(9))]
    left.append(right[-1] + " 77ml")  # too many tokens with a digit to be listed
    scored = []
    score = TokenOverlap.score
    monkeypatch.setattr(TokenOverlap, "score", lambda self, a, b: scored.append(len(a)) or score(self, a, b))
    li, ri, scores = TokenOverlap().match(described(left), described(right), 0.5)
    assert sum(scored) < 20 * (len(left) + len(right))

    def overlap(a, b):
        a, b = set(a.split(" ")), set(b.split(" "))
        return round(len(a & b) / len(a | b), 4)

    found = {left[a]: (b, c) for a, b, c in zip(li, ri, scores)}
    for a in left:
        best, place = min((-overlap(a, b), i) for i, b in enumerate(right))
        assert found.get(a) == ((place, -best) if -best >= 0.5 else None)
