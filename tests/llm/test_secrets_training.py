"""The network of op6 is trained and calibrated on all labelled findings, however many there are."""

import random
import string

import numpy as np

from shelfmatch.llm import secrets


def test_all_findings_are_trained_on(spark, monkeypatch):
    random.seed(1)
    key = string.ascii_letters + string.digits
    text = [f"call with token = {''.join(random.choices(key, k=30))} now" for _ in range(300)]
    text += [f"see the {'-'.join(random.choices(['red', 'house', 'tree', 'over', 'river'], k=5))}.html page {i}" for i in range(500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(text)] + [(900, None), (901, text[0])], "doc_id long, text string")
    staged, dealt = secrets.staged, []

    def kept(df, name):
        out = staged(df, name)
        if name == "shards":
            dealt.append(out)
        return out

    monkeypatch.setattr(secrets, "MAX_LABELLED", 150)
    monkeypatch.setattr(secrets, "staged", kept)
    rows = secrets._windows(staged(secrets.scan(docs), "findings"))
    assert secrets._counts(rows)[1] == 300
    network = secrets.fit_all(rows)
    # two halves, then what is not held back: nothing is left out, and no shard grows with the corpus
    windows = ["before", "inside", "after", "y"]
    assert dealt[0].union(dealt[1]).select(windows).distinct().count() == rows.select(windows).distinct().count()
    assert dealt[2].where("y = 1").select(windows).distinct().count() == rows.where("part < 6 and y = 1").select(windows).distinct().count()
    assert max(r["count"] for d in dealt for r in d.groupBy("shard", "y").count().collect()) < 2.5 * secrets.MAX_LABELLED
    found = rows.toPandas()
    chance = network.probability([secrets.codes(w) for w in zip(found.before, found.inside, found.after)])
    taken, secret = chance >= network.threshold, found.y.to_numpy() == 1
    assert taken[secret].mean() > 0.95 and taken[~secret].mean() < 0.05 and np.isfinite(chance).all()
