"""Secrets in documents: fixed patterns, and a character convolutional network over every other candidate.

The base patterns are findings by definition.  A candidate is every other run of 16 or more characters of the alphabet
that keys are written in.  The network reads the candidate, whatever its length, with the characters around it: a
filter looks at five characters at a time (and at whether they lie inside the candidate), the strongest response of
each filter goes into a logistic unit.  It is trained on labelled findings: base findings against candidates that no
pattern names, all of them: above ``MAX_LABELLED`` of a kind, shards train side by side and their weights are averaged
after every round.  On findings held back from training the scores are
calibrated (a logistic fit); the threshold is ``THRESHOLD``, or as much lower as it takes to find ``RECALL`` of the
held-back secrets, with and without their surroundings.  Candidates above it are added as kind ``network``; base findings stay as they are.

With fewer than ``LEAST`` labelled findings of either kind nothing is trained and nothing added.  Null and empty texts
have no findings.  Repeated rows get the same result.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, staged, text_of

#: Labelled findings of each kind that one task trains on; more are trained on in shards.
MAX_LABELLED = 4000
#: Rounds of training in shards.
ROUNDS = 6
LEAST = 40
RECALL = 0.99
#: Calibrated probability at which a candidate is added, where that keeps the recall; lower where it does not.
THRESHOLD = 0.9

BEFORE, AFTER = 24, 12
WIDTH, FILTERS = 5, 16
STRETCH = 256

KINDS = ["assign", "access", "hex", "network"]
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")


def base_findings(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; code points."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def keys_of(text: str) -> list[tuple[int, int]]:
    """The secrets of the base findings themselves, without the words that announce them."""
    found = {m.span(2) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8}
    return sorted(found | {m.span() for p in (_ACCESS, _HEX) for m in p.finditer(text)})


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Runs that no base finding touches."""
    runs = [m.span() for m in _CANDIDATE.finditer(text)]
    return [(a, b) for a, b in runs if not any(x < b and a < y for _, x, y in base)] if base else runs


def window(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - BEFORE) : start], text[start:end], text[end : end + AFTER]


def codes(parts: tuple[str, str, str]) -> np.ndarray:
    """Characters as numbers: printable ASCII and a rest, apart for outside and inside the candidate."""
    out = []
    for k, part in enumerate(parts):
        c = np.frombuffer(part.encode("utf-32-le"), "<u4").astype(np.int64) - 31
        out.append(np.where((c < 1) | (c > 95), 96, c) + (97 if k == 1 else 0))
    return np.concatenate(out)


class Network:
    """Strongest response of each filter over all positions, then a logistic unit."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.filters = rng.normal(0, 0.1, (WIDTH, 194, FILTERS)).astype(np.float32)
        self.filters[:, 0] = 0
        self.bias = np.zeros(FILTERS, np.float32)
        self.unit = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.rest = np.float32(0)
        self.scale, self.shift, self.threshold = 1.0, 0.0, 2.0

    def _stretches(self, samples: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Stretches, padded with -1, that overlap so that every position is seen, and where each sample's begin."""
        cut, first = [], []
        for s in samples:
            first.append(len(cut))
            cut += [s[i : i + STRETCH + WIDTH - 1] for i in range(0, max(1, len(s) - WIDTH + 1), STRETCH)]
        x = np.full((len(cut), max(WIDTH, max(map(len, cut)))), -1)
        for row, s in zip(x, cut):
            row[: len(s)] = s
        return x, np.array(first)

    def _responses(self, x: np.ndarray) -> np.ndarray:
        n = x.shape[1] - WIDTH + 1
        seen = np.maximum(x, 0)
        found = sum(self.filters[k][seen[:, k : k + n]] for k in range(WIDTH)) + self.bias
        beyond = x[:, WIDTH - 1 :] < 0
        beyond[:, 0] = False  # a sample has one position at least
        return np.where(beyond[:, :, None], np.float32(-1e9), found)

    def raw(self, samples: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(samples))
        for i in range(0, len(samples), 128):
            x, first = self._stretches(samples[i : i + 128])
            strongest = np.concatenate([self._responses(x[j : j + 256]).max(axis=1) for j in range(0, len(x), 256)])
            pooled = np.maximum(np.maximum.reduceat(strongest, first), 0)
            out[i : i + 128] = pooled @ self.unit + self.rest
        return out

    def train(self, samples: list[np.ndarray], labels: np.ndarray, steps: int = 240, rate: float = 0.02, seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        short = [s if len(s) <= STRETCH else s[:STRETCH] for s in samples]  # training may look at part of a finding; scoring never does
        kinds = [np.flatnonzero(labels == v) for v in (0, 1)]
        state = {k: [np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))] for k in ("filters", "bias", "unit", "rest")}
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(k, 64) for k in kinds])
            x, _ = self._stretches([short[i] for i in pick])
            hidden = rng.random(len(pick)) < 0.5
            x = np.where(hidden[:, None] & (x < 97) & (x >= 0), 0, x)  # half of the time only the candidate is seen
            y = labels[pick]
            r = self._responses(x)
            at = r.argmax(axis=1)
            top = np.take_along_axis(r, at[:, None], axis=1)[:, 0]
            pooled = np.maximum(top, 0)
            error = (1 / (1 + np.exp(-(pooled @ self.unit + self.rest))) - y) / len(y)
            back = error[:, None] * self.unit * (top > 0)
            slope = np.zeros_like(self.filters)
            for k in range(WIDTH):
                np.add.at(slope[k], (np.take_along_axis(np.maximum(x, 0), at + k, axis=1), np.arange(FILTERS)[None, :]), back)
            slope[:, 0] = 0
            slopes = {"filters": slope + 1e-4 * self.filters, "bias": back.sum(axis=0), "unit": error @ pooled + 1e-3 * self.unit, "rest": error.sum()}
            for name, g in slopes.items():
                m, v = state[name]
                state[name] = [m := 0.9 * m + 0.1 * g, v := 0.999 * v + 0.001 * g * g]
                change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                setattr(self, name, (getattr(self, name) - change).astype(np.float32))

    def calibrate(self, samples: list[np.ndarray], labels: np.ndarray) -> None:
        """A logistic fit of the labels to the raw score, and a threshold that keeps the recall."""
        self.fit_scale(self.raw(samples), labels, np.ones(len(samples)))

    def fit_scale(self, s: np.ndarray, labels: np.ndarray, n: np.ndarray) -> None:
        """The calibration from raw scores, each with its label and how often it occurs."""
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * s + b)))
            w = n * (p * (1 - p) + 1e-6)
            h = np.array([[(w * s * s).sum() + 1e-2, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-2]])
            d = np.linalg.solve(h, [(n * (labels - p) * s).sum() - 1e-2 * (a - 1), (n * (labels - p)).sum() - 1e-2 * b])
            a, b = a + d[0], b + d[1]
        self.scale, self.shift = float(max(a, 1e-3)), float(b)
        at = np.flatnonzero(labels == 1)
        at = at[np.argsort(s[at], kind="stable")]
        ends = np.cumsum(n[at])
        found = s[at[np.searchsorted(ends, int(ends[-1] * (1 - RECALL)), side="right")]]
        self.threshold = min(THRESHOLD, float(1 / (1 + np.exp(-np.clip(self.scale * found + self.shift, -60, 60)))))

    def probability(self, samples: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(samples) + self.shift, -60, 60)))


def _trained(samples: list[np.ndarray], labels: np.ndarray, chosen: np.ndarray) -> Network:
    network = Network()
    network.train([s for s, c in zip(samples, chosen) if c], labels[chosen])
    return network


def fit(secrets: list[tuple[str, str, str]], others: list[tuple[str, str, str]]) -> Network | None:
    """A network trained on three quarters of the labelled findings and calibrated on the rest.

    Candidates that no pattern names may be secrets all the same.  Each half of the findings trains a network that
    reads the other half; candidates that it takes for secrets are no examples of ordinary ones.
    """
    if min(len(secrets), len(others)) < LEAST:
        return None
    samples = [codes(w) for w in [*secrets, *others]]
    labels = np.array([1.0] * len(secrets) + [0.0] * len(others))
    half = np.arange(len(samples)) % 2 == 0
    usable = labels == 1
    for part in (half, ~half):
        scores = _trained(samples, labels, part).raw(samples)
        usable |= ~part & (scores < 0)
    if (usable & (labels == 0)).sum() < LEAST:
        return None
    samples, labels = [s for s, u in zip(samples, usable) if u], labels[usable]
    held = np.arange(len(samples)) % 4 == 3
    network = _trained(samples, labels, ~held)
    apart = [s for s, h in zip(samples, held) if h]
    bare = [np.where(s < 97, 0, s) for s in apart]  # the scores have to hold without the surroundings, too
    network.calibrate(apart + bare, np.tile(labels[held], 2))
    return network


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_WINDOWS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("before", pa.string()), ("inside", pa.string()), ("after", pa.string())]))
_WINDOWS_SQL = "array<struct<start: long, end: long, before: string, inside: string, after: string>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base findings with their windows, and candidates with theirs, for every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("base", _SPANS), ("labelled", _WINDOWS), ("open", _WINDOWS)])

    def windows(text, spans):
        return [dict(zip(("start", "end", "before", "inside", "after"), (a, b, *window(text, a, b)))) for a, b in spans]

    def find(doc_id, text):
        base = [base_findings(t) for t in text]
        return {
            "doc_id": doc_id, "base": [[dict(zip(("kind", "start", "end"), f)) for f in found] for found in base],
            "labelled": [windows(t, keys_of(t) if found else []) for t, found in zip(text, base)],
            "open": [windows(t, candidates(t, found)) for t, found in zip(text, base)],
        }

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(by_batch(find, schema), f"doc_id long, base array<struct<kind: string, start: long, end: long>>, labelled {_WINDOWS_SQL}, open {_WINDOWS_SQL}")


def _windows(found: DataFrame) -> DataFrame:
    """All distinct windows (before, inside, after, y: 1 of a base finding, 0 of a candidate), with two hashes."""
    both = [found.select(F.explode(c).alias("w")).select("w.before", "w.inside", "w.after", F.lit(y).alias("y")) for c, y in (("labelled", 1), ("open", 0))]
    rows = both[0].union(both[1]).distinct()
    return staged(rows.withColumns({"h": F.xxhash64("before", "inside", "after"), "part": F.pmod(F.hash("before", "inside", "after"), F.lit(8))}), "windows")


def _counts(rows: DataFrame) -> tuple[int, int]:
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    return n.get(0, 0), n.get(1, 0)


def _all(rows: DataFrame, y: int) -> list[tuple[str, str, str]]:
    """The windows of one kind, of which there are at most MAX_LABELLED."""
    some = rows.where(F.col("y") == y).orderBy("h", "before", "inside", "after").collect()
    return [(r["before"], r["inside"], r["after"]) for r in some]


_WEIGHTS = ("filters", "bias", "unit", "rest")


def _mean(networks: DataFrame, like: Network) -> Network:
    """The network of the mean weights; every partition adds up its own."""
    schema = pa.schema([("n", pa.int64()), ("w", pa.list_(pa.float64()))])

    def add(batches):
        n, total = 0, 0.0
        for b in batches:
            for w in b.column(0).to_pylist():
                n, total = n + 1, total + np.array(w)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total], pa.list_(pa.float64()))], schema=schema)

    sums = networks.mapInArrow(add, "n long, w array<double>").collect()  # a row for each partition
    mean = sum(np.array(r["w"]) for r in sums) / sum(r["n"] for r in sums)
    out, at = Network(), 0
    for name in _WEIGHTS:
        old = getattr(like, name)
        setattr(out, name, mean[at : at + old.size].reshape(old.shape).astype(np.float32)[()])
        at += old.size
    return out


def _trained_on_all(rows: DataFrame) -> Network:
    """A network trained on all windows: shards of about MAX_LABELLED of each kind train side by side from common weights,
    whose mean the next round begins with.  Every shard has both kinds: the rarer one is dealt to several."""
    shards = [max(1, -(-n // MAX_LABELLED)) for n in _counts(rows)]
    most = max(shards)
    own = F.when(F.col("y") == 1, F.lit(shards[1])).otherwise(F.lit(shards[0]))
    dealt = rows.select(
        "y", "h", "before", F.substring("inside", 1, STRETCH).alias("inside"), "after",  # training sees no more
        F.explode(F.sequence(F.pmod("h", own).cast("int"), F.lit(most - 1), own.cast("int"))).alias("shard"))
    dealt = staged(dealt, "shards")
    network = Network()
    for k in range(ROUNDS):
        network = _mean(dealt.groupBy("shard").applyInArrow(_round(network, k), "w array<double>"), network)
    return network


def _round(start: Network, k: int):
    """Round ``k`` of training, for one shard: its weights, or nothing if it lacks a kind."""

    def train(some):
        some = some.sort_by([(c, "ascending") for c in ("h", "y", "before", "inside", "after")])
        before, inside, after, y = (some.column(c).to_pylist() for c in ("before", "inside", "after", "y"))
        if len(set(y)) < 2:
            return pa.table({"w": pa.array([], pa.list_(pa.float64()))})
        mine = Network()
        for name in _WEIGHTS:
            setattr(mine, name, getattr(start, name))
        mine.train([codes(w) for w in zip(before, inside, after)], np.array(y, np.float64), steps=240 // ROUNDS, seed=2 + k)
        weights = np.concatenate([np.ravel(getattr(mine, name)) for name in _WEIGHTS]).astype(np.float64)
        return pa.table({"w": pa.array([weights], pa.list_(pa.float64()))})

    return train


def _rated(rows: DataFrame, networks: list[Network], bare: bool = False) -> DataFrame:
    """Windows with ``s``, the raw score of the network of ``which``; ``bare`` without the surroundings."""
    shared = rows.sparkSession.sparkContext.broadcast(networks)

    def rate(batches):
        for b in batches:
            before, inside, after, which = (b.column(c).to_pylist() for c in ("before", "inside", "after", "which"))
            s, which = np.zeros(len(which)), np.array(which)
            samples = [codes(w) for w in zip(before, inside, after)]
            if bare:
                samples = [np.where(x < 97, 0, x) for x in samples]
            for k, network in enumerate(shared.value):
                at = np.flatnonzero(which == k)
                s[at] = network.raw([samples[i] for i in at])
            yield b.append_column("s", pa.array(s))

    return rows.mapInArrow(rate, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, s double")


def fit_all(rows: DataFrame) -> Network | None:
    """``fit`` on all windows of a corpus: training in shards, the threshold from the counts of all held-back scores."""
    if min(n := _counts(rows)) < LEAST:
        return None
    if max(n) <= MAX_LABELLED:
        return fit(_all(rows, 1), _all(rows, 0))
    half = F.col("part") % 2
    readers = [_trained_on_all(rows.where(half != k)) for k in (0, 1)]  # each half is read by the network of the other
    rated = _rated(rows.withColumn("which", half.cast("int")), readers)
    rows = staged(rated.where("y = 1 or s < 0").drop("s", "which"), "usable")
    if _counts(rows)[0] < LEAST:
        return None
    held = F.col("part") >= 6
    network = _trained_on_all(rows.where(~held))
    apart = rows.where(held).withColumn("which", F.lit(0))
    rated = _rated(apart, [network]).union(_rated(apart, [network], bare=True))
    # all scores, counted in steps of a hundredth
    steps = rated.groupBy(F.round("s", 2).alias("s"), "y").agg(F.count("*").alias("n")).orderBy("s", "y").toPandas()
    network.fit_scale(steps["s"].to_numpy(), steps["y"].to_numpy(np.float64), steps["n"].to_numpy(np.float64))
    return network


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end), base findings and the network's, by start, then kind."""
    found = staged(scan(docs), "findings")
    shared = docs.sparkSession.sparkContext.broadcast(fit_all(_windows(found)))
    schema = pa.schema([("doc_id", pa.int64()), ("spans", _SPANS)])

    def add(doc_id, base, opened):
        network, spans = shared.value, [list(b) for b in base]
        flat = [(i, w) for i, ws in enumerate(opened) for w in ws]
        if network is not None and flat:
            chance = network.probability([codes((w["before"], w["inside"], w["after"])) for _, w in flat])
            for (i, w), p in zip(flat, chance):
                if p >= network.threshold:
                    spans[i].append({"kind": "network", "start": w["start"], "end": w["end"]})
        return {"doc_id": doc_id, "spans": [sorted(s, key=lambda x: (x["start"], KINDS.index(x["kind"]))) for s in spans]}

    return found.select("doc_id", "base", "open").mapInArrow(by_batch(add, schema), "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the base findings' sha256 and all spans as one string."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])

    def row(doc_id, spans):
        all_spans = [[(s["kind"], s["start"], s["end"]) for s in one] for one in spans]
        base = [[s for s in one if s[0] != "network"] for one in all_spans]
        out = {f"n_{k}": [sum(s[0] == k for s in one) for one in base] for k in KINDS[:3]}
        return out | {"doc_id": doc_id, "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b in base], "spans": [joined(s) for s in all_spans]}

    return found.mapInArrow(by_batch(row, schema), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
