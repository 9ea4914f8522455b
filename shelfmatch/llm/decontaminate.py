"""Benchmark passages in documents, within an edit budget, by pigeonhole pieces and bit-parallel distance.

Texts are compared in lower case with white space as single blanks.  A test item of m characters may differ by
``m // 15`` edits (``1 / per_edit``).  Cut into one piece more than its budget, an item within budget leaves one piece
at least untouched, so a scan for all pieces at once (Aho-Corasick) misses nothing.  Each hit names a stretch of the
document; Myers' bit-parallel algorithm finds the least distance of the item to any part of it.

The benchmark is the stated query set.  It is taken in blocks of bounded size, each of which goes to every task; each
row of the documents passes all blocks in turn, so its result does not depend on how the benchmark is cut.

Null and empty items match nothing; a null or empty text holds no item.  Equal items all match.  Repeated rows get the
same result.  Empty tables give results without matches.  Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, table, text_of

#: Characters of an item for each edit allowed.
PER_EDIT = 15
#: Characters of test items in a block.
BLOCK_CHARS = 8 << 20


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, per_edit: int = PER_EDIT) -> list[tuple[int, str]]:
    """Offsets and texts of the budget-plus-one pieces."""
    n = len(item) // per_edit + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def least_distance(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, end) of the part of ``text`` nearest to the pattern; ``masks`` has its positions by character."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        plus = mh | (full & ~(xv | ph))
        minus = ph & xv
        if score < best:
            best, end = score, at
    return best, end


class Items:
    """A block of test items and the automaton of their pieces."""

    def __init__(self, rows: list[tuple[int, str]], per_edit: int):
        self.items = []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in rows:
            item = plain(text or "")
            if item:
                masks: dict[str, int] = {}
                for i, c in enumerate(item):
                    masks[c] = masks.get(c, 0) | 1 << i
                for offset, piece in pieces(item, per_edit):
                    found.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item_id, len(item), len(item) // per_edit, masks))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if found:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end in the plain text) for each item within its budget, at its best place."""
        if not self.items:
            return []
        text, tried, best = plain(text), set(), {}
        for last, (size, owners) in self.automaton.iter(text):
            for i, offset in owners:
                item_id, m, budget, masks = self.items[i]
                step = (last - size + 1 - offset) // (budget + 1)
                if (i, step) in tried:
                    continue
                tried.add((i, step))
                begin = max(0, step * (budget + 1) - budget)
                distance, end = least_distance(masks, m, text[begin : (step + 1) * (budget + 1) + m + budget])
                if distance <= budget and (i not in best or distance < best[i][0]):
                    best[i] = (distance, begin + end)
        return [(self.items[i][0], d, e) for i, (d, e) in sorted(best.items())]


def blocks(benchmark: DataFrame, per_edit: int = PER_EDIT) -> Iterator[Items]:
    """The items in blocks of about ``BLOCK_CHARS`` characters; a block at a time is on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = chars // BLOCK_CHARS + 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield Items([(r["item_id"], r["text"]) for r in rows], per_edit)


def matches(docs: DataFrame, benchmark: DataFrame, per_edit: int = PER_EDIT) -> DataFrame:
    """doc_id and ``items``: (item_id, distance, end), one row for each row of ``docs``, whatever the number of blocks."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("items", kind)])
    none = F.array().cast("array<struct<item_id: long, distance: int, end: long>>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"), none.alias("items"))
    for block in blocks(benchmark, per_edit):  # the rows go through the blocks in turn
        shared = docs.sparkSession.sparkContext.broadcast(block.__dict__)

        def run(batches, shared=shared):
            known = Items.__new__(Items)
            known.__dict__ = shared.value
            for b in batches:
                found = [[dict(zip(("item_id", "distance", "end"), x)) for x in known.matches(t)] for t in b.column(1).to_pylist()]
                yield table(schema, doc_id=b.column(0), text=b.column(1), items=[x + f for x, f in zip(b.column(2).to_pylist(), found)])

        rows = rows.mapInArrow(lean(run), "doc_id long, text string, items array<struct<item_id: long, distance: int, end: long>>")
    return rows.select("doc_id", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, per_edit: int = PER_EDIT) -> DataFrame:
    """doc_id, n_items, least_distance (null: none) and item_ids per document."""
    found = matches(docs, benchmark, per_edit)
    ids = F.array_distinct(F.transform("items", lambda x: x["item_id"]))
    return found.select("doc_id", F.size(ids).cast("long").alias("n_items"), F.array_min(F.transform("items", lambda x: x["distance"])).alias("least_distance"), F.array_sort(ids).alias("item_ids"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, per_edit: int = PER_EDIT) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all their columns as they are."""
    text_at = docs.columns.index("text")
    for block in blocks(benchmark, per_edit):
        shared = docs.sparkSession.sparkContext.broadcast(block.__dict__)

        def run(batches, shared=shared):
            known = Items.__new__(Items)
            known.__dict__ = shared.value
            for b in batches:
                yield b.filter(pa.array([not known.matches(t or "") for t in b.column(text_at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs
