"""The words of lines, numbered and hashed in arrays."""

import gc
import random
import sys

import pyarrow as pa

from shelfmatch.llm.common import in_parts
from shelfmatch.llm.line_dedup import Words, line_words


def test_words_of_lines():
    rng = random.Random(3)
    texts = ["", "\n", " A b\ta \n\n b", *("".join(rng.choice("abAé日 \t\n") for _ in range(60)) for _ in range(300))]
    w, of = Words(pa.array(texts)), {}
    lines = [line for t in texts for line in t.encode().split(b"\n")]
    assert w.text_bounds[-1] == len(lines)
    found = [set() for _ in lines]
    for line, word in zip(w.line.tolist(), w.word.tolist()):
        found[line].add(int(w.hashes[word]))
    for line, hashes in zip(lines, found):
        assert len(hashes) == len(line_words(line))
        for word in line_words(line):
            of[word] = of.get(word, hashes) & hashes  # what all lines with the word have
    assert all(of.values())
    assert len({*map(int, w.hashes)}) == len(w.hashes)


def test_words_are_no_python_objects():
    text, most = pa.array([" ".join(f"word{i}" for i in range(200_000))]), 0
    gc.collect()
    before = sys.getallocatedblocks()

    def watch(*_):
        nonlocal most
        most = max(most, sys.getallocatedblocks() - before)

    sys.setprofile(watch)
    try:
        w = Words(text)
    finally:
        sys.setprofile(None)
    assert len(w.hashes) == 200_000
    assert most < 10_000


def test_batches_of_large_texts_go_in_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10_000] * 1_000 + [None])], names=["text"])
    parts = list(in_parts(iter([batch, batch.slice(0, 0), batch.slice(5, 2)])))
    assert max(p.nbytes for p in parts) <= 3 << 20
    assert pa.Table.from_batches(parts).column(0).to_pylist() == [*batch.column(0).to_pylist(), *batch.slice(5, 2).column(0).to_pylist()]
