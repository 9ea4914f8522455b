"""Batches of large texts become Python objects in parts."""

import pyarrow as pa
import pyarrow.compute as pc

from shelfmatch.llm.common import by_batch, lean


def test_a_large_batch_goes_in_parts():
    sizes, schema = [], pa.schema([("n", pa.int64())])

    def lengths(text):
        sizes.append(sum(map(len, text)))
        return {"n": [len(t) for t in text]}

    texts = ["x" * 10_000] * 1_000 + [""] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    out = pa.Table.from_batches(by_batch(lengths, schema)(iter([batch, batch.slice(0, 0), batch.slice(5, 2)])))
    assert out.column("n").to_pylist() == [*map(len, texts), 10_000, 10_000]
    assert max(sizes) <= 3 << 20  # rows of like sizes


def test_a_worker_gives_memory_back():
    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return int(next(line for line in f if line.startswith("Rss:")).split()[1]) >> 10

    batch = pa.RecordBatch.from_arrays([pa.array(["some words of a text " * 100] * 10_000)], names=["text"])

    def split(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pc.list_value_length(pc.split_pattern(pc.utf8_upper(b.column(0)), " "))], names=["n"])

    pa.default_memory_pool().release_unused()
    before = resident()
    for _ in lean(split)(iter([batch] * 3)):
        pass
    assert resident() - before < 40
