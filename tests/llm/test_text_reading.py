import numpy as np
import public_tokenizers
import pyarrow as pa

from shelfmatch.llm import collocations, tokens


def test_texts_are_numbered_in_small_parts(monkeypatch):
    texts, sizes = ["blue ring " * 40_000] * 30, []
    encoder = tokens.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    numbered = encoder._numbered
    monkeypatch.setattr(encoder, "_numbered", lambda some: sizes.append(sum(map(len, some.to_pylist()))) or numbered(some))
    flat, bounds = encoder.encode(pa.array(texts, pa.large_string()))
    assert sum(sizes) == 12_000_000 and max(sizes) <= 4 << 20
    one = encoder.whole(texts[:1])[0]
    assert (flat.reshape(30, -1) == one).all() and bounds.tolist() == [len(one) * k for k in range(31)]


def test_words_of_odd_texts():
    texts = ["a\tB  c\x0bd. e,,f\x0c\r\n g", "", " ", "\t\t", ". .", " x  y", "\x1c\x85 é"]
    batch = pa.RecordBatch.from_arrays([pa.array(["u", "v", "v", "v", "v", "w", "u"]), pa.array(texts)], names=["lang", "text"])
    (words,) = collocations.read_words(iter([batch]))
    assert [words.vocabulary[c].decode() for c in words.codes] == ["a", "b", "c", "d", "e", "f", "g", "x", "y", "\x1c\x85", "é"]
    assert [words.langs[n] for n in words.lang] == [*"uuuuuuu", *"ww", *"uu"]
    assert words.joined.tolist() == [True, True, False, False, False, False, False, True, False, True, False]
    (empty,) = collocations.read_words(iter([batch.slice(1, 3)]))
    assert len(empty.codes) == len(empty.lang) == len(empty.joined) == 0 and empty.codes.dtype == np.int64
