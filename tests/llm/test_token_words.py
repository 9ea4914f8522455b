"""The encoder's words, cut, asked for together and remembered, against the library on whole texts."""

from __future__ import annotations

import gc
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shelfmatch.llm import tokens

PARTS = ["a", "Was", "foo", "don't", "'s", "x's.", "7", "42%", "é", "ñu", "…", "日本", "<|endoftext|>", "<", ".", ",;", "!?", "|*$", "\n", "\n\n", "\r\n", "\t", "\x85", "\xa0", " ", "  ", "\x1c", " ", "end.", "٣", "½", "_", "‑", "́", "😀"]


def _texts(n: int) -> list[str]:
    rng = random.Random(7)
    return ["", " ", "\n", *("".join(rng.choice(PARTS) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(1, 25))) for _ in range(n))]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_whole_texts(name, monkeypatch):
    monkeypatch.setattr(tokens, "AT_ONCE", 2_000)
    monkeypatch.setattr(tokens, "REMEMBERED", 2_000)
    encoder = tokens.TextEncoder(public_tokenizers.path(name))
    texts = _texts(4_000)
    flat, bounds = encoder.encode(pa.array(texts, pa.large_string()))
    for i, whole in enumerate(encoder.whole(texts)):
        assert np.array_equal(flat[bounds[i] : bounds[i + 1]], whole), repr(texts[i])


def test_words_on_both_sides_of_an_end_of_line_are_remembered_apart():
    encoder = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    library, asked = encoder.library, []

    class Asked:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

        def encode(self, text, **options):
            asked.append(text)
            return library.encode(text, **options)

    encoder.library = Asked()
    text = " ".join(f"one{i}.\nTwo{j}" for i in range(30) for j in range(30))
    flat, _ = encoder.encode(pa.array([text], pa.large_string()))
    assert np.array_equal(flat, library.encode(text, add_special_tokens=False).ids)
    assert len(asked) < 10 and sum(map(len, asked)) < 1_000  # 900 words from 60 parts


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    hashes = tokens.word_hashes
    monkeypatch.setattr(tokens, "word_hashes", lambda words: hashes(words) % np.uint64(5))
    monkeypatch.setattr(tokens, "AT_ONCE", 500)
    encoder = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = _texts(60)
    flat, bounds = encoder.encode(pa.array(texts, pa.large_string()))
    for i, whole in enumerate(encoder.whole(texts)):
        assert np.array_equal(flat[bounds[i] : bounds[i + 1]], whole), repr(texts[i])


def test_remembered_words_are_no_python_objects():
    words = [f" word{i}" for i in range(200_000)]
    encoder = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.encode(pa.array(["".join(words[:10])], pa.large_string()))
    gc.collect()
    tracemalloc.start()
    encoder.encode(pa.array(["".join(words)], pa.large_string()))
    gc.collect()
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 100 * len(words)  # 143 with a dictionary of words
