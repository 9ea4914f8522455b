"""Longest common subsequence for many pairs at once.

Bit-parallel recurrence (Hyyro 2004): one bit per character of the shorter
string, one step per character of the longer one, vectorised over the pairs of
an Arrow batch.  Any length works; a string of n characters takes n/64 words.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# pairs are worked on in slices: small enough for the processor caches, and with
# character masks below a fixed number of words
SLICE_PAIRS = 65536
MASK_WORDS = 4_000_000


def _popcount(words: np.ndarray) -> np.ndarray:
    if hasattr(np, "bitwise_count"):
        return np.bitwise_count(words).astype(np.int64)
    as_bytes = np.ascontiguousarray(words).view(np.uint8).reshape(*words.shape, 8)
    return np.unpackbits(as_bytes, axis=-1).sum(axis=-1, dtype=np.int64)


def encode(strings) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes 1..k per character (0 pads), lengths, k."""
    lengths = np.fromiter((len(s) for s in strings), np.int64, len(strings))
    width = max(1, int(lengths.max(initial=0)))
    points = np.array(list(strings), dtype=f"<U{width}").view(np.uint32).reshape(len(lengths), width)
    letters = np.unique(points)
    letters = letters[letters != 0]
    codes = np.where(points == 0, 0, np.searchsorted(letters, points) + 1)
    return codes.astype(np.int32), lengths, len(letters)


def lcs_pairs(codes: np.ndarray, lengths: np.ndarray, k: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """LCS length of rows ``left[i]`` and ``right[i]`` of ``codes``."""
    swap = lengths[left] > lengths[right]
    short, long = np.where(swap, right, left), np.where(swap, left, right)
    words = np.maximum(1, -(-lengths[short] // 64))
    # equal word counts together, long texts first, so that finished pairs are a suffix
    order = np.lexsort((-lengths[long], words))
    out = np.zeros(len(left), np.int64)
    for w in np.unique(words):
        todo = order[words[order] == w]
        per_slice = max(1, min(SLICE_PAIRS, MASK_WORDS // int((k + 1) * w)))
        for start in range(0, len(todo), per_slice):
            part = todo[start : start + per_slice]
            out[part] = _lcs_slice(codes, lengths, k, int(w), short[part], long[part])
    return out


def _lcs_slice(codes, lengths, k, w, short, long):
    rows, row_of = np.unique(short, return_inverse=True)
    masks = np.zeros((len(rows), k + 1, w), np.uint64)
    for pos in range(min(codes.shape[1], 64 * w)):
        bit = np.uint64(1) << np.uint64(pos % 64)
        masks[np.arange(len(rows)), codes[rows, pos], pos // 64] |= bit
    masks[:, 0, :] = 0
    masks = masks.reshape(-1) if w == 1 else masks.reshape(-1, w)
    offset = row_of.astype(np.int64) * (k + 1)
    text_len = lengths[long]
    steps = int(text_len.max(initial=0))
    text = np.ascontiguousarray(codes[long, :steps].T)
    state = np.full(len(short) if w == 1 else (len(short), w), np.uint64(0xFFFFFFFFFFFFFFFF))
    running = len(short) - np.searchsorted(np.sort(text_len), np.arange(steps), side="right")
    for j in range(steps):
        n = running[j]
        v = state[:n]
        m = masks.take(offset[:n] + text[j, :n], axis=0)
        u = v & m
        if w == 1:
            total = v + u
        else:
            total = np.empty_like(v)
            carry = np.zeros(n, np.uint64)
            for i in range(w):
                first = v[:, i] + u[:, i]
                total[:, i] = first + carry
                carry = ((first < v[:, i]) | (total[:, i] < first)).astype(np.uint64)
        # v - u clears the matched bits, the same as v ^ u since u is a subset of v
        np.bitwise_or(total, v ^ u, out=v)
    ones = _popcount(~state)
    return ones if w == 1 else ones.sum(axis=1)


def lcs_lengths(a, b) -> np.ndarray:
    """LCS lengths of two equally long sequences of strings."""
    ids, strings = pd.factorize(np.concatenate([np.asarray(a, object), np.asarray(b, object)]))
    codes, lengths, k = encode(strings)
    return lcs_pairs(codes, lengths, k, ids[: len(a)], ids[len(a) :])


@F.pandas_udf(IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence; null where a side is null."""
    known = a.notna() & b.notna()
    out = pd.Series(pd.NA, index=a.index, dtype="Int32")
    if known.any():
        out[known] = lcs_lengths(a[known].to_numpy(object), b[known].to_numpy(object))
    return out


def indel_percents(lcs: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Indel similarity 1 - (total - 2 lcs) / total as whole percents; 100 where total is 0."""
    share = 1 - (total - lcs * 2) / np.maximum(total, 1)
    return np.where(total == 0, 100.0, np.rint(share * 100))


@F.pandas_udf(IntegerType())
def indel_percent(a: pd.Series, b: pd.Series) -> pd.Series:
    """Indel similarity of two texts, whole percent; null where a side is null."""
    known = a.notna() & b.notna()
    out = pd.Series(pd.NA, index=a.index, dtype="Int32")
    if known.any():
        left, right = a[known], b[known]
        total = (left.str.len() + right.str.len()).to_numpy(np.float64)
        out[known] = indel_percents(lcs_lengths(left.to_numpy(object), right.to_numpy(object)), total).astype(np.int32)
    return out
