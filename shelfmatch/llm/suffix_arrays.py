"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller or larger than their right neighbour.  The leftmost-smaller ones cut the text into
substrings, which are sorted and named; where names repeat, the text of names is sorted recursively.  From the sorted
leftmost-smaller suffixes the larger ones are induced by a pass over the buckets from the left, the smaller ones by a
pass from the right.  Over bytes a pass takes a bucket at a time, as all of a bucket's entries place their left
neighbours alike; the shorter texts of names, whose buckets are many and small, are passed entry by entry.
"""

from __future__ import annotations

import numpy as np


def classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; ``t`` ends with its unique smallest number."""
    n = len(t)
    differs = np.flatnonzero(t[:-1] != t[1:])
    smaller = np.ones(n, bool)
    if len(differs):
        at = np.searchsorted(differs, np.arange(n - 1))  # the next place where neighbours differ decides
        smaller[:-1] = (t[:-1] < t[1:])[differs[np.minimum(at, len(differs) - 1)]]
    return smaller


def _leftmost(smaller: np.ndarray) -> np.ndarray:
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _induce_bytes(t: np.ndarray, smaller: np.ndarray, sorted_lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order; one bucket at a time."""
    n, k = len(t), len(sizes)
    ends = np.cumsum(sizes)
    head, tail = ends - sizes, ends.copy()
    begins = head.copy()
    # the characters before each place, or k where a pass has nothing to put there
    first = t.astype(np.uint16)
    before_larger, before_smaller = np.full(n, k, np.uint16), np.full(n, k, np.uint16)
    before_larger[1:] = np.where(smaller[:-1], k, first[:-1])
    before_smaller[1:] = np.where(smaller[:-1], first[:-1], k)
    lms_of = np.split(sorted_lms, np.searchsorted(first[sorted_lms], np.arange(1, k)))
    sa = np.empty(n, np.int64)
    places = np.arange(n)

    def deal(found: np.ndarray, before: np.ndarray, right: bool) -> None:
        """Put what stands before the entries, in order, at the heads or tails of its buckets."""
        c = before[found]
        order = np.argsort(c, kind="stable")
        counts = np.bincount(c, minlength=k + 1)[:k]
        many = int(counts.sum())
        if not many:
            return
        inside = places[:many] - np.repeat(np.cumsum(counts) - counts, counts)
        if right:
            sa[np.repeat(tail - 1, counts) - inside] = found[order[:many]] - 1
            tail[:] -= counts
        else:
            sa[np.repeat(head, counts) + inside] = found[order[:many]] - 1
            head[:] += counts

    for c in range(k):
        at = begins[c]
        while at < head[c]:  # entries of this bucket can place others in it
            upto = head[c]
            deal(sa[at:upto], before_larger, right=False)
            at = upto
        if len(lms_of[c]):
            deal(lms_of[c], before_larger, right=False)
    for c in range(k - 1, -1, -1):
        at = ends[c]
        while at > tail[c]:
            upto = tail[c]
            deal(sa[upto:at][::-1], before_smaller, right=True)
            at = upto
        if head[c] > begins[c]:
            deal(sa[begins[c] : head[c]][::-1], before_smaller, right=True)
    sa[0] = n - 1
    return sa


def _induce_names(t: np.ndarray, smaller: np.ndarray, sorted_lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same, entry by entry.  An empty place holds n, which like 0 leads to the last entry, where nothing is placed."""
    n = len(t)
    of_larger, of_smaller = np.where(smaller, -1, t), np.where(smaller, t, -1)
    of_larger[-1] = of_smaller[-1] = -1
    ends = np.cumsum(sizes)
    sa = np.full(n, n, np.int64)
    # the leftmost-smaller ones to the ends of their buckets, in order
    c = t[sorted_lms]
    of_bucket = np.bincount(c, minlength=len(sizes))
    sa[(ends - np.cumsum(of_bucket))[c] + np.arange(len(c))] = sorted_lms
    sa = sa.tolist()
    head, bucket = (ends - sizes).tolist(), of_larger.tolist()
    for i in sa:
        if (c := bucket[i - 1]) >= 0:
            sa[head[c]] = i - 1
            head[c] += 1
    tail, bucket = ends.tolist(), of_smaller.tolist()
    for i in reversed(sa):
        if (c := bucket[i - 1]) >= 0:
            tail[c] -= 1
            sa[tail[c]] = i - 1
    sa[0] = n - 1
    return np.array(sa, np.int64)


def _induce(t: np.ndarray, smaller: np.ndarray, sorted_lms: np.ndarray) -> np.ndarray:
    sizes = np.bincount(t)
    if len(sizes) <= 512 and len(t) > 64:
        return _induce_bytes(t, smaller, sorted_lms, sizes)
    return _induce_names(t, smaller, sorted_lms, sizes)


def _names(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the leftmost-smaller substrings by content, from them in order, and how many differ."""
    position = np.full(len(t), -1, np.int64)
    position[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms), 1) + 1
    length[-1] = 1
    first = order
    a, b = first[:-1], first[1:]
    la, lb = length[position[a]], length[position[b]]
    same = la == lb
    check = np.flatnonzero(same)
    depth = 0
    while len(check):
        check = check[depth < la[check]]
        if not len(check):
            break
        equal = (t[a[check] + depth] == t[b[check] + depth]) & (smaller[a[check] + depth] == smaller[b[check] + depth])
        same[check[~equal]] = False
        check = check[equal]
        depth += 1
    rank = np.concatenate(([0], np.cumsum(~same)))
    names = np.empty(len(lms), np.int64)
    names[position[first]] = rank
    return names, int(rank[-1]) + 1


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``t`` in order; ``t`` holds non-negative integers and ends with a unique 0."""
    n = len(t)
    if n <= 2:
        return np.arange(n - 1, -1, -1)
    smaller = classify(t)
    lms = _leftmost(smaller)
    if not len(lms):
        return np.arange(n - 1, -1, -1)
    by_first = lms[np.argsort(t[lms], kind="stable")]
    rough = _induce(t, smaller, by_first)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    names, different = _names(t, smaller, lms, rough[is_lms[rough]])
    if different == len(lms):
        order = np.empty(len(lms), np.int64)
        order[names] = np.arange(len(lms))
    else:
        order = suffix_array(names)
    return _induce(t, smaller, lms[order])


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the common prefix of its suffix with the one before it in order (permuted).

    Where the characters to the left differ the value is compared out; elsewhere it is the left neighbour's less one.
    The values compared out sum to at most n log n.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    start = np.arange(n)
    has = before >= 0
    reducible = np.zeros(n, bool)
    inner = np.flatnonzero(has & (start > 0) & (before > 0))
    reducible[inner] = t[inner - 1] == t[before[inner] - 1]
    heads = np.flatnonzero(~reducible)
    value = np.zeros(n, np.int64)
    live, depth = heads[has[heads]], 0
    while len(live):  # the unique last 0 ends every comparison
        equal = t[live + depth] == t[before[live] + depth]
        value[live[~equal]] = depth
        live, depth = live[equal], depth + 1
    head = heads[np.cumsum(~reducible) - 1]
    return value[head] - (start - head)
