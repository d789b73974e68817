"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The substrings
between leftmost S suffixes are sorted and named; if names repeat, the string of names is sorted
by the same routine. From the sorted leftmost S suffixes one pass induces the order of the L
suffixes and one the order of the S suffixes, each in time linear in the text.

Over a small alphabet a pass goes bucket by bucket: what a whole bucket induces is placed at
once, and a bucket that induces into itself is read again until nothing new appears. Over the
large alphabet of names a pass goes entry by entry.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are passed bucket by bucket.
SMALL = 1024


def s_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last one counts as smaller."""
    n = len(s)
    settled = np.arange(n)
    settled[:-1][s[:-1] == s[1:]] = n - 1
    settled = np.minimum.accumulate(settled[::-1])[::-1]  # next place that differs from its right
    smaller = np.ones(n, bool)
    smaller[:-1] = s[:-1] < s[1:]
    return smaller[settled]


def name_substrings(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The rank of each leftmost-smaller substring among all of them; equal ones share a rank."""
    symbols = s.astype(np.uint64) * np.uint64(2) + smaller
    width = max(1, int(symbols.max()).bit_length())
    take = max(1, 64 // width)
    n, size = len(s), np.empty(len(lms), np.int64)
    size[:-1] = lms[1:] - lms[:-1] + 1
    size[-1] = 1
    rank, active, done = np.zeros(len(lms), np.int64), np.arange(len(lms)), 0
    while len(active):
        key = np.zeros(len(active), np.uint64)
        for k in range(done, done + take):
            at = np.minimum(lms[active] + k, n - 1)
            key = (key << np.uint64(width)) | np.where(size[active] > k, symbols[at], 0).astype(np.uint64)
        order = np.lexsort((key, rank[active])) if done else np.argsort(key, kind="stable")
        group, key = rank[active][order], key[order]
        place = np.arange(len(order))
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_part = new_group | np.concatenate([[True], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(new_group, place, 0))
        start = np.maximum.accumulate(np.where(new_part, place, 0))
        rank[active[order]] = group + start - first
        alone = new_part & np.concatenate([new_part[1:], [True]])
        done += take
        left = active[order[~alone]]
        active = left[size[left] > done]
    return rank


def _bounds(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.bincount(s)
    tails = np.cumsum(sizes)
    return tails - sizes, tails


def _placed_lms(s: np.ndarray, sorted_lms: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Places of the sorted leftmost S suffixes at the ends of their buckets."""
    letters = s[sorted_lms]
    counts = np.bincount(letters, minlength=len(tails))
    before = np.cumsum(counts) - counts
    return tails[letters] - counts[letters] + np.arange(len(letters)) - before[letters]


def _induce_by_bucket(s, smaller, sorted_lms) -> np.ndarray:
    n = len(s)
    heads, tails = _bounds(s)
    small = s.astype(np.uint16)
    sa = np.full(n, -1, np.int64)
    sa[_placed_lms(s, sorted_lms, tails)] = sorted_lms
    lms_counts = np.bincount(s[sorted_lms], minlength=len(tails))
    filled = heads.copy()

    def induce(batch: np.ndarray, want_smaller: bool, ends: np.ndarray, step: int) -> None:
        before = batch[batch > 0] - 1
        before = before[smaller[before] == want_smaller]
        if not len(before):
            return
        letters = small[before]
        order = np.argsort(letters, kind="stable")
        letters = letters[order]
        counts = np.bincount(letters, minlength=len(ends))
        offset = np.arange(len(letters)) - (np.cumsum(counts) - counts)[letters]
        sa[ends[letters] + step * offset - (step < 0)] = before[order]
        ends += step * counts

    for c in np.flatnonzero(tails > heads):
        read = heads[c]
        while read < filled[c]:
            read, batch = filled[c], sa[read : filled[c]]
            induce(batch, False, filled, 1)
        if lms_counts[c]:
            induce(sa[tails[c] - lms_counts[c] : tails[c]], False, filled, 1)
    filled_s = tails.copy()
    for c in np.flatnonzero(tails > heads)[::-1]:
        read = tails[c]
        while read > filled_s[c]:
            read, batch = filled_s[c], sa[filled_s[c] : read][::-1]
            induce(batch, True, filled_s, -1)
        if filled[c] > heads[c]:
            induce(sa[heads[c] : filled[c]][::-1], True, filled_s, -1)
    sa[0] = n - 1  # the end mark, which nothing induces
    return sa


def _induce_by_entry(s, smaller, sorted_lms) -> np.ndarray:
    n = len(s)
    heads, tails = (b.tolist() for b in _bounds(s))
    places = _placed_lms(s, sorted_lms, np.array(tails))
    sa = np.full(n, -1, np.int64)
    sa[places] = sorted_lms
    sa, letters, smaller = sa.tolist(), s.tolist(), smaller.tolist()
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not smaller[j]:
            c = letters[j]
            sa[heads[c]] = j
            heads[c] += 1
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and smaller[j]:
            c = letters[j]
            tails[c] -= 1
            sa[tails[c]] = j
    sa[0] = n - 1
    return np.array(sa, np.int64)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order; s ends with 0, which occurs nowhere else."""
    s = np.asarray(s, np.int64)
    if len(s) == 1:
        return np.zeros(1, np.int64)
    smaller = s_types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    rank = name_substrings(s, smaller, lms)
    names, dense = np.unique(rank, return_inverse=True)
    order = np.argsort(rank, kind="stable") if len(names) == len(lms) else suffix_array(dense)
    induce = _induce_by_bucket if s.max() < SMALL else _induce_by_entry
    return induce(s, smaller, lms[order])


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each position, how long its suffix and the one before it in `sa` agree, up to `limit`.

    Kept in text order; eight letters are compared at a time, and only where all agreed so far.
    """
    n = len(s)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n
    padded = np.zeros(n + limit + 16, np.uint8)
    padded[:n] = s
    words = np.ndarray((n + limit + 8,), np.uint64, padded.tobytes(), 0, (1,))
    agreed = np.zeros(n, np.int64)
    active = np.flatnonzero(before < n)
    for k in range(0, limit, 8):
        apart = words[active + k] ^ words[before[active] + k]
        same = apart == 0
        if k:
            agreed[active[same]] = k + 8
        else:
            agreed[active[same]] = 8
        part = ~same
        low = apart[part] & (~apart[part] + np.uint64(1))
        agreed[active[part]] = k + (np.log2(low.astype(np.float64)).astype(np.int64) // 8)
        active = active[same]
        if not len(active):
            break
    return np.minimum(agreed, limit)
