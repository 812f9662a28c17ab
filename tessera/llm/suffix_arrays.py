"""Suffix arrays by induced sorting and permuted longest common prefixes, in whole-array steps."""

from __future__ import annotations

import numpy as np

from .tokens import Grams


def _doubled(ranks: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string over a large alphabet, by doubling the ranked length."""
    n, k = len(ranks), 1
    ranks = ranks.astype(np.int64)
    while True:
        after = np.full(n, -1, dtype=np.int64)
        after[: n - k] = ranks[k:] if k < n else after[:0]
        both = ranks * (n + 1) + after + 1
        order = np.argsort(both)  # equal ones get equal ranks, in any order
        ordered = both[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        ranks = np.empty(n, dtype=np.int64)
        ranks[order] = new
        if new[-1] == n - 1 or k >= n:
            return order
        k *= 2


def _induce(s: np.ndarray, is_s: np.ndarray, stars: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sort all suffixes from the order of the leftmost-smaller ones: larger-type suffixes are
    placed from the left, bucket by bucket, then smaller-type ones from the right."""
    n, sigma = len(s), len(bounds) - 1
    sa = np.full(n, -1, dtype=np.int32)
    size = np.bincount(s[stars], minlength=sigma)
    small = np.uint16 if sigma <= 1 << 16 else s.dtype  # short integers are sorted by radix
    order = stars[np.argsort(s[stars].astype(small), kind="stable")]
    first = bounds[1:] - size
    sa[np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(len(order))] = order

    def push(wave: np.ndarray, smaller: bool, at: np.ndarray) -> None:
        j = wave[wave > 0] - 1
        j = j[is_s[j] == smaller]
        if not len(j):
            return
        ch = s[j]
        by = np.argsort(ch.astype(small), kind="stable")
        j, ch = j[by], ch[by]
        new = np.flatnonzero(np.concatenate(([True], ch[1:] != ch[:-1])))
        count = np.diff(np.append(new, len(ch)))
        rank = np.arange(len(ch)) - np.repeat(new, count)
        if smaller:
            sa[at[ch] - 1 - rank] = j
            at[ch[new]] -= count
        else:
            sa[at[ch] + rank] = j
            at[ch[new]] += count

    at = bounds[:-1].copy()
    for c in range(sigma):
        done = bounds[c]
        while done < at[c]:
            wave, done = sa[done : at[c]], at[c]
            push(wave, False, at)
        if size[c]:
            push(sa[first[c] : bounds[c + 1]], False, at)
    larger = at.copy()
    at = bounds[1:].copy()
    for c in range(sigma - 1, -1, -1):
        done = bounds[c + 1]
        while done > at[c]:
            wave, done = sa[at[c] : done][::-1], at[c]
            push(wave, True, at)
        if larger[c] > bounds[c]:
            push(sa[bounds[c] : larger[c]][::-1], True, at)
    sa[0] = n - 1  # the end sign, which no suffix induces
    return sa


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of an integer string that ends with its only 0, over a small alphabet.

    Suffixes are classed as smaller or larger than their successors; substrings between leftmost
    smaller positions are sorted by induction and named; the string of names is sorted in turn
    (by rank doubling, since its alphabet is large); the order of all suffixes is then induced.
    """
    n = len(s)
    if n == 1:
        return np.zeros(1, dtype=np.int32)
    change = np.flatnonzero(s[1:] != s[:-1])
    nxt = change[np.minimum(np.searchsorted(change, np.arange(n)), len(change) - 1)] + 1
    is_s = s < s[nxt]
    is_s[-1] = True
    star = is_s.copy()
    star[1:] &= ~is_s[:-1]
    star[0] = False
    bounds = np.concatenate(([0], np.cumsum(np.bincount(s))))
    stars = np.flatnonzero(star)
    sa = _induce(s, is_s, stars, bounds)
    ordered = sa[star[sa]]
    stop = np.full(n, n, dtype=np.int64)
    stop[stars[:-1]] = stars[1:] + 1
    spans = Grams(s.astype(np.uint64) + np.uint64(1), np.array([0, n])).span(ordered, stop[ordered])
    length = stop[ordered] - ordered
    new = np.concatenate(([0], np.cumsum((spans[1:] != spans[:-1]) | (length[1:] != length[:-1]))))
    if new[-1] == len(stars) - 1:
        return _induce(s, is_s, ordered, bounds)
    names = np.empty(n, dtype=np.int64)
    names[ordered] = new
    return _induce(s, is_s, stars[_doubled(names[stars])], bounds)


def common_prefixes(s: np.ndarray, sa: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with the one before it in the array, in text order,
    cut at stop[i].  A value differs from its left neighbour's less one only where the characters
    before the two suffixes differ; only these are compared, the rest follow."""
    n = len(s)
    before = np.empty(n, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    i = np.arange(n)
    prev = before
    same = (i > 0) & (prev > 0)
    same[same] = s[i[same] - 1] == s[prev[same] - 1]
    same &= np.concatenate(([False], stop[:-1] == stop[1:]))
    own = np.flatnonzero(~same & (prev >= 0))
    value = np.zeros(n, dtype=np.int64)
    length, active = 0, own
    while len(active):
        a, b = active + length, prev[active] + length
        ok = (a < stop[active]) & (b < stop[prev[active]])
        active, a, b = active[ok], a[ok], b[ok]
        active = active[s[a] == s[b]]
        length += 1
        value[active] = length
    root = np.maximum.accumulate(np.where(same, 0, i))
    return np.where(same, np.maximum(value[root] - (i - root), 0), value)
