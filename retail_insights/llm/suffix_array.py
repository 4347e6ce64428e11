"""Suffix arrays of small shards by induced sorting, in numpy.

Induction scans the array bucket by bucket instead of entry by entry: all
entries that stand in a bucket when the scan reaches it are handled at once,
and entries that they add to the same bucket form the next step.  The order of
the leftmost-smaller (LMS) suffixes comes from the names of their substrings;
where names repeat, the string of names is sorted in turn by rank pairs.
"""

from __future__ import annotations

import numpy as np


def joined(strings: list[bytes]):
    """Symbols of the strings, each ended by a separator of its own.

    Separators are smaller than all bytes and the last is the smallest, so no
    common prefix reaches over a string's end."""
    m = len(strings)
    raw = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8).astype(np.int32) + m
    lengths = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    raw[ends] = np.arange(m - 1, -1, -1)
    return raw, ends - lengths, lengths


def _types(t):
    """True where the suffix is smaller than the next one."""
    n = len(t)
    step = np.append(t[:-1] < t[1:], True)
    differs = np.append(t[:-1] != t[1:], True)
    at = np.where(differs, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    return step[following]


def _buckets(t, m):
    """Bucket of each symbol: all separators share the first, then one per byte."""
    return np.maximum(t - (m - 1), 0).astype(np.int16)


def _induce(bucket, small, order, size):
    """Suffix order induced from LMS suffixes in ``order`` (separators first, sorted)."""
    n = len(bucket)
    starts = np.concatenate(([0], np.cumsum(size)))
    sa = np.full(n, -1, np.int64)
    is_lms_rank = bucket[order]
    count = np.bincount(is_lms_rank, minlength=len(size))
    # LMS suffixes stand at the ends of their buckets, in their order.
    by = np.argsort(is_lms_rank, kind="stable")
    first = starts[1:] - count
    place = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(len(order))
    sa[place] = order[by]

    head = starts[:-1].copy()

    def put(found, step):
        """Append found suffixes to their buckets, at heads (1) or before tails (-1)."""
        b = bucket[found]
        by = np.argsort(b, kind="stable")
        found, b = found[by], b[by]
        edge = np.flatnonzero(np.diff(b)) + 1
        begin = np.concatenate(([0], edge))
        c = np.diff(np.concatenate((begin, [len(b)])))
        which = b[begin]
        offset = np.arange(len(b)) - np.repeat(begin, c)
        sa[np.repeat(head[which], c) + step * offset] = found
        head[which] += step * c

    for c in range(len(size)):
        at = starts[c]
        lms_from = first[c]
        while at < head[c]:
            part, at = sa[at:head[c]] - 1, head[c]
            part = part[part >= 0]
            part = part[~small[part] & (bucket[part] > 0)]
            if len(part):
                put(part, 1)
        part = sa[lms_from:starts[c + 1]] - 1
        part = part[part >= 0]
        part = part[~small[part] & (bucket[part] > 0)]
        if len(part):
            put(part, 1)
    # Smaller suffixes are placed anew, from the ends backwards; larger ones stay.
    # Separators keep their place: they are in order already.
    larger_end = head.copy()
    head = starts[1:] - 1
    head[0] = -1
    keep0 = sa[:size[0]].copy()
    for c in range(len(size) - 1, 0, -1):
        at = starts[c + 1] - 1
        while at > head[c]:
            part, at = sa[head[c] + 1:at + 1][::-1] - 1, head[c]
            part = part[part >= 0]
            part = part[small[part] & (bucket[part] > 0)]
            if len(part):
                put(part, -1)
        part = sa[starts[c]:larger_end[c]][::-1] - 1
        part = part[part >= 0]
        part = part[small[part] & (bucket[part] > 0)]
        if len(part):
            put(part, -1)
    sa[:size[0]] = keep0
    return sa


def _rank_by_pairs(names):
    """Suffix order of the string of names: ranks of pairs until all differ."""
    rank, width, n = names, 1, len(names)
    while True:
        following = np.zeros(n, np.int64)
        following[:n - width] = rank[width:] + 1
        _, rank = np.unique(rank * (n + 2) + following, return_inverse=True)
        width *= 2
        if rank.max() == n - 1 or width >= n:
            return np.argsort(rank, kind="stable")


def suffix_array(t, m):
    """Suffix array of symbols ``t`` with ``m`` separators (see ``joined``)."""
    small = _types(t)
    lms = np.flatnonzero(small & ~np.concatenate(([True], small[:-1])))
    bucket = _buckets(t, m)
    size = np.bincount(bucket, minlength=int(bucket.max()) + 1)
    size[0] = m
    separators = np.flatnonzero(t < m)
    separators = separators[np.argsort(t[separators])]
    # An empty string's separator may not be LMS; all separators lead in any case.
    inner = lms[t[lms] >= m]
    sa = _induce(bucket, small, np.concatenate((separators, inner)), size)
    # Names of the LMS substrings in their induced order; equal ones share a name.
    stops = np.union1d(inner, separators)
    mark = np.zeros(len(t), bool)
    mark[stops] = True
    order = sa[mark[sa]]
    length = np.zeros(len(t), np.int64)
    length[stops[:-1]] = np.diff(stops)
    same = np.zeros(len(order), bool)
    a, b = order[:-1], order[1:]
    active = np.flatnonzero((length[a] == length[b]) & (t[a] >= m) & (t[b] >= m))
    k = 0
    while len(active):
        equal = t[a[active] + k] == t[b[active] + k]
        active = active[equal]
        done = length[a[active]] <= k
        same[active[done] + 1] = True
        active = active[~done]
        k += 1
    names = np.zeros(len(t), np.int64)
    names[order] = np.cumsum(~same) - 1
    names = names[stops]
    if names.max() < len(stops) - 1:
        stops = stops[_rank_by_pairs(names)]
    else:
        stops = stops[np.argsort(names)]
    return _induce(bucket, small, np.concatenate((separators, stops[t[stops] >= m])), size)


def permuted_lcp(t, sa):
    """(plcp, phi): common prefix of each suffix with the one before it in the
    order.  Only where the symbols before the two differ is it counted; at all
    other places it is one less than at the place before."""
    n = len(t)
    phi = np.empty(n, np.int64)
    phi[sa[1:]] = sa[:-1]
    phi[sa[0]] = -1
    i = np.arange(n)
    j = phi
    counted = (i == 0) | (j <= 0)
    inner = ~counted
    counted[inner] = t[i[inner] - 1] != t[j[inner] - 1]
    plcp = np.zeros(n, np.int64)
    active = np.flatnonzero(counted & (j >= 0))
    k = 0
    # Suffixes end in separators that differ, so a pair parts before the end.
    while len(active):
        equal = t[active + k] == t[j[active] + k]
        plcp[active[~equal]] = k
        active = active[equal]
        k += 1
    base = np.maximum.accumulate(np.where(counted, i, 0))
    return plcp[base] - (i - base), phi


def repeated_starts(strings: list[tuple[bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """For each ``(string, copies)`` the ranges of offsets at which a string of
    ``length`` bytes starts that also starts at another place of the shard.
    Every start of a string with copies is one; it is sorted once, for the
    others to be found by."""
    t, starts, lengths = joined([s for s, _ in strings])
    sa = suffix_array(t, len(strings))
    plcp, phi = permuted_lcp(t, sa)
    again = np.zeros(len(t), bool)
    hit = np.flatnonzero(plcp >= length)
    again[hit] = True
    again[phi[hit]] = True
    out: list[list[tuple[int, int]]] = []
    for (_, copies), s, n in zip(strings, starts.tolist(), lengths.tolist()):
        if copies > 1:
            out.append([(0, n - length + 1)] if n >= length else [])
            continue
        edge = np.diff(np.concatenate(([0], again[s:s + n].view(np.int8), [0])))
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
    return out
