"""A compressed FM-index over word sequences, for many searches side by side.

The Burrows-Wheeler transform of all sequences is held in a Huffman-shaped
wavelet tree (bits packed in 64-bit words with counts per word), so it takes
about as many bits as its zero-order entropy.  Backward search narrows an
interval of suffixes word by word, from the right; all patterns of a batch take
their steps together.  Where a word does not fit, the interval's parent (the
suffixes that share a shorter prefix) is taken from the common prefixes of
neighbouring suffixes, which gives the matching statistics of every pattern.
"""

from __future__ import annotations

import heapq

import numpy as np

from retail_insights.llm.suffix_array import permuted_lcp


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Lengths of Huffman codes of the symbols that occur; 0 for the others."""
    some = np.flatnonzero(counts)
    depth = np.zeros(len(counts), np.int64)
    if len(some) < 2:
        depth[some] = 1
        return depth
    heap = [(int(counts[s]), k) for k, s in enumerate(some)]
    heapq.heapify(heap)
    parent = np.zeros(2 * len(some) - 1, np.int64)
    for node in range(len(some), 2 * len(some) - 1):
        (x, a), (y, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a] = parent[b] = node
        heapq.heappush(heap, (x + y, node))
    height = np.zeros(len(parent), np.int64)
    for node in range(len(parent) - 2, -1, -1):
        height[node] = height[parent[node]] + 1
    depth[some] = height[:len(some)]
    return depth


def canonical_codes(depth: np.ndarray) -> np.ndarray:
    """Codes in the order of length and symbol, as numbers of ``depth`` bits."""
    code, at, last = np.zeros(len(depth), np.int64), 0, 0
    for s in np.lexsort((np.arange(len(depth)), depth)).tolist():
        d = int(depth[s])
        if d:
            at <<= d - last
            code[s], at, last = at, at + 1, d
    return code


class PackedBits:
    """Bits with counts: ``ones(i)`` of the first ``i`` bits."""

    def __init__(self, bits: np.ndarray):
        n = len(bits) // 64 + 1
        padded = np.zeros(n * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1])).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletTree:
    """``rank(c, i)``: how often each symbol of ``c``, which must occur at all,
    does so among the first ``i``."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = code_lengths(np.bincount(symbols, minlength=sigma))
        self.code = canonical_codes(self.depth)
        self.levels = []
        row, level = symbols, 0
        while len(row):
            prefix = self.code[row] >> (self.depth[row] - level)
            edges = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
            bit = (self.code[row] >> (self.depth[row] - level - 1)) & 1
            bits = PackedBits(bit)
            # Where each symbol's node begins, and the ones before it.
            own = np.searchsorted(prefix[edges], self.code >> np.maximum(self.depth - level, 0))
            start = edges[np.minimum(own, len(edges) - 1)]
            self.levels.append((bits, start, bits.ones(start)))
            # Within each node zeros go before ones, both in their order.
            sizes = np.diff(np.append(edges, len(row)))
            ones = np.concatenate(([0], np.cumsum(bit)))
            begin = np.repeat(edges, sizes)
            zeros = np.repeat(sizes - (ones[edges + sizes] - ones[edges]), sizes)
            earlier = ones[:-1] - ones[begin]
            place = begin + np.where(bit == 1, zeros + earlier, np.arange(len(row)) - begin - earlier)
            moved = np.empty_like(row)
            moved[place] = row
            level += 1
            row = moved[self.depth[moved] > level]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        out = i.copy()
        todo = np.flatnonzero(self.depth[c])
        left = self.depth[c[todo]]
        for bits, start, ones in self.levels:
            if not len(todo):
                break
            s, at = c[todo], out[todo]
            one = bits.ones(start[s] + at) - ones[s]
            left = left - 1
            out[todo] = np.where((self.code[s] >> left) & 1 == 1, one, at - one)
            more = left > 0
            todo, left = todo[more], left[more]
        return out


def suffix_order(t: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; only suffixes that still tie are sorted again.
    The last symbol is unique, and so no tie reaches the end."""
    n = len(t)
    sa = np.argsort(t, kind="stable")
    new = np.append(True, t[sa[1:]] != t[sa[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied, width = np.flatnonzero(~(new & np.append(new[1:], True))), 1
    while len(tied):
        p = sa[tied]
        key = rank[p] * (n + 1) + rank[p + width]
        order = np.argsort(key, kind="stable")
        key, p = key[order], p[order]
        sa[tied] = p
        new = np.append(True, key[1:] != key[:-1])
        rank[p] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        tied = tied[~(new & np.append(new[1:], True))]
        width *= 2
    return sa


class FMIndex:
    """Sequences of word numbers ``0..sigma-1``, searched by suffix intervals.

    ``cap`` bounds the matches that are told apart: suffixes with ``cap`` equal
    words form a class, numbered in suffix order."""

    def __init__(self, texts: list[np.ndarray], sigma: int, cap: int):
        m = len(texts)
        sizes = np.array([len(x) for x in texts], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        t = np.empty(int(ends[-1]) + 1, np.int64)
        inner = np.ones(len(t), bool)
        inner[ends] = False
        t[inner] = np.concatenate(texts) + m
        t[ends] = np.arange(m - 1, -1, -1)  # every sequence ends in a separator of its own; the last is the least
        sa = suffix_order(t)
        plcp, _ = permuted_lcp(t, sa)
        self.n, self.sigma, self.cap = len(t), sigma, cap
        self.lcp = np.append(plcp[sa], 0).astype(np.int32)
        self.lcp[0] = 0
        symbols = np.maximum(t[sa - 1] - m + 1, 0)  # separators share symbol 0, which no pattern holds
        self.tree = WaveletTree(symbols, sigma + 1)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=sigma + 1))[:-1]))
        self.class_starts = np.flatnonzero(self.lcp[:-1] < cap)
        self.class_of = (np.cumsum(self.lcp[:-1] < cap) - 1).astype(np.int32)
        owner = np.repeat(np.arange(m), sizes + 1)
        self.owner = owner[sa].astype(np.int32)
        self._least = None

    def least_of_class(self, values: np.ndarray) -> np.ndarray:
        """Per class, the least of the values of the sequences that it occurs in."""
        return np.minimum.reduceat(values[self.owner], self.class_starts)

    def _parent(self, lo, hi):
        """The next larger interval with a shorter common prefix, and its length."""
        if self._least is None:  # least common prefix of 1, 2, 4, ... neighbours
            self._least = [self.lcp]
            while 2 << (len(self._least) - 1) <= len(self.lcp):
                last, step = self._least[-1], 1 << (len(self._least) - 1)
                self._least.append(np.minimum(last[:-step], last[step:]))
        q = np.maximum(self.lcp[lo], self.lcp[hi])
        lo, hi = lo.copy(), hi.copy()
        for k in range(len(self._least) - 1, -1, -1):
            least, step = self._least[k], 1 << k
            down = np.flatnonzero((lo - step >= 0) & (q > 0))
            down = down[least[lo[down] - step + 1] >= q[down]]
            lo[down] -= step
            up = np.flatnonzero((hi + step <= self.n) & (q > 0))
            up = up[least[hi[up]] >= q[up]]
            hi[up] += step
        root = q == 0
        lo[root], hi[root] = 0, self.n
        return lo, hi, q

    def matching_statistics(self, patterns: list[np.ndarray]):
        """For the patterns side by side: at each word, how many words from
        there on (``cap`` at most) occur in the index, and one suffix that
        begins with them.  Numbers outside ``0..sigma-1`` occur nowhere."""
        sizes = np.array([len(p) for p in patterns], np.int64)
        words = np.concatenate([*patterns, np.zeros(0, np.int64)])
        begin = np.cumsum(sizes) - sizes
        length, suffix = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        live = np.flatnonzero(sizes)
        begin, at = begin[live], (begin + sizes - 1)[live]
        lo, hi, q = np.zeros(len(at), np.int64), np.full(len(at), self.n), np.zeros(len(at), np.int64)
        while len(at):
            word = words[at]
            known = (word >= 0) & (word < self.sigma)
            c = np.where(known, word + 1, 0)
            both = self.tree.rank(np.concatenate((c, c)), np.concatenate((lo, hi))) + np.tile(self.before[c], 2)
            new_lo, new_hi = np.split(both, 2)
            fits = known & (new_hi > new_lo) & (self.tree.depth[c] > 0)
            lo, hi, q = np.where(fits, new_lo, lo), np.where(fits, new_hi, hi), q + fits
            over = np.flatnonzero(q > self.cap)
            if len(over):  # back to the class of the first ``cap`` words
                k = self.class_of[lo[over]]
                lo[over] = self.class_starts[k]
                hi[over] = np.append(self.class_starts, self.n)[k + 1]
                q[over] = self.cap
            done = fits | (q == 0)
            length[at[done]], suffix[at[done]] = q[done], lo[done]
            stuck = np.flatnonzero(~done)
            if len(stuck):
                lo[stuck], hi[stuck], q[stuck] = self._parent(lo[stuck], hi[stuck])
            at = at - done
            more = at >= begin
            if not more.all():
                at, begin, lo, hi, q = (x[more] for x in (at, begin, lo, hi, q))
        return length, suffix
