"""A compressed FM-index over sequences of words, and its matching statistics for many sequences at once.

The sequences of a shard are laid end to end, each closed by a separator of its own, which sorts before all words. The
Burrows-Wheeler transform of that text is kept as a wavelet tree shaped by word frequency: a word that makes up a
share p of the text has a code of at most log2(1 / p) + 1 bits, so the bit vectors take about the text's entropy. A
backward step narrows an interval of suffixes by two ranks on each level of one word's code; numpy takes the step for
all open searches together.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class _Bits:
    """A packed bit vector with counts of ones before each machine word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.uint32)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:], dtype=np.uint32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class _WaveletTree:
    """Ranks of symbols in a sequence, by a binary tree of codes whose lengths follow the symbols' frequencies."""

    def __init__(self, sequence: np.ndarray, counts: np.ndarray):
        size = np.maximum(1, np.ceil(np.log2(len(sequence) / np.maximum(counts, 1)))).astype(np.int64)
        size[counts == 0] = 0
        self.depth = top = int(size.max(initial=1))
        order = np.lexsort((np.arange(len(size)), size))
        order = order[size[order] > 0]
        room = np.left_shift(1, top - size[order])
        code = np.zeros(len(size), np.int64)
        code[order] = np.cumsum(room) - room  # Kraft's sum is at most one, so the codes are free of prefixes
        self.size, self.code, self.levels = size, code, []
        now = (code << 6 | size)[sequence]  # a code with its length, in the order of the level
        for level in range(top):
            prefix = now >> (6 + top - level)
            bit = now >> (5 + top - level) & 1
            begin = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
            ones = np.concatenate(([0], np.cumsum(bit)))
            alive = np.flatnonzero(size > level)
            node = np.searchsorted(prefix[begin], code[alive] >> (top - level))
            start = np.zeros(len(size), np.int64)
            start[alive] = begin[node]
            self.levels.append((_Bits(bit), start, ones[start], code >> (top - 1 - level) & 1))
            # A stable partition of each node by its bits; words whose code ends here leave.
            width = np.diff(np.append(begin, len(now)))
            first = np.repeat(begin, width)
            one = ones[:-1] - ones[first]
            zeros = np.repeat(width - (ones[begin + width] - ones[begin]), width)
            at = np.where(bit == 1, first + zeros + one, np.arange(len(now)) - one)
            nxt = np.empty_like(now)
            nxt[at] = now
            now = nxt[(nxt & 63) > level + 1]
            if not len(now):
                break

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place of the sequence."""
        out, open_ = at.copy(), np.arange(len(at))
        size = self.size[symbol]
        for level, (bits, start, before, bit) in enumerate(self.levels):
            if level:
                keep = size > level
                if not keep.all():
                    open_, symbol, size = open_[keep], symbol[keep], size[keep]
            if not len(open_):
                break
            i = out[open_]
            ones = bits.rank(start[symbol] + i) - before[symbol]
            out[open_] = np.where(bit[symbol] == 1, ones, i - ones)
        return out


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """The suffixes of `tokens` in order; equal tokens 0 are separators, an earlier one smaller. The last must be one."""
    n, ends = len(tokens), int((tokens == 0).sum())
    rank = tokens.astype(np.uint64) + np.uint64(ends)
    rank[tokens == 0] = np.arange(1, ends + 1, dtype=np.uint64)
    rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
    bits, step = np.uint64((n + 1).bit_length()), 1
    while True:  # three ranks make a key, so each pass triples the length that is sorted
        key = rank << bits
        key[: n - step] |= rank[step:] + _ONE
        key <<= bits
        key[: max(n - 2 * step, 0)] |= rank[2 * step :] + _ONE
        order = np.argsort(key)
        new = np.zeros(n, np.uint64)
        np.cumsum(key[order][1:] != key[order][:-1], out=new[1:], dtype=np.uint64)
        rank[order] = new
        if int(new[-1]) == n - 1:
            return order
        step *= 3


class FMIndex:
    """An index of sequences that have weights: how often each of them occurs.

    `tokens` are numbers of words from 1 on, all sequences one after the other; `ends` tells where each one ends. At
    most 2 ** 20 tokens and sequences together.
    """

    def __init__(self, tokens: np.ndarray, ends: np.ndarray, weights: np.ndarray):
        lengths = np.diff(ends, prepend=0)
        self.text = np.insert(tokens.astype(np.int64), ends, 0)
        self.stop = ends + np.arange(len(ends))  # where the separators are
        self.start = self.stop - lengths
        order = suffix_array(self.text)
        counts = np.bincount(self.text)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.tree = _WaveletTree(self.text[order - 1], counts)
        owner = np.searchsorted(self.stop, order)
        self.weight = np.concatenate(([0], np.cumsum(weights[owner])))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of suffixes that begin with a symbol and then what the intervals' suffixes begin with."""
        at = self.tree.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        base = self.first[symbol]
        return base + at[: len(symbol)], base + at[len(symbol) :]

    def occurrences(self, pattern: list[int]) -> int:
        """Weighted number of places where a pattern occurs."""
        low, high = np.zeros(1, np.int64), np.full(1, len(self.text))
        for c in reversed(pattern):
            low, high = self.extend(np.array([c]), low, high)
        return int(self.weight[high[0]] - self.weight[low[0]])

    def repeated(self, window: int, least: int = 2) -> np.ndarray:
        """True for each place of the text inside a window, of one sequence, that occurs `least` times or more.

        Matching statistics by backward search: from an end it goes left while the interval weighs enough, and where
        it stops, that ends the longest repeated stretch. A stretch of a window or more is reported whole, and the
        search goes on with the windows that begin before it. A shorter one proves that the windows around it are
        rare; then the search starts anew from the first open window, whose failure rules out many.
        """
        text, n = self.text, len(self.text)
        edge = np.zeros(n + 1, np.int64)
        long = np.flatnonzero(self.stop - self.start >= window)
        first, last = self.start[long].copy(), self.stop[long] - window  # open windows, by where they begin
        from_left = np.zeros(len(long), bool)
        end = last + window
        at, low, high = end.copy(), np.zeros(len(long), np.int64), np.full(len(long), n)
        live = np.arange(len(long))
        while len(live):
            c = text[at[live] - 1]
            whole = at[live] == end[live]
            lo, hi = self.first[c].copy(), self.first[c + 1].copy()
            on = np.flatnonzero(~whole)
            if len(on):
                lo[on], hi[on] = self.extend(c[on], low[live[on]], high[live[on]])
            good = self.weight[hi] - self.weight[lo] >= least
            went = live[good]
            at[went] -= 1
            low[went], high[went] = lo[good], hi[good]
            halted = np.concatenate((live[~good], went[at[went] == first[went]]))
            if not len(halted):
                continue
            a, e, left = at[halted], end[halted], from_left[halted]
            done = a == first[halted]
            report = e - a >= window
            np.add.at(edge, a[report], 1)
            np.add.at(edge, e[report], -1)
            last[halted] = np.where(left, last[halted], np.where(done & report, first[halted] - 1, np.where(report, a - 1, last[halted] - 1)))
            first[halted] = np.where(left, np.where(done, first[halted] + 1, a), first[halted])
            from_left[halted] = left = np.where(left, ~done, ~report)
            end[halted] = np.where(left, first[halted], last[halted]) + window
            at[halted] = end[halted]
            live = np.flatnonzero(first <= last) if len(halted) * 4 > len(live) else live[first[live] <= last[live]]
        return np.cumsum(edge[:-1]) > 0
