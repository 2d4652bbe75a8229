"""A compressed FM-index over words, searched backwards for many patterns at once.

Suffixes are sorted by their first ``depth`` words, which is all that patterns of at most that many words need. The
Burrows-Wheeler transform lies in a wavelet matrix: a level for each four bits of a word's number, one bit vector for
each bit, with counts of the level's 16 digits for every 64 places.
"""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)
# Of each digit and bit, what turns the bits that agree into ones.
FLIPS = np.array([[0 if d >> k & 1 else (1 << 64) - 1 for k in range(4)] for d in range(16)], np.uint64)


class Digits:
    """A sequence of numbers below 16 with rank: a bit vector for each of their four bits."""

    def __init__(self, digits: np.ndarray):
        padded = np.zeros((len(digits) // 64 + 1) * 64, np.uint8)
        padded[: len(digits)] = digits
        self.words = np.stack([np.packbits((padded >> k) & 1, bitorder="little").view(np.uint64) for k in range(4)], axis=1)
        counts = np.stack([np.bitwise_count(self._where(self.words, d)) for d in range(16)], axis=1).astype(np.int64)
        self.before = (np.cumsum(counts, axis=0) - counts).astype(np.int32 if len(digits) < 1 << 31 else np.int64).ravel()

    @staticmethod
    def _where(words: np.ndarray, digit: int | np.ndarray) -> np.ndarray:
        """A bit for each place, set where the digit stands."""
        like = words ^ FLIPS.take(digit, axis=0)
        return like[:, 0] & like[:, 1] & like[:, 2] & like[:, 3]

    def rank(self, digit: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Places before i with the digit."""
        word = i >> 6
        low = (ONE << (i & 63).astype(np.uint64)) - ONE
        return self.before.take((word << 4) + digit) + np.bitwise_count(self._where(self.words.take(word, axis=0), digit) & low)


class Wavelets:
    """Occurrences of a symbol before a place, for a sequence of small integers."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = []
        for shift in range((max(1, int(symbols - 1).bit_length()) - 1) // 4 * 4, -1, -4):
            digit = ((values >> shift) & 15).astype(np.uint8)
            sizes = np.bincount(digit, minlength=16)
            self.levels.append((shift, Digits(digit), np.cumsum(sizes) - sizes))
            values = values[np.argsort(digit, kind="stable")]
        all_symbols = np.arange(symbols)
        self.start = self._down(all_symbols, np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, digits, smaller in self.levels:
            digit = (symbol >> shift) & 15
            at = smaller[digit] + digits.rank(digit, at)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self.start[symbol]


class FMIndex:
    """The words of several texts, one after the other, each with an owner."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, owners: np.ndarray, depth: int):
        """words: hashes of all words; owners: a number for each text, of which the least matters."""
        self.depth = depth
        self.names, number = np.unique(words, return_inverse=True)
        ends = np.cumsum(sizes + 1)
        text = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)  # 0 stands behind every text
        inside = np.ones(len(text), bool)
        inside[ends - 1] = False
        text[inside] = number + 1
        # Ranks by the first 1, 2, 4, ... words; two of them tell suffixes apart by depth words, and by depth - 1.
        rank, reach = text, 1
        while reach * 2 < depth:
            rank, reach = self._joined(rank, rank, reach), reach * 2
        suffixes = np.argsort(self._paired(rank, rank, depth - reach), kind="stable")
        own, nth = rank[suffixes], np.arange(len(text))
        begins = lambda shift: np.diff(own, prepend=-1).astype(bool) | np.diff(self._behind(rank, shift)[suffixes], prepend=-1).astype(bool)
        first = np.flatnonzero(begins(depth - reach))
        self.block = np.repeat(nth[: len(first)], np.diff(np.append(first, len(text))))  # of suffixes that share depth words
        owner = np.repeat(owners, sizes + 1)[suffixes]
        self.least = np.minimum.reduceat(owner, first) if len(first) else owner
        # The interval of all suffixes that share depth - 1 words.
        edges = np.append(np.flatnonzero(begins(depth - 1 - reach)), len(text))
        which = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        self.low, self.high = edges[which], edges[which + 1] if len(which) else which
        del rank, own, begins  # before the wavelets need room
        transform = text[suffixes - 1] if len(text) else text  # before the first text stands the last end
        self.symbols = len(self.names) + 1
        counts = np.bincount(text, minlength=self.symbols)
        self.before = np.cumsum(counts) - counts
        self.size = len(text)
        self.waves = Wavelets(transform, self.symbols)

    @staticmethod
    def _behind(rank: np.ndarray, shift: int) -> np.ndarray:
        """The rank of the suffix ``shift`` words on, 0 if there is none."""
        other = np.zeros(len(rank), np.int64)
        other[: len(rank) - shift] = rank[shift:]
        return other

    def _paired(self, left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        """A suffix's own rank, then that of the suffix ``shift`` words on, as one number."""
        return left * (len(left) + 1) + self._behind(right, shift)

    def _joined(self, left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        """Dense ranks of pairs."""
        return np.unique(self._paired(left, right, shift), return_inverse=True)[1]

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more word in front."""
        n = len(symbol)
        ranks = self.waves.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.before[symbol] + ranks[:n], self.before[symbol] + ranks[n:]

    def earliest(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window of depth words of every run that matches, its first word's place and the match's least owner.

        Runs are [start, start + size) in words, of depth words at least. Each is read from its end to its front. A
        match of depth words loses its last word by going to the interval of its first depth - 1 words and grows by
        the next word in front, one step of the backward search for each window. Where that leaves no match, the next
        window is searched anew from its end.
        """
        number = np.searchsorted(self.names, words)
        number = np.minimum(number, max(0, len(self.names) - 1))
        number = np.where(self.names[number] == words, number + 1, 0) if len(self.names) else number
        total = sizes - self.depth + 1
        at = starts + sizes - 1  # the next word to read
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.size)
        length = np.zeros(len(starts), np.int64)
        places, owners = [], []
        live = np.flatnonzero(total > 0)
        while len(live):
            where = at[live]
            a, b = low[live], high[live]
            full = length[live] == self.depth
            a, b = np.where(full, self.low[np.minimum(a, self.size - 1)], a), np.where(full, self.high[np.minimum(a, self.size - 1)], b)
            symbol = number[where]
            a, b = self.step(symbol, a, b)
            gone = (a >= b) | (symbol == 0)
            now = np.where(full, self.depth, length[live] + 1)
            hit = ~gone & (now == self.depth)
            places.append(where[hit])
            owners.append(self.least[self.block[a[hit]]])
            low[live], high[live], length[live], at[live] = a, b, now, where - 1
            lost = live[gone]
            if len(lost):
                # Windows that hold the unmatched stretch have no match; the next one ends before its last word.
                stop = where[gone] + now[gone] - 1
                low[lost], high[lost], length[lost], at[lost] = 0, self.size, 0, stop - 1
            room = at[live] - starts[live] + 1 + np.where(length[live] == self.depth, self.depth - 1, length[live])
            live = live[(room >= self.depth) & (at[live] >= starts[live])]
        return (np.concatenate(places), np.concatenate(owners)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))
