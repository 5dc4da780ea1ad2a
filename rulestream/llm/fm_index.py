"""An FM-index over sequences of symbols: a wavelet tree of the Burrows-Wheeler transform, in packed bits."""

from __future__ import annotations

import numpy as np

#: The bits of a word below each of its places.
BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Places of all suffixes in their order, by doubling the length that is compared. No two suffixes may be alike."""
    size = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(size, dtype=np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (size + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if rank[order[-1]] == size - 1:
            return order
        step *= 2


class WaveletTree:
    """How often a symbol occurs before a place. One row of bits per binary digit of the symbols.

    A row holds one digit of each symbol, the symbols being stably sorted by the digits above it with the lowest digit first. The bits
    are packed into words of 64, with the number of ones before each word.
    """

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.ones, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bits = (symbols >> level) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.words.append(words)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(int(len(symbols) - self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

        kinds = np.arange(size)
        self.begin = self._down(kinds, np.zeros(size, dtype=np.int64))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(symbol, place) - self.begin[symbol]

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for row, level in enumerate(reversed(range(self.levels))):
            word = place >> 6
            ones = self.ones[row][word] + np.bitwise_count(self.words[row][word] & BELOW[place & 63])
            place = np.where((symbol >> level) & 1, self.zeros[row] + ones, place - ones)
        return place


class FMIndex:
    """An index of sequences of symbols from 0, each with a weight.

    ``symbols`` holds the sequences one after the other, ``lengths`` their lengths. Every sequence is followed by an end that occurs in no
    pattern; the ends differ, so that no match goes from one sequence to the next.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> None:
        many = len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        self.size = len(symbols) + many
        text = np.zeros(self.size, dtype=np.int64)
        inside = np.ones(self.size, dtype=bool)
        inside[ends] = False
        text[inside] = symbols + many
        text[ends] = np.arange(many)
        order = suffix_order(text)
        self.text = np.where(inside, text - many + 1, 0)  # the ends as one symbol
        kinds = int(symbols.max(initial=-1)) + 2
        self.tree = WaveletTree(self.text[order - 1], kinds)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=kinds))])
        self.starts = ends - lengths
        self.lengths = lengths
        owner = np.repeat(np.arange(many), lengths + 1)
        self.weight_before = np.concatenate([[0], np.cumsum(weights[owner[order]])])

    def extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with the symbol and go on with those between low and high."""
        both = np.concatenate([symbol, symbol])
        found = self.first[both] + self.tree.rank(both, np.concatenate([low, high]))
        return found[: len(symbol)], found[len(symbol) :]

    def weight(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Weight of the sequences in which these suffixes lie."""
        return self.weight_before[high] - self.weight_before[low]

    def repeated(self, least: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All maximal stretches of the sequences, ``window`` symbols or longer, that occur with a weight of ``least``: sequence, start, stop.

        These are the matching statistics of the sequences against the index, from right to left, for all of them side by side. From
        an end the match is extended to the left until it is too rare. It has then been told where the next end lies: every window that
        holds the symbol at which it stopped and the old end is as rare. Ends too close to the start are left out.
        """
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        own = np.flatnonzero(self.lengths >= window)
        end = self.lengths[own] - 1
        at = end.copy()
        low, high = np.zeros(len(own), dtype=np.int64), np.full(len(own), self.size, dtype=np.int64)
        while len(own):
            lower, upper = self.extended(self.text[self.starts[own] + at], low, high)
            goes_on = self.weight(lower, upper) >= least
            over = ~goes_on | (at == 0)
            if over.any():
                begin = np.where(goes_on[over], at[over], at[over] + 1)
                long = end[over] - begin + 1 >= window
                found.append((own[over][long], begin[long], end[over][long] + 1))
            # a match that has reached the start ends the sequence; another one gives the next end
            after = np.where(over, np.where(goes_on, -1, np.minimum(end - 1, at + window - 1)), end)
            at = np.where(over, after, at - 1)
            low, high = np.where(over, 0, lower), np.where(over, self.size, upper)
            stay = ~over | (after >= window - 1)
            own, end, at, low, high = own[stay], after[stay], at[stay], low[stay], high[stay]
        if not found:
            return (np.zeros(0, dtype=np.int64),) * 3
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))
