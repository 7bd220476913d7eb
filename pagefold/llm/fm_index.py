"""A compressed full-text index of one shard: Burrows-Wheeler transform in a wavelet matrix of packed bits."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank queries over a sequence of small integers, one packed bit vector per binary digit."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.sums, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = ((values >> level) & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, dtype=np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.bitwise_count(words)
            self.bits.append(words)
            self.sums.append(np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int64)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        every = np.arange(1 << self.levels)
        self.start = self._down(every, np.zeros(len(every), dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for n in range(self.levels):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.sums[n][word] + np.bitwise_count(self.bits[n][word] & below)
            one = (symbol >> (self.levels - 1 - n)) & 1 == 1
            at = np.where(one, self.zeros[n] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbol, at) - self.start[symbol]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` (a power of two) symbols, by doubling."""
    n = len(text)
    rank, span = text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while span < depth:
        later = np.zeros(n, dtype=np.int64)
        later[: n - span] = rank[span:] + 1
        key = rank * (int(rank.max()) + 2 if n else 1) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = fresh
        span *= 2
        if n and rank[order[-1]] == n - 1:
            break
    return order


class FMIndex:
    """Segments of symbols from 1 up, each with a weight; patterns up to ``depth`` symbols are counted by weight."""

    def __init__(self, segments: list[np.ndarray], weights: np.ndarray, depth: int = 64) -> None:
        lengths = np.array([len(s) for s in segments])
        ends = np.cumsum(lengths + 1)
        self.begin = ends - lengths - 1
        self.length = lengths
        self.text = np.zeros(int(ends[-1]), dtype=np.int64)
        self.text[np.repeat(self.begin, lengths) + _within(lengths)] = np.concatenate(segments)
        order = suffix_order(self.text, depth)
        symbols = int(self.text.max()) + 1
        self.wavelet = WaveletMatrix(self.text[order - 1], symbols)
        counts = np.bincount(self.text, minlength=1 << self.wavelet.levels)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        own = np.repeat(weights, lengths + 1)
        self.weight = np.concatenate([[0], np.cumsum(own[order])])
        self.size = len(self.text)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the patterns with a symbol put before them."""
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.first[symbol] + both[: len(low)], self.first[symbol] + both[len(low) :]

    def repeated_windows(self, window: int) -> list[np.ndarray]:
        """Per segment, which windows of ``window`` symbols weigh two or more in the index.

        Matching statistics by backward search, for all segments in step: a pattern that ends at a
        place grows to the left as long as it weighs two. Where it has ``window`` symbols or more,
        the window that begins there is repeated. Where it can grow no more, no window that holds
        the longer pattern is, and the search goes on with the rightmost end that is left.
        """
        found = [np.zeros(max(0, n - window + 1), dtype=bool) for n in self.length]
        flat = np.zeros(self.size + 1, dtype=bool)
        live = np.flatnonzero(self.length >= window)
        base = self.begin[live]
        end = base + self.length[live]
        at = end.copy()
        low, high = np.zeros(len(live), dtype=np.int64), np.full(len(live), self.size, dtype=np.int64)
        while len(live):
            symbol = self.text[at - 1]
            down, up = self.extend(symbol, low, high)
            grows = self.weight[up] - self.weight[down] >= 2
            failed = ~grows
            at = np.where(grows, at - 1, at)
            low, high = np.where(grows, down, 0), np.where(grows, up, self.size)
            flat[at[grows & (end - at >= window)]] = True
            # A pattern that cannot grow ends every window over it; the next ends before, or where it may.
            end = np.where(failed, np.minimum(end - 1, at - 1 + window), end)
            at = np.where(failed, end, at)
            going = (end - base >= window) & (at > base)
            if not going.all():
                base, end, at, low, high, live = (x[going] for x in (base, end, at, low, high, live))
        for i, b in enumerate(self.begin):
            found[i] |= flat[b : b + len(found[i])]
        return found


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. within each run of the given lengths."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
