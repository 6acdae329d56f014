"""A compressed FM-index over integer sequences: succinct bit vectors in a wavelet matrix, many searches at once."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while width < depth:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))
        width *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


class Bits:
    """A bit vector with ranks: 64-bit words and the ones before each."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(packed) // 8 + 2, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << rest) - np.uint64(1)))


class FmIndex:
    """Counts of patterns of at most ``depth`` symbols in several sequences; a pattern doesn't reach over their ends.

    ``times``: a sequence stands for so many equal ones, and so do its suffixes: a range of them counts as the sum of theirs.
    """

    def __init__(self, sequences: list[np.ndarray], depth: int, times: np.ndarray | None = None) -> None:
        lengths = np.array([len(s) for s in sequences])
        self.symbols, ids = np.unique(np.concatenate(sequences), return_inverse=True)
        text = np.ones(len(ids) + len(sequences) + 1, np.int64)  # 0 ends the text, 1 ends a sequence
        at = np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)
        text[at] = ids + 2
        text[-1] = 0
        order = suffix_order(text, depth)
        last = text[order - 1]
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)  # a sequence's end is its own
        each = np.ones(len(lengths), np.int64) if times is None else np.asarray(times, np.int64)
        self.upto = np.concatenate([[0], np.cumsum(np.concatenate([each[owner], [0]])[order])])
        sigma = len(self.symbols) + 2
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.size = len(text)
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (last >> bit) & 1
            self.levels.append((bit, Bits(ones.astype(bool)), int(len(ones) - ones.sum())))
            last = np.concatenate([last[ones == 0], last[ones == 1]])
        self.begin = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> bit) & 1, zeros + ones, at - ones)
        return at

    def count(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Occurrences in ranges of suffixes."""
        return self.upto[np.maximum(high, low)] - self.upto[low]

    def encode(self, words: np.ndarray) -> np.ndarray:
        """The words' symbols; all must be in the index."""
        return np.searchsorted(self.symbols, words) + 2

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step of many searches: the ranges of suffixes that begin with the symbol and then the pattern."""
        moved = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.first[symbol] - self.begin[symbol]
        return base + moved[: len(symbol)], base + moved[len(symbol) :]


def matching_intervals(index: FmIndex, streamed: list[np.ndarray], size: int, least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, begin, end) of the maximal runs of at least ``size`` symbols of each streamed sequence that the index holds ``least`` times.

    These are the matching statistics that reach ``size``. All sequences are
    searched in step. A run is matched backward from its end until the part from
    j on is too rare; the match without j is as long as it can be for its end.
    Then the shortest rare part that begins at j is looked for by searches of
    growing and halved lengths: the next run ends just before that part's last
    symbol. A sequence is left when too few symbols remain.
    """
    lengths = np.array([len(s) for s in streamed], np.int64)
    text = index.encode(np.concatenate([*streamed, np.zeros(0, np.int64)]))
    base = np.cumsum(lengths) - lengths
    end, at, floor = lengths.copy(), lengths.copy(), np.zeros(len(lengths), np.int64)
    held, rare_length, probed = (np.zeros(len(lengths), np.int64) for _ in range(3))  # of parts that begin at ``floor``
    probing = np.zeros(len(lengths), bool)
    low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), index.size)
    lane, found = np.flatnonzero(lengths >= size), []
    while len(lane):
        at[lane] -= 1
        low[lane], high[lane] = index.extend(text[base[lane] + at[lane]], low[lane], high[lane])
        rare = index.count(low[lane], high[lane]) < least
        halted = rare | (at[lane] == floor[lane])
        probe = probing[lane]

        of, cut = lane[halted & ~probe], rare[halted & ~probe]
        begin = at[of] + cut
        long = end[of] - begin >= size
        found.append((of[long], begin[long], end[of[long]]))
        over = of[~cut]  # matched to the sequence's beginning
        of = of[cut]
        floor[of], held[of], rare_length[of] = at[of], 0, end[of] - at[of]

        shown, cut = lane[halted & probe], rare[halted & probe]
        rare_length[shown[cut]] = probed[shown[cut]]
        held[shown[~cut]] = probed[shown[~cut]]

        of = np.concatenate([of, shown])
        few = floor[of] + rare_length[of] - 1 < size
        over, of = np.concatenate([over, of[few]]), of[~few]
        low[of], high[of] = 0, index.size
        sure = rare_length[of] - held[of] == 1
        again, more = of[sure], of[~sure]
        end[again] = at[again] = floor[again] + held[again]
        floor[again], probing[again] = 0, False
        over = np.concatenate([over, again[end[again] < size]])
        probed[more] = held[more] + np.maximum(1, np.minimum(held[more], (rare_length[more] - held[more]) // 2))
        at[more], probing[more] = floor[more] + probed[more], True
        if len(over):
            lane = np.setdiff1d(lane, over, assume_unique=True)
    which, begin, end = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((begin, which))
    return which[order], begin[order], end[order]
