"""FM-index of a set of word sequences in numpy: suffix order, Burrows-Wheeler transform, wavelet matrix, batched backward search."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Bit-packed levels of a sequence of symbols below 2 ** levels; answers how often a symbol stands before a place."""

    def __init__(self, values: np.ndarray, levels: int):
        self.n, self.levels = len(values), levels
        self.words, self.before, self.zeros = [], [], []
        values = values.astype(np.int64)
        for level in range(levels - 1, -1, -1):
            bits = ((values >> level) & 1).astype(np.uint8)
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            small = np.packbits(bits, bitorder="little")
            packed[: len(small)] = small
            words = packed.view(np.uint64)
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words)))).astype(np.int32)[:-1])
            self.zeros.append(int(self.n - bits.sum()))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the places `at` come to lie when each follows the bits of its symbol through all levels."""
        at = at.astype(np.int64)
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[i][word] + np.bitwise_count(self.words[i][word] & low).astype(np.int64)
            at = np.where((symbols >> level) & 1, self.zeros[i] + ones, at - ones)
        return at


class FMIndex:
    """Index of sequences of 64-bit words. Matches never run over the end of a sequence."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        distinct, code = np.unique(words, return_inverse=True)
        ends = np.cumsum(sizes)
        n, parts = len(words) + len(sizes), len(sizes)
        after = np.repeat(np.arange(parts), sizes)
        text = np.zeros(n, np.int64)
        text[np.arange(len(words)) + after] = code + 1
        border = ends + np.arange(parts)
        self.symbols = text
        self.start = border - sizes
        # borders differ from each other, so every suffix has its own rank
        rank = text + parts - 1
        rank[border] = np.arange(parts)
        step = 1
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[: n - step] = rank[step:] + 1
            key = rank * (n + parts + len(distinct) + 2) + ahead
            order = np.argsort(key, kind="stable")
            fresh = np.ones(n, np.int64)
            fresh[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            step *= 2
            if fresh.all() or step >= n:
                break
        bwt = text[order - 1]
        levels = max(1, int(len(distinct)).bit_length())
        self.tree = WaveletMatrix(bwt, levels)
        counts = np.bincount(text, minlength=len(distinct) + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        everything = np.arange(len(distinct) + 1)
        self.origin = self.tree.place(everything, np.zeros(len(distinct) + 1, np.int64))
        self.n = n

    def back(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes after putting one symbol before each pattern."""
        both = self.tree.place(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        base = self.first[symbols] - self.origin[symbols]
        return both[: len(symbols)] + base, both[len(symbols) :] + base


def repeated_stretches(index: FMIndex, asked: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches of `least` words or more of the asked sequences that the index holds twice or more.

    Matching statistics by backward search, all sequences side by side: from an end the match grows to the left as long as it
    stands in two places. Where it breaks, the words from there to the end are a stretch that stands once; ends beyond a short
    stretch of that kind need no search. Gives (sequence, begin, end).
    """
    symbols, base = index.symbols, index.start[asked]
    out: list[tuple] = []
    seq = np.arange(len(asked))
    end = sizes[asked].copy()
    # `stop`: do not grow beyond it; `wall`: begin of the known single stretch, whose end is `until`; -1 outside a trial
    at, low, high = end.copy(), np.zeros(len(asked), np.int64), np.full(len(asked), index.n)
    wall, until = np.full(len(asked), -1), np.zeros(len(asked), np.int64)
    alive = end >= least
    while True:
        keep = np.flatnonzero(alive)
        if not len(keep):
            break
        if len(keep) < len(alive):
            seq, end, at, low, high, wall, until = (x[keep] for x in (seq, end, at, low, high, wall, until))
            alive = np.ones(len(keep), dtype=bool)
        stop = np.maximum(wall, 0)
        can = at > stop
        new_low, new_high = low.copy(), high.copy()
        go = np.flatnonzero(can)
        if len(go):
            new_low[go], new_high[go] = index.back(symbols[base[seq[go]] + at[go] - 1], low[go], high[go])
        grown = can & (new_high - new_low >= 2)
        at[grown] -= 1
        low[grown], high[grown] = new_low[grown], new_high[grown]
        halted = np.flatnonzero(~grown)
        if not len(halted):
            continue
        h_at, h_end, h_wall, h_until, broke = at[halted], end[halted], wall[halted], until[halted], can[halted]
        trial = h_wall >= 0
        done = ~trial & (h_end - h_at >= least)
        for s, a, z in zip(seq[halted[done]].tolist(), h_at[done].tolist(), h_end[done].tolist()):
            out.append((s, a, z))
        next_end = np.zeros(len(halted), np.int64)
        next_wall = np.full(len(halted), -1)
        next_until = np.zeros(len(halted), np.int64)
        finished = ~trial & ~broke
        # the match broke at at - 1: [at - 1, end) stands once
        single = np.where(broke, h_at - 1, 0)
        size = h_end - single
        # a long single stretch is tried again from nearer ends: 4, then 12 words behind its begin
        try4 = broke & (size > 4)
        next_wall[try4], next_until[try4], next_end[try4] = single[try4], h_end[try4], single[try4] + 4
        short = broke & ~try4
        next_end[short] = h_end[short] - 1
        held = trial & ~broke  # the trial stretch stands twice
        longer = held & (h_end - h_wall == 4) & (h_until - h_wall > 12)
        next_wall[longer], next_until[longer], next_end[longer] = h_wall[longer], h_until[longer], h_wall[longer] + 12
        rest = held & ~longer
        next_end[rest] = h_until[rest] - 1
        alive[halted] = ~finished & ((next_wall >= 0) | (next_end >= least))
        end[halted], at[halted], wall[halted], until[halted] = next_end, next_end, next_wall, next_until
        low[halted], high[halted] = 0, index.n
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.array(out, np.int64)
    return found[:, 0], found[:, 1], found[:, 2]
