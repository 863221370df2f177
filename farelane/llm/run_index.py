"""A run-length index of a text: its Burrows-Wheeler transform as runs, with the suffix
positions sampled at both ends of each run. Small numpy helpers for ``suffix_dedup``.

Streaming a pattern from its right end keeps the exact rank of each of its suffixes among
the suffixes of the text, and the positions of the two suffixes that enclose it. The longest
match of a pattern's suffix in the text is with one of these two.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix positions in order, the empty suffix (a sentinel) first; prefix doubling over unsettled suffixes."""
    n = len(text) + 1
    codes = np.zeros(n + 8, np.uint64)
    codes[: n - 1] = text
    codes[: n - 1] += 1  # 1..256 in nine bits, 0 past the end
    key = np.zeros(n, np.uint64)
    for i in range(7):
        key = key << np.uint64(9) | codes[i : i + n]
    order = np.argsort(key)
    held = key[order]
    start = np.r_[True, held[1:] != held[:-1]]
    # A suffix's rank is the first place of its group, so settled groups keep theirs.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    depth = 7
    single = start & np.r_[start[1:], True]
    open_places = np.flatnonzero(~single)
    while len(open_places):
        who = order[open_places]
        after = np.where(who + depth < n, rank[np.minimum(who + depth, n - 1)] + 1, 0)
        pair = rank[who] * (n + 1) + after
        by = np.argsort(pair)
        who, pair = who[by], pair[by]
        order[open_places] = who
        start = np.r_[True, pair[1:] != pair[:-1]]
        rank[who] = np.maximum.accumulate(np.where(start, open_places, 0))
        open_places = open_places[~(start & np.r_[start[1:], True])]
        depth *= 2
    return order


class RunIndex:
    def __init__(self, text: np.ndarray):
        order = suffix_array(text)
        self.text, self.n = text, len(order)
        symbols = np.where(order > 0, text[np.maximum(order, 1) - 1].astype(np.int64), -1) if len(text) else np.array([-1])
        starts = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        ends = np.r_[starts[1:], self.n] - 1
        self.runs = len(starts)
        self.run_start = np.r_[starts, self.n]
        # A row behind the last is in a run of its own, which has no symbol.
        self.run_of_row = np.repeat(np.arange(self.runs + 1, dtype=np.int32), np.r_[ends - starts + 1, 1])
        self.run_symbol = np.r_[symbols[starts], -2]
        # Runs by symbol, in text order, with the rows of the symbol before each.
        self.by_symbol = np.argsort(symbols[starts], kind="stable")
        self.in_symbol = np.zeros(self.runs + 1, np.int64)
        self.in_symbol[self.by_symbol] = np.arange(self.runs)
        # The samples of a run, where the suffix with its symbol in front begins.
        self.head_before, self.end_before = order[starts][self.by_symbol] - 1, order[ends][self.by_symbol] - 1
        self.symbol_key = symbols[starts][self.by_symbol] * (self.runs + 1) + self.by_symbol
        if 257 * (self.runs + 1) < 1 << 31:
            self.symbol_key = self.symbol_key.astype(np.int32)
        self.rows_before = np.r_[0, np.cumsum((ends - starts + 1)[self.by_symbol])]
        self.symbol_first = np.searchsorted(symbols[starts][self.by_symbol], np.arange(258))
        # First rows of suffixes by their first symbol, and the samples at these borders.
        self.block = 1 + np.r_[0, np.cumsum(np.bincount(text, minlength=257))]
        self.block_head = np.where(self.block < self.n, order[np.minimum(self.block, self.n - 1)], -1)
        self.block_end = order[self.block - 1]
        self.first_row = self.block[:257] - self.rows_before[self.symbol_first[:257]]

    def stream(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each byte of the patterns ``data[start:start + size]``: positions in the text of the suffixes next above and
        next below the pattern's suffix that begins there (-1: none)."""
        above, below = np.full(len(data), -1, np.int32), np.full(len(data), -1, np.int32)
        by_size = np.argsort(-sizes, kind="stable")
        ends, sizes = (starts + sizes)[by_size], sizes[by_size]
        live = len(sizes)
        row = np.zeros(live, np.int64)
        up, down = np.full(live, self.n - 1, np.int64), np.full(live, -1, np.int64)
        for step in range(int(sizes[0]) if live else 0):
            live = int(np.searchsorted(-sizes, -step))  # patterns longer than step
            row, up, down = row[:live], up[:live], down[:live]
            place = ends[:live] - 1 - step
            symbol = data[place].astype(np.int64)
            run = self.run_of_row[row]
            inside = self.run_symbol[run] == symbol
            into = row - self.run_start[run]
            nth = self.in_symbol[run]
            apart = np.flatnonzero(~inside)
            nth[apart] = np.searchsorted(self.symbol_key, (symbol[apart] * (self.runs + 1) + run[apart]).astype(self.symbol_key.dtype))
            row = self.first_row[symbol] + self.rows_before[nth] + np.where(inside, into, 0)
            later = self.head_before[np.minimum(nth, self.runs - 1)]
            earlier = self.end_before[np.maximum(nth - 1, 0)]
            up = np.where(inside, up - 1, np.where(nth < self.symbol_first[symbol + 1], later, self.block_head[symbol + 1]))
            down = np.where(inside & (into > 0), down - 1, np.where(nth > self.symbol_first[symbol], earlier, self.block_end[symbol]))
            above[place], below[place] = up, down
        return above, below

    def long_matches(self, data: np.ndarray, limit: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        """Whether ``data[i:i + width]`` equals the text at ``at[i]``; no match reaches beyond ``limit[i]``."""
        found = np.zeros(len(data), bool)
        place = np.flatnonzero((at >= 0) & (at <= len(self.text) - width))
        place = place[place + width <= limit[place]]
        for probe in (0, width - 1, width // 2, width // 4, 3 * width // 4):
            place = place[data[place + probe] == self.text[at[place] + probe]]
        if not len(place):
            return found
        # Places on one diagonal behind each other share their comparisons.
        opens = np.flatnonzero(np.r_[True, (place[1:] != place[:-1] + 1) | (at[place[1:]] != at[place[:-1]] + 1)])
        counts = np.diff(np.r_[opens, len(place)])
        sizes = counts + width - 1
        ends = np.cumsum(sizes)
        shift = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        same = data[np.repeat(place[opens], sizes) + shift] == self.text[np.repeat(at[place[opens]], sizes) + shift]
        wrong = np.r_[0, np.cumsum(~same)]
        first = np.repeat(ends - sizes, counts) + np.arange(len(place)) - np.repeat(opens, counts)
        found[place] = wrong[first + width] == wrong[first]
        return found
