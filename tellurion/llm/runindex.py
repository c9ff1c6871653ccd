"""A run-length index of a bounded text: the part of operator 9 that runs within a task.

The text is a list of fragments. Its Burrows-Wheeler transform is kept as runs, with
the text position of the first and last suffix of each run. A pattern is streamed
from its end to its start: while the wanted character is that of the current run,
the row steps on by the last-to-first mapping; otherwise it jumps to the end of the
run of that character above, or the start of the one below, whichever the threshold
(the least common prefix between both) says shares more, and takes up the position
sampled there. So every pattern position gets a suffix that shares the longest
prefix with it: its matching statistic, of which only "``least`` bytes or more" is
asked here and answered by comparing that many bytes by their hash.

Rows whose suffixes share their first ``least`` bytes are neighbours. The least owner
of each such range is kept, so a match names the first document that has it.
"""

from __future__ import annotations

import numpy as np

from tellurion.llm.textops import BYTE_VALUES, Spans, ragged_positions

NOWHERE = np.iinfo(np.int64).max


#: Bytes that fit in the first key of a suffix, and the bits of each.
PACKED, FIELD = 7, 9


def suffix_ranks(codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array by prefix doubling, and the keys or ranks by prefix length on the way.

    ``codes`` end each fragment with 0, ``left`` counts the bytes to that end. A
    suffix ends with its fragment; equal suffixes keep the order of their places.
    """
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(PACKED, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(PACKED):
        key = key << FIELD | np.where(left >= k, padded[k : k + n], 0)
    levels, span = [(1, key)], PACKED
    longest = int(left.max(initial=0)) + 1
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.diff(ordered, prepend=ordered[:1]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        levels.append((span, rank))
        if span >= longest or (n and rank[order[-1]] == n - 1):
            return np.argsort(rank * n + np.arange(n)), levels
        later = np.zeros(n, np.int64)
        later[:-span] = np.where(left[:-span] >= span, rank[span:] + 1, 0)
        key, span = rank * (n + 1) + later, span * 2


def common_prefixes(order: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Length of the prefix that each suffix shares with the one before it in order."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    out = np.zeros(n, np.int64)
    for span, rank in reversed(levels[1:]):
        same = rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)]
        same &= (a < n) & (b < n)
        a[same] += span
        b[same] += span
        out[1:] += same * span
    keys = levels[0][1]
    differ = keys[np.minimum(a, n - 1)] ^ keys[np.minimum(b, n - 1)]
    for k in range(1, PACKED):
        out[1:] += differ >> (FIELD * (PACKED - k)) == 0
    return out


class RunIndex:
    """Fragments with owners, searched for the first owner of any ``least`` bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, owners: np.ndarray, least: int):
        sizes = np.diff(offsets)
        place = ragged_positions(sizes, 1)
        codes = np.zeros(len(data) + len(sizes), np.int64)
        codes[place] = data.astype(np.int64) + 1
        n = len(codes)
        left = np.zeros(n, np.int64)
        left[place] = np.repeat(offsets[1:], sizes) - np.arange(len(data))
        order, levels = suffix_ranks(codes, left)
        self.least, self.left = least, left
        bwt = codes[order - 1]
        self.run_start = np.flatnonzero(np.diff(bwt, prepend=-1))
        self.head = bwt[self.run_start]
        length = np.diff(np.append(self.run_start, n))
        self.first_at, self.last_at = order[self.run_start], order[self.run_start + length - 1]
        # Where the characters of a run are mapped to: by character, then by place.
        by_head = np.lexsort((self.run_start, self.head))
        self.maps_to = np.empty(len(by_head), np.int64)
        self.maps_to[by_head] = np.cumsum(length[by_head]) - length[by_head]
        self.length = length
        # Unpacked for the time of the search: the run of each row.
        self.run_of = np.repeat(np.arange(len(length), dtype=np.int32), length)
        self.keyed = self.head[by_head] * len(self.head) + by_head
        self.by_head = by_head
        # Between two runs of a character: the row from which the lower one is nearer.
        shared = common_prefixes(order, levels)
        self.threshold = np.zeros(len(by_head), np.int64)
        above, below = by_head[:-1], by_head[1:]
        pair = np.flatnonzero(self.head[above] == self.head[below])
        if len(pair):
            start = self.run_start[above[pair]] + length[above[pair]]
            stop = self.run_start[below[pair]] + 1
            self.threshold[below[pair]] = _places_of_least(shared, start, stop)
        # Ranges of rows with equal first bytes, and the least owner in each.
        self.values = np.zeros(n, np.uint64)
        self.values[place] = BYTE_VALUES[data]
        self.spans = Spans(self.values)
        full = left[order] >= least
        joined = (shared >= least) & full
        self.group_start = np.flatnonzero(~joined)
        owner = np.full(n, NOWHERE)
        owner[place] = np.repeat(owners, sizes)
        of_row = np.where(full, owner[order], NOWHERE)
        self.group_owner = np.minimum.reduceat(of_row, self.group_start) if n else of_row

    def first_owners(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each pattern position, the first owner of the ``least`` bytes from there.

        Positions with fewer bytes left, or without a match, give ``NOWHERE``.
        """
        sizes = np.diff(offsets)
        out = np.full(len(data), NOWHERE)
        spans = Spans(BYTE_VALUES[data])
        codes = data.astype(np.int64) + 1
        by_size = np.argsort(-sizes, kind="stable")
        at = offsets[1:][by_size].copy()
        begin = offsets[:-1][by_size]
        # Every pattern starts at the first row; its first step jumps where it has to.
        row = np.zeros(len(sizes), np.int64)
        text = np.full(len(sizes), self.first_at[0] if len(self.head) else 0)
        for step in range(int(sizes.max(initial=0))):
            alive = np.searchsorted(-sizes[by_size], -step, "left")
            at[:alive] -= 1
            now, row[:alive], text[:alive] = at[:alive], *self._step(row[:alive], text[:alive], codes[at[:alive]])
            if step + 1 < self.least:
                continue
            reach = self.left[text[:alive]] >= self.least
            p, t, r = now[reach], text[:alive][reach], row[:alive][reach]
            same = spans.of(p, p + self.least) == self.spans.of(t, t + self.least)
            group = np.searchsorted(self.group_start, r[same], "right") - 1
            out[p[same]] = self.group_owner[group]
        return out

    def _step(self, row, text, code):
        """Prepend a character to each match: new rows and text positions."""
        run = self.run_of[row]
        wrong = np.flatnonzero(self.head[run] != code)
        if len(wrong):
            at = np.searchsorted(self.keyed, code[wrong] * len(self.head) + run[wrong])
            lower = self.by_head[np.minimum(at, len(at_ := self.by_head) - 1)]
            upper = self.by_head[np.maximum(at - 1, 0)]
            has_lower = (at < len(at_)) & (self.head[lower] == code[wrong])
            has_upper = (at > 0) & (self.head[upper] == code[wrong])
            go_up = has_upper & (~has_lower | (row[wrong] < self.threshold[lower]))
            chosen = np.where(go_up, upper, lower)
            some = go_up | has_lower
            last = self.run_start[upper] + self.length[upper] - 1
            run[wrong] = np.where(some, chosen, 0)
            row = row.copy()
            text = text.copy()
            row[wrong] = np.where(go_up, last, self.run_start[np.where(some, lower, 0)])
            text[wrong] = np.where(go_up, self.last_at[upper], self.first_at[np.where(some, lower, 0)])
            lost = wrong[~some]
        else:
            lost = wrong
        new_row = self.maps_to[run] + row - self.run_start[run]
        new_text = text - 1
        # A character that the text does not have: start anew.
        new_row[lost], new_text[lost] = 0, self.first_at[0]
        return new_row, np.where(new_text < 0, new_text + len(self.values), new_text)


def _places_of_least(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Place of the least value in each range (sparse table of minima)."""
    n = len(values)
    tagged = values * n + np.arange(n)
    tables = [tagged]
    span = 1
    widest = int((stops - starts).max(initial=1))
    while span * 2 <= widest:
        last = tables[-1]
        tables.append(np.minimum(last[:-span], last[span:]))
        span *= 2
    out = np.empty(len(starts), np.int64)
    level = np.frexp((stops - starts).astype(float))[1] - 1
    for k in np.unique(level):
        own = np.flatnonzero(level == k)
        table = tables[k]
        out[own] = np.minimum(table[starts[own]], table[stops[own] - (1 << int(k))])
    return out % n
