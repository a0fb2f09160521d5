"""Names for runs and pairs of symbols, round by round, and what of a substring they fix (recompression).

Round 0 symbols are words. Every fourth round names maximal runs of one symbol, the other rounds pairs: half of all symbols
are left ones, the rest right ones, by a bit of their name and the round, and a left one followed by a right one becomes one
symbol. A name is a digest of what it stands for (two lanes of 64 bits), so it is the same in every task without an exchange.

Which symbols a substring's inside becomes depends on the substring alone, but for its ends: the first symbol may merge
with an unseen one before it if it is a right one, the last with one after it if it is a left one, and runs at the ends may go on. These
are set aside round by round until nothing would be left. The symbols of the last round that has some are the substring's
core; core and set-aside symbols spell the substring, so equal substrings, and no others, have equal spellings.
"""

from __future__ import annotations

import numpy as np

LANES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
RUN_EVERY = 4


def _mixed(x: np.ndarray, lane: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * (LANES[lane] | np.uint64(1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray, salt: int, lane: int) -> np.ndarray:
    """Digest of (left, right, salt), in that order."""
    return _mixed(_mixed(left + np.uint64(salt + 1), lane) * np.uint64(0xA0761D6478BD642F) + right, 1 - lane)


class Level:
    """One round's symbols, and where they go in the next round."""

    def __init__(self, names: tuple[np.ndarray, np.ndarray], owner: np.ndarray, words: np.ndarray, number: int):
        self.names, self.owner, self.words, self.number = names, owner, words, number        # words: where a symbol's first word stands, and the end
        self.runs = number % RUN_EVERY == 0
        same = owner[1:] == owner[:-1]
        a, b = names
        if self.runs:
            goes_on = same & (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        else:
            self.right = (_mixed(a + np.uint64(number), 1) >> np.uint64(63)).astype(bool)
            goes_on = same & ~self.right[:-1] & self.right[1:]
        begins = np.ones(len(a), bool)
        begins[1:] = ~goes_on
        self.next = np.cumsum(begins, dtype=np.int32) - np.int32(1)           # each symbol's index in the next round
        self.starts = np.flatnonzero(begins).astype(np.int32)
        self.ends = np.append(self.starts[1:], np.int32(len(a)))
        several = np.flatnonzero(self.ends - self.starts > 1)
        first = self.starts[several]
        self.above = tuple(n[self.starts] for n in names)
        for lane in (0, 1):
            other = (self.ends - self.starts)[several].astype(np.uint64) if self.runs else names[lane][first + 1]
            self.above[lane][several] = joined(names[lane][first], other, number, lane)


class Rounds:
    """The rounds over a block's texts; ``owner`` tells the texts apart. Rounds are made when they are asked for."""

    def __init__(self, names: tuple[np.ndarray, np.ndarray], owner: np.ndarray):
        self.levels = [Level(names, owner, np.arange(len(owner) + 1, dtype=np.int32), 0)] if len(owner) else []

    def level(self, number: int) -> Level:
        while number >= len(self.levels):
            last = self.levels[-1]
            self.levels.append(Level(last.above, last.owner[last.starts], last.words[np.append(last.starts, len(last.owner))], last.number + 1))
        return self.levels[number]

    def anchors(self, begin: np.ndarray, end: np.ndarray, round_: int) -> tuple[np.ndarray, ...]:
        """(round, place, first word, end, name) of one symbol of each substring of words ``begin`` to ``end``, and whether it is a run that goes
        on beyond its core. Of the substring's symbols in this round it is the one with the least name, the first of equals. A substring that
        ends in an earlier round has the first symbol of its core, in a round of runs the last run's first; or the one run that its core is."""
        level, low, high, _ = self._reduce(begin, end, False, round_)
        place, name, lasting = low.copy(), np.zeros(len(level), np.uint64), np.zeros(len(level), bool)
        first, last = np.zeros(len(level), np.int32), np.zeros(len(level), np.int32)
        for number in np.unique(level).tolist():
            own, at = np.flatnonzero(level == number), self.level(number)
            if number == round_:
                place[own] = least_between(at.names[0], low[own], high[own])
            elif at.runs:
                place[own] = at.starts[at.next[high[own] - 1]]
                lasting[own] = place[own] <= low[own]
            first[own], last[own] = at.words[place[own]], at.words[place[own] + 1]
            name[own] = joined(at.names[0][place[own]], np.uint64(0), number, 1)
        return level, place, first, last, name, lasting

    def spellings(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both lanes of each substring's spelling."""
        return self._reduce(begin, end, True)[3]

    def _reduce(self, begin: np.ndarray, end: np.ndarray, spell: bool, stop: int = 1 << 30):
        """Sets aside what is not certain, down to the core or to the round ``stop``."""
        n = len(begin)
        out_level, out_low, out_high = np.zeros(n, np.int16), np.zeros(n, np.int32), np.zeros(n, np.int32)
        spelled = tuple(np.zeros(n, np.uint64) for _ in range(2)) if spell else None
        left, right = (tuple(np.zeros(n, np.uint64) for _ in range(2)) for _ in range(2)) if spell else (None, None)
        rows, low, high, number = np.arange(n), begin.astype(np.int32), end.astype(np.int32), 0
        while len(rows):
            at = self.level(number)
            if number == stop:
                out_level[rows], out_low[rows], out_high[rows] = number, low, high
                break
            if at.runs:
                first, last = at.next[low], at.next[high - 1]
                new_low, new_high = np.minimum(at.ends[first], high), np.maximum(at.starts[last], low)
            else:
                new_low, new_high = low + at.right[low], high - ~at.right[high - 1]
            over = new_low >= new_high
            done = rows[over]
            out_level[done], out_low[done], out_high[done] = number, low[over], high[over]
            if spell:
                for lane in (0, 1):
                    names = at.names[lane]
                    if len(done):
                        a, b = low[over], high[over]
                        head = np.minimum(at.ends[at.next[a]], b) - a if at.runs else b - a
                        core = joined(joined(names[a], names[b - 1], number, lane), (head.astype(np.uint64) << np.uint64(32)) | (b - a).astype(np.uint64), number, lane)
                        spelled[lane][done] = joined(joined(left[lane][done], right[lane][done], 7, lane), core, 9, lane)
                    for side, gone, symbol, some in ((left, new_low - low, low, ~over & (new_low > low)), (right, high - new_high, high - 1, ~over & (high > new_high))):
                        r = rows[some]
                        set_aside = joined(names[symbol[some]], gone[some].astype(np.uint64), number, lane)
                        side[lane][r] = joined(side[lane][r], set_aside, 3, lane)
            keep = ~over
            rows, low, high = rows[keep], at.next[new_low[keep]], at.next[new_high[keep] - 1] + np.int32(1)
            number += 1
        return out_level, out_low, out_high, spelled


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Index of the least of ``values[low:high]``, the first of equals, for each (low, high)."""
    out = np.zeros(len(low), np.int32)
    spans = np.frexp((high - low).astype(np.float64))[1] - 1                # the largest power of two within
    table = np.arange(len(values), dtype=np.int32)
    for k in range(int(spans.max(initial=-1)) + 1):
        own = np.flatnonzero(spans == k)
        if len(own):
            a, b = table[low[own]], table[high[own] - (1 << k)]
            out[own] = np.where(values[b] < values[a], b, a)
        step = 1 << k
        if len(table) <= step:
            break
        a, b = table[:-step], table[step:]
        table = np.where(values[b] < values[a], b, a)
    return out


def windows_of(lengths: np.ndarray, width: int) -> np.ndarray:
    """Places where ``width`` words of one text begin, for texts of these lengths one after another."""
    ends = np.cumsum(lengths)
    count = np.maximum(lengths - width + 1, 0)
    return np.repeat(ends - lengths - (np.cumsum(count) - count), count) + np.arange(count.sum())


def ranges_of(level: np.ndarray, place: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) indexes of the runs of neighbouring windows that have one anchor."""
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (np.diff(windows) != 1) | (np.diff(level) != 0) | (np.diff(place) != 0)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(windows))
