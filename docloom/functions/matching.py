"""How alike two texts are: the share of characters in common blocks, found longest first, many pairs at a time.

The longest block that both texts share (ties: the earliest in the first text, then in the second) splits a pair into
what stands left and right of it, and so on until nothing is shared. With `autojunk`, characters that make up over one percent of a
second text of 200 characters or more can't begin a block, only lengthen one to both sides.

Blocks are found by names: equal windows of 2**k characters have equal numbers, and a window of any length is named by the two
that cover it. A level of the splitting handles all open ranges of all pairs together: where a window can begin and how long it
may be bounds each range's longest block from above, and a few tests from there down find it. A range's blocks of that
length are then taken in order, so every level ends with shorter ones.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np

#: Characters of the pairs that are worked on together; a worker holds some 150 times as many bytes meanwhile.
TOGETHER = 100_000


def similarities(firsts: Sequence[str], seconds: Sequence[str], autojunk: bool = True) -> list[float]:
    """2 * matched / (both lengths) of each pair; two empty texts are alike."""
    out: list[float] = []
    start, size = 0, 0
    for stop, (a, b) in enumerate(zip(firsts, seconds, strict=True), 1):
        size += len(a) + len(b)
        if size >= TOGETHER or stop == len(firsts):
            part = slice(start, stop)
            matched = _Pairs(firsts[part], seconds[part], autojunk).matched()
            out += [2.0 * m / (len(x) + len(y)) if x or y else 1.0 for m, x, y in zip(matched, firsts[part], seconds[part], strict=True)]
            start, size = stop, 0
    return out


def _codes(texts: Sequence[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges, and which range each is of."""
    sizes = stops - starts
    which = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(which)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes), which


class _Pairs:
    """Texts of several pairs behind one another: the first ones, a gap, the second ones, a gap."""

    def __init__(self, firsts: Sequence[str], seconds: Sequence[str], autojunk: bool):
        self.first_sizes, self.second_sizes = np.array([len(x) for x in firsts]), np.array([len(x) for x in seconds])
        a, b = _codes(firsts), _codes(seconds)
        self.n_first, self.codes = len(a), [*a.tolist(), -1, *b.tolist(), -2]
        pair = np.concatenate([np.repeat(np.arange(len(firsts)), self.first_sizes), np.repeat(np.arange(len(firsts)), self.second_sizes)])
        kinds, names = np.unique(pair << 21 | np.concatenate([a, b]), return_inverse=True)
        if autojunk:
            n = self.second_sizes[kinds >> 21]
            common = (n >= 200) & (np.bincount(names[len(a) :], minlength=len(kinds)) > n // 100 + 1)
            names = np.where(common[names], -1, names)
        self._name_windows(np.concatenate([names[: len(a)], [-1], names[len(a) :], [-1]]))

    def _name_windows(self, names: np.ndarray) -> None:
        """self.names[k][p]: the number of the 2**k characters from p if both sides hold them, else -1; self.most[p]: no shared window from p is longer."""
        n, tables = len(names), []
        place, self.most = np.arange(n), np.full(n, n)
        while True:
            length = 1 << len(tables)
            there = np.zeros((2, int(names.max(initial=0)) + 2), dtype=bool)
            there[0, names[: self.n_first]], there[1, names[self.n_first :]] = True, True
            live = (names >= 0) & (there[0] & there[1])[names]
            run = np.minimum.accumulate(np.where(live, n, place)[::-1])[::-1] - place  # live windows in a row from here
            self.most = np.minimum(self.most, np.where(live, run + length - 1, length - 1))
            if not live.any():
                break
            tables.append(np.where(live, names, -1))
            whole = np.flatnonzero(live[: max(n - length, 0)])
            whole = whole[live[whole + length]]
            names = np.full(n, -1)
            if len(whole):
                last = tables[-1]
                names[whole] = np.unique(last[whole] * (int(last.max()) + 1) + last[whole + length], return_inverse=True)[1]
        self.names = np.stack(tables) if tables else np.zeros((0, n), dtype=np.int64)
        self.n_names = int(self.names.max(initial=0)) + 1

    def _keys(self, place: np.ndarray, which: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A number per window (of its range's length) such that equal windows of a range have equal ones."""
        wide = length[which]
        k = np.frexp(wide.astype(np.float64))[1] - 1
        return self.names[k, place] * self.n_names + self.names[k, place + wide - (1 << k)]

    def _shared(self, sides: list[tuple[np.ndarray, np.ndarray]], length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of both sides' windows, comparable over all ranges."""
        keys = [self._keys(place, which, length) for place, which in sides]
        if self.n_names**2 * len(length) >= 2**62:
            keys = np.split(np.unique(np.concatenate(keys), return_inverse=True)[1], [len(keys[0])])
            scale = int(max(k.max(initial=0) for k in keys)) + 1
        else:
            scale = self.n_names**2
        return tuple(which * scale + key for (_, which), key in zip(sides, keys, strict=True))

    def _longest(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Each range's longest shared length up to its bound, and both sides' (place, range, key) of shared windows of that length. low and high: rows of both sides."""
        sides = []
        for start, stop in zip(low, high, strict=True):
            place, which = _spread(start, stop)
            cap = np.minimum(self.most[place], stop[which] - place)
            sides.append((place, which, cap))
            bound = np.minimum(bound, np.maximum.reduceat(cap, np.cumsum(stop - start) - (stop - start)))
        found, most, step = np.zeros_like(bound), bound.copy(), np.ones_like(bound)
        test = most.copy()
        while (open_ := found < most).any():
            chosen = [(place[go], which[go]) for place, which, cap in sides for go in [open_[which] & (cap >= test[which])]]
            own, other = self._shared(chosen, test)
            held = np.zeros(len(bound), dtype=bool)
            held[chosen[0][1][np.isin(own, other)]] = True
            found = np.where(open_ & held, test, found)
            most = np.where(open_ & ~held, test - 1, most)
            # Down from the bound in growing steps until a length is shared, then by halves.
            test = np.where(found > 0, (found + most + 1) // 2, np.maximum(most - step, 1))
            step = np.where(found > 0, step, 2 * step)
        chosen = [(place[go], which[go]) for place, which, cap in sides for go in [(found[which] > 0) & (cap >= found[which])]]
        own, other = self._shared(chosen, np.maximum(found, 1))
        both = [np.isin(own, other), np.isin(other, own)]
        return found, [(place[go], which[go], key[go]) for (place, which), key, go in zip(chosen, (own, other), both, strict=True)]

    def matched(self) -> list[int]:
        """Characters in common blocks, pair by pair."""
        codes, total = self.codes, [0] * len(self.first_sizes)
        ends = np.cumsum(self.first_sizes), np.cumsum(self.second_sizes) + self.n_first + 1
        starts = ends[0] - self.first_sizes, ends[1] - self.second_sizes
        ranges = list(zip(*(x.tolist() for x in (starts[0], ends[0], starts[1], ends[1])), [len(codes)] * len(total), range(len(total)), strict=True))
        while ranges := [r for r in ranges if r[0] < r[1] and r[2] < r[3]]:
            alo, ahi, blo, bhi, bound, _ = np.array(ranges).T
            found, ((a_place, a_range, a_key), (b_place, _, b_key)) = self._longest(np.stack([alo, blo]), np.stack([ahi, bhi]), bound)
            order = np.argsort(b_key, kind="stable")
            b_key, b_list = b_key[order], b_place[order].tolist()
            first, last = np.searchsorted(b_key, a_key).tolist(), np.searchsorted(b_key, a_key, side="right").tolist()
            a_list, cut = a_place.tolist(), np.searchsorted(a_range, np.arange(len(ranges) + 1)).tolist()
            after = []
            for r, (i, i_end, j, j_end, _, pair) in enumerate(ranges):
                length = int(found[r])
                if not length:  # nothing can begin a block: what the range begins with may still lengthen the one before
                    total[pair] += self._alike(i, i_end, j, j_end)
                    continue
                for c in range(cut[r], cut[r + 1]):
                    p = a_list[c]
                    if p < i or (k := bisect_left(b_list, j, first[c], last[c])) == last[c]:
                        continue
                    q = b_list[k]
                    stop = p + length + self._alike(p + length, i_end, q + length, j_end)
                    q_stop = q + stop - p
                    while p > i and q > j and codes[p - 1] == codes[q - 1]:
                        p, q = p - 1, q - 1
                    total[pair] += stop - p
                    after.append((i, p, j, q, length - 1, pair))
                    i, j = stop, q_stop
                after.append((i, i_end, j, j_end, length - 1, pair))
            ranges = after
        return total

    def _alike(self, i: int, i_end: int, j: int, j_end: int) -> int:
        """How many characters are equal from i and j on."""
        codes, n = self.codes, 0
        most = min(i_end - i, j_end - j)
        while n < most and codes[i + n] == codes[j + n]:
            n += 1
        return n
