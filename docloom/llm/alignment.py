"""Two token streams aligned by anchors, in time close to linear in both."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Hashable, Sequence

#: How often what stands between anchors is looked at for anchors of its own.
LEVELS = 40


def aligned(left: Sequence[Hashable], right: Sequence[Hashable]) -> list[tuple[int, int]]:
    """Pairs of places with equal tokens, rising on both sides; no token of either stands in two pairs.

    Equal beginnings and ends pair up. In between, windows that each side has once are anchors, of the width that has most of them,
    as many as keep their order; without such windows each token's first occurrences on both sides are, its second ones, and
    so on. Then the same goes for what stands between neighbouring anchors. Streams of tokens that don't repeat get a longest common subsequence.
    What stays unpaired after `LEVELS` rounds stays so, which makes an alignment shorter, never wrong. Empty streams have no pairs.
    """
    pairs: list[tuple[int, int]] = []
    ranges = [(0, len(left), 0, len(right))]
    for _ in range(LEVELS):
        between = []
        for a, a_end, b, b_end in ranges:
            while a < a_end and b < b_end and left[a] == right[b]:
                pairs.append((a, b))
                a, b = a + 1, b + 1
            while a < a_end and b < b_end and left[a_end - 1] == right[b_end - 1]:
                a_end, b_end = a_end - 1, b_end - 1
                pairs.append((a_end, b_end))
            if a < a_end and b < b_end:
                anchors = _anchors(left, right, a, a_end, b, b_end)
                pairs += anchors
                for i, j in anchors:
                    between.append((a, i, b, j))
                    a, b = i + 1, j + 1
                if anchors:  # without one nothing is shared
                    between.append((a, a_end, b, b_end))
        ranges = [r for r in between if r[0] < r[1] and r[2] < r[3]]
        if not ranges:
            break
    return sorted(pairs)


def _anchors(left: Sequence[Hashable], right: Sequence[Hashable], a: int, a_end: int, b: int, b_end: int) -> list[tuple[int, int]]:
    """A longest rising run of the ranges' candidate pairs."""
    ours, theirs, width, most, repeated = left[a:a_end], right[b:b_end], 1, [], []
    while shared := set(ours).intersection(theirs):
        sides = [Counter(ours), Counter(theirs)]
        own = {x: j for j, x in enumerate(theirs) if sides[1][x] == 1 == sides[0].get(x)}
        once = [(a + i, b + own[x]) for i, x in enumerate(ours) if x in own]
        if width == 1:
            places: dict[Hashable, list[int]] = {x: [] for x in shared}
            for j, x in enumerate(theirs):
                if x in places:
                    places[x].append(b + j)
            turns = {x: iter(y) for x, y in places.items()}
            repeated = [(a + i, j) for i, x in enumerate(ours) if x in turns and (j := next(turns[x], None)) is not None]
        most = max(most, once, key=len)
        if len(most) >= max(1, len(shared) // 2):
            break
        number = {x: k for k, x in enumerate(shared)}  # windows of twice the width, by the numbers of their halves
        ours, theirs = ([(number[x], number[y]) if x in number and y in number else None for x, y in zip(z, z[width:], strict=False)] for z in (ours, theirs))
        ours, theirs, width = [x or (-1, k) for k, x in enumerate(ours)], [x or (-2, k) for k, x in enumerate(theirs)], 2 * width
    candidates = most or repeated
    lasts: list[int] = []  # the least right place that a rising run of each length ends with
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(candidates):
        at = bisect_left(lasts, j)
        before.append(ends[at - 1] if at else -1)
        lasts[at : at + 1], ends[at : at + 1] = [j], [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(candidates[k])
        k = before[k]
    return out[::-1]
