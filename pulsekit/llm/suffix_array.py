"""Suffix arrays by linear grouping (Baier, 2016).

Phase 1 groups suffixes by their longest Lyndon prefix.  Groups, at first one
per symbol, are processed from the highest down.  The previous smaller
position of a suffix is the nearest one to its left whose group is still to
come; the positions that the members of a group point to are split off from
their own groups, those pointed to more often higher, because their prefix
grows by the group's prefix as many times.  Phase 2 goes through the suffixes
in order as they become known: every suffix whose Lyndon prefix ends where
the one at hand begins takes the next place in its group; they are found by
following the previous-smaller pointers.  Nothing is renamed or sorted again.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Positions of the suffixes in ascending order; a shorter suffix precedes those it begins."""
    text = [*symbols, min(symbols, default=0) - 1]
    n = len(text)
    group_of, members, above, below, top = _by_symbol(text)
    smaller = [-1] * n
    up = list(range(n))         # itself while its group is to come, then a position left of it
    g = top
    while g >= 0:
        own = members[g] = [i for i in members[g] if group_of[i] == g]
        for i in own:
            up[i] = i - 1
        hits: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and up[j] != j:
                k = up[j]
                if k >= 0:
                    up[j] = up[k]
                j = k
            smaller[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        split: dict[tuple[int, int], list[int]] = {}
        for j, times in hits.items():
            split.setdefault((group_of[j], -times), []).append(j)
        for h, times in sorted(split) if len(split) > 1 else split:  # the most often hit first: the rest go below it
            new = len(members)
            moved = split[h, times]
            members.append(moved)
            for j in moved:
                group_of[j] = new
            over = above[h]
            above.append(over)
            below.append(h)
            above[h] = new
            below[over] = new   # a group above exists: the one at hand is higher than h
        g = below[g]
    return _ordered(n, group_of, members, above, smaller)[1:]


def _by_symbol(text: list[int]):
    symbols = sorted(set(text))
    number = {c: g for g, c in enumerate(symbols)}
    group_of = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group_of):
        members[g].append(i)
    last = len(symbols) - 1
    above = [g + 1 if g < last else -1 for g in range(len(symbols))]
    return group_of, members, above, list(range(-1, last)), last


def _ordered(n: int, group_of: list[int], members: list[list[int]], above: list[int], smaller: list[int]) -> list[int]:
    free = [0] * len(members)
    at, g = 0, 0                # group 0 holds the end mark, the lowest suffix
    while g >= 0:
        free[g] = at
        at += sum(group_of[i] == g for i in members[g])
        g = above[g]
    out = [-1] * n
    out[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for at in range(n):
        j = out[at] - 1
        while j >= 0 and not placed[j]:
            g = group_of[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = smaller[j]
    return out
