"""A suffix array in linear time by grouping: Lyndon-prefix groups first, then their order."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> list[int]:
    """Starts of all suffixes in rising order; the last symbol must be smaller than all others.

    First every suffix is put into the group of its longest Lyndon prefix. Groups are
    worked off from the largest down. ``before`` of a suffix is the nearest earlier one
    in a smaller group, found by jumping over suffixes whose pointer is known. A suffix
    that ``k`` members of the group point to has ``k`` copies of the group's prefix
    behind its own, so it moves with its likes into a new group right above its old one.

    Then suffixes are emitted from the smallest up: the one before each, and on along the
    pointers, is the next of its group. Nothing is renamed or sorted again.
    """
    n = len(symbols)
    if not n:
        return []
    order = np.argsort(symbols, kind="stable")
    heads = np.concatenate([[True], symbols[order][1:] != symbols[order][:-1]])
    starts = np.flatnonzero(heads)
    sizes = np.diff(np.append(starts, n))
    group, place, size = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
    group[order], place[order], size[starts] = np.repeat(starts, sizes), np.arange(n), sizes
    order, group, place, size = order.tolist(), group.tolist(), place.tolist(), size.tolist()
    group.append(-1)  # read at place -1, left of the first suffix
    before = [-1] * n

    end = n
    while end:
        head = group[order[end - 1]]
        members = order[head:end]
        end = head
        if len(members) == 1:
            # what the loops below do for many
            i = members[0]
            j = i - 1
            while group[j] >= head:
                j = before[j]
            before[i] = j
            if j >= 0:
                old = group[j]
                left = size[old] - 1
                if left:
                    at = old + left
                    here, other = place[j], order[at]
                    order[at], order[here] = j, other
                    place[j], place[other] = at, here
                    group[j] = at
                    size[old], size[at] = left, 1
            continue
        members.sort()
        pointed = []
        for i in members:
            j = i - 1
            while group[j] >= head:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed.append(j)
        if len(set(pointed)) == len(pointed):
            by_count = [pointed] if pointed else []
        else:
            count: dict[int, int] = {}
            for j in pointed:
                count[j] = count.get(j, 0) + 1
            parts: dict[int, list[int]] = {}
            for j, k in count.items():
                parts.setdefault(k, []).append(j)
            by_count = [parts[k] for k in sorted(parts, reverse=True)]
        for moved in by_count:
            # to the end of its old group, which shrinks; then all read off where the new one begins
            for j in moved:
                old = group[j]
                size[old] = left = size[old] - 1
                at = old + left
                here, other = place[j], order[at]
                order[at], order[here] = j, other
                place[j], place[other] = at, here
            new = [group[j] + size[group[j]] for j in moved]
            for j, g in zip(moved, new):
                group[j] = g
                size[g] += 1

    out = [-1] * n
    free = list(range(n))
    placed = bytearray(n + 1)
    placed[n] = 1
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while not placed[j]:
            head = group[j]
            at = free[head]
            out[at] = j
            free[head] = at + 1
            placed[j] = 1
            j = before[j]
    return out
