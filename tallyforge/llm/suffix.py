"""Suffix arrays of many texts at once, by linear grouping over Lyndon prefixes.

Phase 1 groups the suffixes of a text by their longest Lyndon prefix. Groups are met in
descending order. For each member of a group the nearest earlier position in a lower group is
found by following the pointers of finished positions (previous-smaller pointers); the positions
found extend their own prefix by the group's, once for each member that points to them, and so
form new groups directly above their old one. Phase 2 walks the order from its least suffix: the
suffix before the current one, and what its pointers lead to until something already placed,
comes next in its group. No names are compared and nothing is renamed or sorted recursively.

Both phases advance all texts of a batch in step, so each numpy call serves thousands of texts.
"""

from __future__ import annotations

import numpy as np


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .., and so on."""
    if not len(start):
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(size)
    return np.arange(ends[-1]) + np.repeat(start - ends + size, size)


def suffix_arrays(codes: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of texts in order, text after text.

    codes: all texts end to end, each with a last symbol below all its others; base: where each
    text begins, and the whole length at the end."""
    n, sizes = len(codes), np.diff(base)
    text = np.repeat(np.arange(len(sizes)), sizes)
    key = text * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    fresh = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
    group_size = np.zeros(n + 1, dtype=np.int64)
    group_size[fresh] = np.diff(np.append(fresh, n))
    # one more cell, at index -1, stands before the first text and is below every group
    group = np.full(n + 1, -1, dtype=np.int64)
    group[order] = np.repeat(fresh, group_size[fresh])
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    prev = np.full(n + 1, -1, dtype=np.int64)
    step = np.full(n + 1, -1, dtype=np.int64)
    moving = np.zeros(n + 1, dtype=bool)
    first, last = base[:-1].copy(), base[1:] - 1
    while len(first):
        start = group[order[last]]
        size = last - start + 1
        members = order[ragged(start, size)]
        own, low = np.repeat(start, size), np.repeat(first, size)
        at = members - 1
        up = np.flatnonzero(group[at] > own)
        while len(up):
            at[up] = prev[at[up]]
            up = up[group[at[up]] > own[up]]
        step[members] = at
        same = np.flatnonzero(group[at] == own)
        while len(same):
            at[same] = step[at[same]]
            step[members[same]] = at[same]
            same = same[group[at[same]] == own[same]]
        prev[members] = at
        at = at[at >= low]
        if len(at):
            at, times = np.unique(at, return_counts=True)
            home = group[at]
            by = np.lexsort((times, home))
            at, times, home = at[by], times[by], home[by]
            edge = np.append(True, home[1:] != home[:-1])
            head = np.flatnonzero(edge)
            many = np.diff(np.append(head, len(at)))
            tail = home[head] + group_size[home[head]] - many
            slots = ragged(tail, many)
            moving[at] = True
            there = order[slots]
            pushed = there[~moving[there]]
            moving[at] = False
            left = place[at]
            left = left[left < np.repeat(tail, many)]
            order[left], place[pushed] = pushed, left
            order[slots], place[at] = at, slots
            group_size[home[head]] -= many
            runs = np.flatnonzero(edge | np.append(True, times[1:] != times[:-1]))
            length = np.diff(np.append(runs, len(at)))
            group[at] = np.repeat(slots[runs], length)
            group_size[slots[runs]] = length
        last = start - 1
        go = last >= first
        first, last = first[go], last[go]
    return emit(group, prev, base)


def emit(group: np.ndarray, prev: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Phase 2: the order within the groups."""
    n = int(base[-1])
    out = np.full(n, -1, dtype=np.int64)
    front = np.arange(n + 1)
    placed = np.zeros(n + 1, dtype=bool)
    first, size = base[:-1], np.diff(base)
    least = base[1:] - 1
    out[first], placed[least] = least, True
    by = np.argsort(-size, kind="stable")
    first, size = first[by], size[by]
    for k in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-size, -k, side="left"))
        low = first[:live]
        at = out[low + k] - 1
        go = np.flatnonzero((at >= low) & ~placed[at])
        while len(go):
            own = at[go]
            to = front[group[own]]
            out[to], placed[own] = own, True
            front[group[own]] = to + 1
            at[go] = prev[own]
            go = go[(at[go] >= low[go]) & ~placed[at[go]]]
    return out
