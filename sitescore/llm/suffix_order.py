"""Suffix orders of many texts at once, by linear grouping construction."""

from __future__ import annotations

import numpy as np


def grouped_suffix_order(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of each text in ascending order.

    Text ``t`` is ``codes[off[t]:off[t + 1]]`` and ends with its only 0, the
    smallest code; its suffixes fill the same places of the result. All texts
    advance in step, one suffix group of each in a round.

    First phase: suffixes are grouped by their first letter, and the groups of a
    text are taken from the greatest to the smallest. For each suffix of the
    group, the pointer to the previous smaller one is found: the nearest
    position to the left whose group is smaller. The suffixes pointed at move to
    new groups right behind their old one, the more often they are pointed at
    the further up. In the end each group holds the suffixes that begin with the
    same Lyndon word. Second phase: from the smallest suffix up, the position
    before it and the chain of pointers from there take the next free places of
    their groups; nothing is renamed or sorted again.
    """
    n, texts = len(codes), len(off) - 1
    low, high = off[:-1], off[1:]
    text = np.repeat(np.arange(texts), high - low)
    order = np.lexsort((codes, text))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    fresh = np.ones(n, bool)
    fresh[1:] = (text[order][1:] != text[order][:-1]) | (codes[order][1:] != codes[order][:-1])
    begin = np.flatnonzero(fresh)
    size = np.zeros(n, np.int64)
    size[begin] = np.diff(np.append(begin, n))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(begin, size[begin])
    before = np.full(n, -1, np.int64)
    moving = np.zeros(n, bool)

    left, active = high.copy(), np.arange(texts)
    while len(active):
        top = left[active]
        g = group[order[top - 1]]
        left[active] = g
        held = top - g
        at = np.arange(int(held.sum())) + np.repeat(g - (np.cumsum(held) - held), held)
        i, gi, lo = order[at], np.repeat(g, held), np.repeat(low[active], held)
        j = i - 1
        todo = np.arange(len(i))
        while len(todo):
            todo = todo[j[todo] >= lo[todo]]
            jt = j[todo]
            gj, gt = group[jt], gi[todo]
            not_smaller = gj >= gt
            todo, jt = todo[not_smaller], jt[not_smaller]
            # groups above are done and know their pointer; this one is not
            j[todo] = np.where(gj[not_smaller] == gt[not_smaller], jt - 1, before[jt])
        j[j < lo] = -1
        before[i] = j
        active = active[g > low[active]]

        moved, times = np.unique(j[j >= 0], return_counts=True)
        if not len(moved):
            continue
        by = np.lexsort((times, group[moved]))
        moved, times = moved[by], times[by]
        old = group[moved]
        edge = np.ones(len(old), bool)
        edge[1:] = old[1:] != old[:-1]
        first = np.flatnonzero(edge)
        count = np.diff(np.append(first, len(old)))
        tail = np.repeat(old[first] + size[old[first]] - count, count)
        place = tail + np.arange(len(old)) - np.repeat(first, count)
        moving[moved] = True
        there = order[place]
        there = there[~moving[there]]
        free = rank[moved]
        free = free[free < tail]
        order[free] = there
        rank[there] = free
        order[place] = moved
        rank[moved] = place
        moving[moved] = False
        size[old[first]] -= count
        edge[1:] |= times[1:] != times[:-1]
        first = np.flatnonzero(edge)
        count = np.diff(np.append(first, len(old)))
        size[place[first]] = count
        group[moved] = np.repeat(place[first], count)

    out = np.full(n, -1, np.int64)
    free = np.arange(n)
    done = np.zeros(n, bool)
    out[low] = high - 1
    done[high - 1] = True
    free[low] += 1
    at, j, active = low.copy(), high - 2, np.arange(texts)
    while len(active):
        ja = j[active]
        put = ja >= low[active]
        put[put] = ~done[ja[put]]
        mine, jp = active[put], ja[put]
        gp = group[jp]
        slot = free[gp]
        out[slot] = jp
        free[gp] = slot + 1
        done[jp] = True
        j[mine] = before[jp]
        on = active[~put]
        at[on] += 1
        on = on[at[on] < high[on]]
        j[on] = out[at[on]] - 1
        active = np.concatenate((mine, on))
    return out
