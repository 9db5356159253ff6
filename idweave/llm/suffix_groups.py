"""Suffix arrays by linear grouping (Lyndon-prefix groups, then one induced pass).

First phase: suffixes start in groups by first symbol. Groups are handled in
descending order. Each member's previous-smaller pointer leads to the nearest
earlier suffix of a smaller group; that suffix's prefix grows by the group's
prefix, once for every member that leads to it, so it moves to a new group at
the end of its own, more repeats further up. When all groups are handled, a
suffix's group stands for its longest Lyndon prefix.

Second phase: suffixes are emitted in ascending order; each emitted suffix
places the suffixes whose Lyndon prefix ends where it begins, found by the same
pointers, into the next free slots of their groups. Nothing is renamed.

``lockstep`` runs both phases for many short texts at once: step t handles the
t-th group (or emits the t-th suffix) of every text. ``single`` is the same for
one text.
"""

from __future__ import annotations

import numpy as np


def _initial(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes by (text, first symbol), the group start of each suffix, and group sizes at the starts."""
    key = owner * (int(symbols.max()) + 1) + symbols
    sa = np.argsort(key, kind="stable").astype(np.int32)
    ordered = key[sa]
    new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.zeros(len(sa) + 1, dtype=np.int32)
    size[new] = np.diff(np.append(new, len(sa)))
    group = np.empty(len(sa) + 1, dtype=np.int32)
    group[sa] = np.repeat(new, size[new])
    group[-1] = -1
    return sa, group, size


def lockstep(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Suffix arrays of texts that lie one after another, longest first, each closed by its only 0.

    Returns positions in ``symbols``, text after text.
    """
    total, none = len(symbols), len(symbols)
    end = np.cumsum(lengths)
    start = end - lengths
    sa, group, size = _initial(symbols, np.repeat(np.arange(len(lengths)), lengths))
    isa = np.empty(total, dtype=np.int32)
    isa[sa] = np.arange(total, dtype=np.int32)
    first = np.zeros(total, dtype=bool)
    first[start] = True
    before = np.full(total + 1, none, dtype=np.int32)  # previous-smaller pointers
    moving = np.zeros(total, dtype=bool)
    top = end.copy()
    active = np.flatnonzero(top > start + 1)
    while len(active):
        hi = top[active]
        lo = group[sa[hi - 1]]
        n = hi - lo
        member = sa[np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)]
        own = np.repeat(lo, n)
        to = np.where(first[member], none, member - 1)
        late = np.flatnonzero(group[to] > own)
        while len(late):
            far = before[to[late]]
            to[late] = far
            late = late[group[far] > own[late]]
        before[member] = to
        late = np.flatnonzero(group[to] == own)
        while len(late):
            far = before[to[late]]
            to[late] = far
            before[member[late]] = far
            late = late[group[far] == own[late]]
        to = np.sort(to[to < none])
        if len(to):
            at = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            repeats, to = np.diff(np.append(at, len(to))), to[at]
            home = group[to]
            order = np.lexsort((repeats, home))
            to, repeats, home = to[order], repeats[order], home[order]
            fresh = np.concatenate([[True], home[1:] != home[:-1]])
            at = np.flatnonzero(fresh)
            moved = np.diff(np.append(at, len(to)))
            tail = home[at] + size[home[at]] - moved
            slot = np.arange(len(to)) + np.repeat(tail - at, moved)
            fresh[1:] |= repeats[1:] != repeats[:-1]
            cut = np.flatnonzero(fresh)
            count = np.diff(np.append(cut, len(to)))
            moving[to] = True
            held = sa[slot]
            held = held[~moving[held]]
            old = isa[to]
            old = old[old < np.repeat(tail, moved)]
            moving[to] = False
            sa[old], isa[held] = held, old
            sa[slot], isa[to] = to, slot
            size[home[at]] -= moved
            size[slot[cut]] = count
            group[to] = np.repeat(slot[cut], count)
        top[active] = lo
        active = active[lo > start[active] + 1]
    # second phase
    out = np.empty(total, dtype=np.int32)
    slot, placed = np.arange(total + 1, dtype=np.int32), np.zeros(total + 1, dtype=bool)
    out[start], placed[end - 1], placed[none] = end - 1, True, True
    fewer = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0))  # texts longer than t
    for t, k in enumerate(fewer.tolist()):
        s = out[start[:k] + t]
        to = np.where(first[s], none, s - 1)
        to = to[~placed[to]]
        while len(to):
            g = group[to]
            at = slot[g]
            slot[g] = at + 1
            out[at] = to
            placed[to] = True
            to = before[to]
            to = to[~placed[to]]
    return out


def single(symbols: list[int]) -> list[int]:
    """The suffix array of one text that its only 0 closes."""
    n = len(symbols)
    sa, group, size = (v.tolist() for v in _initial(np.asarray(symbols, dtype=np.int64), np.zeros(n, dtype=np.int64)))
    isa, before, top = [0] * n, [n] * (n + 1), n
    for i, s in enumerate(sa):
        isa[s] = i
    while top > 1:
        lo = group[sa[top - 1]]
        members, leads = sorted(sa[lo:top]), {}
        for m in members:  # ascending, so an earlier member's pointer is known
            to = m - 1 if m else n
            while group[to] >= lo:
                to = before[to]
            before[m] = to
            if to < n:
                leads[to] = leads.get(to, 0) + 1
        homes: dict[int, list[int]] = {}
        for to in leads:
            homes.setdefault(group[to], []).append(to)
        for home, moved in homes.items():
            at = home + size[home]
            size[home] -= len(moved)
            moved.sort(key=lambda j: -leads[j])
            run = 0
            for i, j in enumerate(moved):
                at -= 1
                other, old = sa[at], isa[j]
                sa[old], isa[other], sa[at], isa[j] = other, old, j, at
                run += 1
                if i + 1 == len(moved) or leads[moved[i + 1]] != leads[j]:
                    size[at] = run
                    for k in moved[i + 1 - run:i + 1]:
                        group[k] = at
                    run = 0
        top = lo
    out, slot, placed = [n - 1] * n, list(range(n + 1)), [False] * n + [True]
    placed[n - 1] = True
    for i in range(n):
        to = out[i] - 1 if out[i] else n
        while not placed[to]:
            at = slot[group[to]]
            slot[group[to]] = at + 1
            out[at] = to
            placed[to] = True
            to = before[to]
    return out
