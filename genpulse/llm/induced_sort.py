"""Suffix order of a shard of short strings by induced sorting, in numpy, and its common prefixes.

Suffixes are classed as smaller (S) or larger (L) than their successor. Leftmost S suffixes (LMS)
are ordered first: their substrings by one induction, then the string of their names by doubling
until names tell all suffixes apart. A second induction sorts all suffixes from them. An induction fills buckets by first character; instead of one suffix
at a time it takes whatever a bucket holds so far as one array, in order, so it takes time in
proportion to the shard, and some hundred array steps.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; t ends in its only least character."""
    change = np.append(np.flatnonzero(t[1:] != t[:-1]), len(t) - 1)
    upward = np.append(t[change[:-1]] < t[change[:-1] + 1], True)
    return upward[np.searchsorted(change, np.arange(len(t)))]


def _push(into: list[list[np.ndarray]], items: np.ndarray, t: np.ndarray) -> None:
    """items appended in order to the buckets of their characters."""
    if not len(items):
        return
    chars = t[items]
    order = np.argsort(chars, kind="stable")
    items, chars = items[order], chars[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    for part in np.split(items, cuts):
        into[t[part[0]]].append(part)


def _induced(t: np.ndarray, small: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in the order that the LMS suffixes in `seeds`, sorted within buckets, induce.
    The end of t is one of them, and the first of all."""
    size = int(t.max()) + 1
    large: list[list[np.ndarray]] = [[] for _ in range(size)]
    lms: list[list[np.ndarray]] = [[] for _ in range(size)]
    _push(lms, seeds, t)
    for c in range(size):
        done = 0
        while done < len(large[c]):  # suffixes that this very bucket adds to itself come next
            part = np.concatenate(large[c][done:])
            done = len(large[c])
            before = part[part > 0] - 1
            _push(large, before[~small[before]], t)
        for part in lms[c]:
            before = part[part > 0] - 1
            _push(large, before[~small[before]], t)
    # S suffixes, from the largest down; each bucket is filled from its end
    ends: list[list[np.ndarray]] = [[] for _ in range(size)]
    for c in range(size - 1, -1, -1):
        done = 0
        while done < len(ends[c]):
            part = np.concatenate(ends[c][done:])
            done = len(ends[c])
            before = part[part > 0] - 1
            _push(ends, before[small[before]], t)
        if large[c]:
            part = np.concatenate(large[c])[::-1]
            before = part[part > 0] - 1
            _push(ends, before[small[before]], t)
    out = [np.array([len(t) - 1])]
    for c in range(size):
        out += large[c]
        if ends[c]:
            out.append(np.concatenate(ends[c])[::-1])
    return np.concatenate(out)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of text (characters above 0) sorted by their suffixes."""
    t = np.append(text, 0).astype(np.int16)
    if len(t) < 3:
        return np.argsort(text, kind="stable")
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = _induced(t, small, lms)[1:]
    if len(lms) > 2:
        is_lms = np.zeros(len(t), dtype=bool)
        is_lms[lms[:-1]] = True
        first = order[is_lms[order]]  # LMS positions by their substrings
        follow = np.empty(len(t), dtype=np.int64)
        follow[lms[:-1]] = lms[1:]
        length = follow[first] - first
        equal = np.append(False, length[1:] == length[:-1])
        live = np.flatnonzero(equal)
        k = 0
        while len(live):
            live = live[k <= length[live]]
            differs = t[first[live] + k] != t[first[live - 1] + k]
            equal[live[differs]] = False
            live = live[~differs]
            k += 1
        names = np.empty(len(t), dtype=np.int64)
        names[first] = np.cumsum(~equal)
        rank = names[lms[:-1]]
        step = 1
        while rank.max() < len(rank):
            later = np.append(rank[step:], np.zeros(min(step, len(rank)), dtype=np.int64))
            rank = np.unique(rank * (len(rank) + 2) + later[: len(rank)], return_inverse=True)[1] + 1
            step *= 2
        order = _induced(t, small, np.append(lms[:-1][np.argsort(rank, kind="stable")], len(t) - 1))[1:]
    return order[order < len(text)]


def common_prefixes(text: np.ndarray, sorted_starts: np.ndarray, first: np.ndarray, count: np.ndarray, reach: int) -> np.ndarray:
    """For each start in sorted order, how many characters, reach at most, it shares with the one
    before it. Starts are runs: `count` of them from each of `first`. Worked out in text order: of
    two starts in a row, the second shares at most one character less than the first did."""
    before = np.full(len(text), -1, dtype=np.int64)
    before[sorted_starts[1:]] = sorted_starts[:-1]
    is_start = np.zeros(len(text) + 1, dtype=bool)
    is_start[sorted_starts] = True
    shared = np.zeros(len(text), dtype=np.int16)
    now, q = np.zeros(len(first), dtype=np.int64), np.full(len(first), -1, dtype=np.int64)
    runs = np.argsort(-count, kind="stable")
    first, count = first[runs], count[runs]
    for k in range(int(count.max(initial=0))):
        n = int(np.searchsorted(-count, -k, side="left"))
        p, follows = first[:n] + k, (q[:n] >= 0) & is_start[q[:n] + 1]
        q = before[p]
        now = np.where((q >= 0) & follows, np.maximum(now[:n] - 1, 0), 0)
        live = np.flatnonzero((q >= 0) & (now < reach))
        while len(live):
            live = live[text[p[live] + now[live]] == text[q[live] + now[live]]]
            now[live] += 1
            live = live[now[live] < reach]
        shared[p] = now
    return shared[sorted_starts]
