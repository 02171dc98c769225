"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

_LANES = 8192


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a uint8 array in their order; a suffix that ends first comes first.

    Groups of suffixes equal in their first h bytes are refined by the group of what follows h bytes later, h doubles,
    and suffixes that are alone in their group are not touched again.
    """
    n = len(data)
    key = np.zeros(n, np.int64)
    depth = 7  # digits to base 257, 0 for "ended", fit into 63 bits
    for k in range(depth):
        key *= 257
        key[: max(0, n - k)] += data[k:].astype(np.int64) + 1
    order = np.argsort(key)
    found = key[order]
    fresh = np.r_[True, found[1:] != found[:-1]] if n else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    rank = np.empty(n, np.int64)
    rank[order] = start
    alone = fresh & np.r_[fresh[1:], True] if n else fresh
    open_ = np.flatnonzero(~alone)
    while len(open_):
        own = order[open_]
        later = own + depth
        key = start[open_] * (n + 1) + np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[open_] = own
        fresh = np.r_[True, key[1:] != key[:-1]]
        start[open_] = np.maximum.accumulate(np.where(fresh, open_, 0))
        rank[own] = start[open_]
        open_ = open_[~(fresh & np.r_[fresh[1:], True])]
        depth *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in ``order`` (first: 0).

    Kasai: in text order the length shrinks by one at most from suffix to suffix. The text is cut into lanes of equal
    length that walk side by side.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.zeros(n + 16, np.uint64)
    padded[:n] = data
    words = np.zeros(n + 8, np.uint64)  # the eight bytes from each place on, the first one lowest
    for k in range(8):
        words |= padded[k:k + n + 8] << np.uint64(8 * k)
    lanes = min(_LANES, n)
    length = -(-n // lanes)
    at = np.arange(lanes, dtype=np.int64) * length
    held, out = np.zeros(lanes, np.int64), np.zeros(n, np.int64)
    for step in range(length):
        i = at + step
        lane = np.flatnonzero(i < n)
        i = i[lane]
        j = before[i]
        h = np.where(j >= 0, np.maximum(held[lane] - 1, 0), 0)
        going = np.flatnonzero(j >= 0)
        while len(going):
            left, right = i[going] + h[going], j[going] + h[going]
            differ = words[left] ^ words[right]
            equal = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3)
            room = n - np.maximum(left, right)
            h[going] += np.minimum(equal, room)
            going = going[(equal == 8) & (room > 8)]
        held[lane] = h
        out[i] = h
    return out[order]
