"""Long repeats inside a bounded text, from its Burrows-Wheeler transform."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Parts strings from each other; no byte of UTF-8 has this value.
END = 0xFF


#: Bits of a place in the packed sort keys; two ranks take as many each.
_PLACE = 22


def _sorted_places(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places by ascending ``key`` of so many bits, and the keys in that order."""
    n = len(key)
    if bits > 64 - _PLACE or n > 1 << _PLACE:
        order = np.argsort(key)
        return order, key[order]
    packed = np.sort((key << np.uint64(_PLACE)) | np.arange(n, dtype=np.uint64))  # far quicker than an argsort
    return (packed & np.uint64((1 << _PLACE) - 1)).astype(np.int64), packed >> np.uint64(_PLACE)


def bounded_suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``data`` sorted by the ``depth`` bytes from there; in any order where these are equal."""
    n = len(data)
    used = np.bincount(data, minlength=256) > 0
    used[END] = True
    symbol = (np.cumsum(used) - 1).astype(np.uint64)
    width = max(1, int(symbol[END]).bit_length())
    known = (64 - _PLACE - 1) // width
    padded = np.concatenate([symbol[data], np.full(known, symbol[END])])
    key, bits = np.zeros(n, np.uint64), known * width
    for k in range(known):
        key = (key << np.uint64(width)) | padded[k : k + n]
    while True:
        order, own = _sorted_places(key, bits)
        steps = np.cumsum(np.concatenate([[False], own[1:] != own[:-1]]))
        if known >= depth or steps[-1] == n - 1:
            return order
        rank = np.empty(n + depth, np.uint64)
        rank[order] = steps
        rank[n:] = steps[-1] + 1
        half = int(steps[-1] + 1).bit_length()
        step = min(known, depth - known)
        key, bits = (rank[:n] << np.uint64(half)) | rank[step : step + n], 2 * half
        known += step


def _sorted_within(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The 32-bit values sorted inside each group; the groups are numbered in order."""
    return (np.sort((group << 32) | values) & 0xFFFFFFFF).astype(np.int32)  # one sort of packed keys, not two of places


def common_prefixes_below(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether the suffixes at ``order[r - 1]`` and ``order[r]`` share less than ``depth`` bytes, for r from 0 to n.

    Breadth-first backward extension: the interval of a string among the sorted
    suffixes becomes the intervals of that string with a byte put before it.  The
    first interval to end at a place tells the prefix its two neighbours share, the
    length of the string before it grew, so values come out in increasing order; an
    interval whose end is known need not grow.  Growth stops at ``depth``: what is
    unknown then shares at least as much.  Strings never grow over an end mark.
    """
    n = len(data)
    before = data[order - 1]
    by_byte = np.argsort(before, kind="stable")
    forward = np.empty(n, np.int32)
    forward[by_byte] = np.arange(n, dtype=np.int32)
    same = before[by_byte[1:]] == before[by_byte[:-1]]
    previous, following = np.full(n, -1, np.int32), np.full(n, n, np.int32)
    previous[by_byte[1:][same]] = by_byte[:-1][same]
    following[by_byte[:-1][same]] = by_byte[1:][same]

    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.array([0], np.int32), np.array([n - 1], np.int32)
    for _ in range(depth):
        if not len(low):
            break
        single = low == high
        at = low[single]
        at = forward[at[before[at] != END]]
        size = (high - low + 1)[~single]
        of = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(of)) + np.repeat(low[~single] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) else of
        real = before[inside] != END
        first = real & (previous[inside] < np.repeat(low[~single], size))
        last = real & (following[inside] > np.repeat(high[~single], size))
        starts, ends = (_sorted_within(of[some], forward[inside[some]]) for some in (first, last))
        low, high = np.concatenate([at, starts]), np.concatenate([at, ends])
        new = ~known[high + 1]
        low, high = low[new], high[new]
        known[high + 1] = True
    return known


def repeated_windows(strings: Sequence[bytes], length: int) -> list[np.ndarray]:
    """For each string, whether the ``length`` bytes from each place also start elsewhere in the strings."""
    mark = bytes([END])
    data = np.frombuffer(mark.join([*strings, b""]), np.uint8)
    order = bounded_suffix_order(data, length)
    below = common_prefixes_below(data, order, length)
    shared = ~below[:-1] | ~below[1:]
    found = np.empty(len(data), bool)
    found[order] = shared
    out, start = [], 0
    for string in strings:
        out.append(found[start : start + max(0, len(string) - length + 1)])
        start += len(string) + 1
    return out
