"""Deep-shallow sorting of bounded suffixes, in numpy.

Suffixes are sorted by ``DEPTH`` bytes. Down to ``SHALLOW`` bytes this is a
multikey quicksort over symbols of eight bytes: each round orders the members
of every group by one symbol and splits the groups. What still ties goes into
blind tries, one for each group, grown level by level for all groups at once:
a member is compared with its group's first, and where they part only the
depth and the one byte there are kept as its branch.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16


def symbols(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one big-endian number."""
    x = np.concatenate([buffer, np.zeros(8, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        x[:-width] = x[:-width] << np.uint64(8 * width) | x[width:]
    return x[:len(buffer)]


def _split(group: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """New group numbers of rows in order: a row opens a group where any key
    or its old group changes."""
    first = np.zeros(len(group), bool)
    for key in (group, *keys):
        first[1:] |= key[1:] != key[:-1]
    return np.cumsum(first)


def _common(word: np.ndarray, a: np.ndarray, b: np.ndarray, start: int, depth: int) -> np.ndarray:
    """Bytes from ``start`` on that suffixes a and b share, counted up to depth."""
    out = np.full(len(a), depth, np.int64)
    open_ = np.arange(len(a))
    for at in range(start, depth, 8):
        differ = word[a[open_] + at] ^ word[b[open_] + at]
        found = differ != 0
        top = differ[found]
        zeros = np.zeros(len(top), np.int64)  # whole bytes that agree
        for shift in (32, 16, 8):
            free = top >> np.uint64(64 - shift) == 0
            zeros[free] += shift // 8
            top[free] <<= np.uint64(shift)
        out[open_[found]] = np.minimum(at + zeros, depth)
        open_ = open_[~found]
    return out


def sort_suffixes(buffer: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order ``starts`` by the ``depth`` bytes from each on (all inside the
    buffer). Returns (order, group): indices into starts, in order, and
    ascending numbers that are equal where all bytes are."""
    word = symbols(np.concatenate([buffer, np.zeros(depth, np.uint8)]))
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    for at in range(0, min(SHALLOW, depth), 8):
        symbol = word[starts[order] + at]
        if at + 8 > depth:
            symbol = symbol >> np.uint64(8 * (at + 8 - depth))
        by = np.lexsort((symbol, group))
        order, symbol = order[by], symbol[by]
        group = _split(group[by], symbol)
    if depth <= SHALLOW or not len(starts):
        return order, group
    return _blind_tries(word, starts, order, group, depth)


def _blind_tries(word, starts, order, group, depth):
    """Order the members of each group and split it to equality. A group's
    number is the place of its first member, so numbers stay ascending."""
    heads = np.concatenate(([True], group[1:] != group[:-1]))
    number = np.flatnonzero(heads)[np.cumsum(heads) - 1]
    place = np.arange(len(order))  # places of members whose group is still open
    while True:
        g = number[place]
        size = np.bincount(g, minlength=len(order))
        place = place[size[g] > 1]
        if not len(place):
            return order, number
        g = number[place]
        here = starts[order[place]]
        pivot = starts[order[g]]  # the first member of each group
        shared = _common(word, here, pivot, SHALLOW, depth)
        equal = shared == depth
        at = np.minimum(shared, depth - 1)
        byte, byte_of_pivot = (word[p + at] >> np.uint64(56) for p in (here, pivot))
        # branches below the pivot come shallow first, above it deep first, the pivot and its equals between
        branch = np.where(equal, depth, np.where(byte < byte_of_pivot, shared, 2 * depth - shared))
        byte = np.where(equal, 0, byte)
        by = np.lexsort((byte, branch, g))
        order[place] = order[place[by]]
        g, branch, byte, equal = g[by], branch[by], byte[by], equal[by]
        first = np.ones(len(g), bool)
        first[1:] = (g[1:] != g[:-1]) | (branch[1:] != branch[:-1]) | (byte[1:] != byte[:-1])
        number[place] = place[first][np.cumsum(first) - 1]
        place = place[~equal]
