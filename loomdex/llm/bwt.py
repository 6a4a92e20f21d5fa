"""Repeated strings of at least a given length in one block, by interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

from loomdex.llm.common import ranges


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes in the order of their first ``depth`` symbols, by doubling of sorted prefixes.

    Symbols fit in a byte. A round sorts only what the rounds before left tied.
    """
    n = len(symbols)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = symbols
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : n + k]
    order = np.argsort(key).astype(np.int32)  # a block has far less than 2^31 symbols
    rank = np.empty(n, np.int32)

    def number(places: np.ndarray, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rank places, given in order, by the row where their key begins; returns which rows are tied."""
        new = np.r_[True, keys[1:] != keys[:-1]]
        head = np.flatnonzero(new)
        size = np.diff(np.r_[head, len(keys)])
        rank[places] = np.repeat(first[head], size)
        return np.repeat(size > 1, size)

    tied = number(order, key[order], np.arange(n, dtype=np.int32))
    del key
    rows, width = np.flatnonzero(tied).astype(np.int32), 8
    while len(rows) and width < depth:
        places = order[rows]
        after = places + width
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        pair = (rank[places].astype(np.int64) << 32) | follow
        by = np.argsort(pair)
        order[rows] = places = places[by]  # rows of one tied group are adjacent, and so stay its own
        tied = number(places, pair[by], rows)
        rows, width = rows[tied], width * 2
    return order


def unset_prefixes(symbols: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each row of ``order``: shares it at least ``least`` symbols with the row before, none of them 0?

    Breadth-first backward extension: from the interval of the empty string, each interval of a string w
    is extended by every symbol c that the transform has in it. If the row after the interval of cw has no
    value yet, its common prefix is len(w), and cw is expanded later. Values are thus found in
    increasing order, and the search stops at ``least``: rows without a value share that many symbols.
    Rows next to a suffix that meets a 0 within ``least`` symbols have no meaning; the caller skips them.
    """
    n = len(symbols)
    transform = symbols[order - 1]  # the place before 0 is the last: the text is taken as a circle
    by = np.argsort(transform, kind="stable").astype(np.int32)
    step = np.empty(n, np.int32)
    step[by] = np.arange(n, dtype=np.int32)  # from a row to the row of the suffix one symbol longer
    same = transform[by[1:]] == transform[by[:-1]]
    before, after = np.full(n, -1, np.int32), np.full(n, n, np.int32)
    before[by[1:][same]] = by[:-1][same]
    after[by[:-1][same]] = by[1:][same]
    del by, same
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        if not len(low):
            break
        width = high - low
        at = ranges(low, width)
        symbol = transform[at] != 0
        first = at[(before[at] < np.repeat(low, width)) & symbol]
        last = at[(after[at] >= np.repeat(high, width)) & symbol]
        low, high = np.sort(step[first]), np.sort(step[last]) + 1  # intervals are disjoint: they pair up in order
        new = unset[high]
        low, high = low[new], high[new]
        unset[high] = False
    return unset[:n]


def repeated_starts(symbols: np.ndarray, room: np.ndarray, least: int) -> np.ndarray:
    """True where a string of ``least`` symbols starts that also starts elsewhere.

    ``symbols`` are 1 to 255 and 0 after each string; ``room`` counts the symbols up to the next 0.
    """
    if not len(symbols):
        return np.zeros(0, bool)
    order = suffix_order(symbols, least + 1)
    long = room[order] >= least
    shared = unset_prefixes(symbols, order, least)
    shared[1:] &= long[1:] & long[:-1]
    shared[0] = False
    shared[:-1] |= shared[1:]
    out = np.zeros(len(symbols), bool)
    out[order[shared]] = True
    return out
