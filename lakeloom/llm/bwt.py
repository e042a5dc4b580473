"""Common prefixes on a Burrows-Wheeler transform, by increasing value up to a threshold."""

from __future__ import annotations

import numpy as np


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the keys, and the rank of each (equal keys share one)."""
    order = np.argsort(keys)
    new = np.empty(len(keys), np.int64)
    new[0] = 0
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(len(keys), np.uint64)
    rank[order] = np.cumsum(new).astype(np.uint64)
    return order, rank


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols (uint8; the text ends in zeros), by
    doubling the length that ranks cover."""
    padded = np.concatenate([symbols, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(symbols)]
    keys = np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64)
    covered = min(8, depth)
    if covered < 8:
        keys >>= np.uint64(8 * (8 - covered))
    order, rank = _ranks(keys)
    while covered < depth:  # a key holds as many ranks as fit, the last of which may overlap
        bits = int(rank[order[-1]] + np.uint64(1)).bit_length()
        key = rank
        for part in range(1, max(2, 64 // bits)):
            step = min(part * covered, depth - covered)
            later = np.zeros(len(rank), np.uint64)
            later[:max(0, len(rank) - step)] = rank[step:] + np.uint64(1)
            key = key << np.uint64(bits) | later
            if step == depth - covered:
                break
        covered += step
        order, rank = _ranks(key)
    return order


def bounded_prefixes(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): suffixes in order, and how many symbols each has in common with the one
    before it, where that is below ``depth``; else ``depth``.

    Intervals of the transform are extended backwards by one symbol, breadth first.  An interval
    of strings of length l begins where the common prefix is below l; extending it by a symbol
    takes its first occurrence in the interval to where the extended interval begins.  So with
    all values up to l known, a suffix gets l + 1 if a beginning lies between its symbol's last
    occurrence before it and its own.  What is left after ``depth`` rounds has ``depth`` symbols
    in common at least."""
    n = len(symbols)
    order = suffix_order(symbols, depth)
    transform = symbols[order - 1]
    source = np.argsort(transform, kind="stable").astype(np.int32)  # LF mapping, inverted
    lcp = np.full(n, depth, np.int16)
    first = np.ones(n, bool)
    first[1:] = transform[source[1:]] != transform[source[:-1]]
    lcp[first] = 0
    begins = first.copy()
    left = np.flatnonzero(~first).astype(np.int32)
    low, high = source[left - 1], source[left]
    beside = low + 1 == high  # where the symbol stands twice in a row, one place decides
    near, near_high = left[beside], high[beside]
    far, low, high = left[~beside], low[~beside], high[~beside]
    for length in range(1, depth):
        met = begins[near_high]
        new = near[met]
        near, near_high = near[~met], near_high[~met]
        if len(far):
            seen = np.cumsum(begins, dtype=np.int32)
            met = seen[high] > seen[low]
            new = np.concatenate((new, far[met]))
            far, low, high = far[~met], low[~met], high[~met]
        if not len(new):
            break
        lcp[new] = length
        begins[new] = True
    return order, lcp


def least_owner(strings: list[bytes], owners: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``depth`` bytes of every string, in order, the least owner of a
    string that holds it; and where each string's windows begin."""
    joined = np.frombuffer(b"\0".join([*strings, b""]), np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    # numbers for the bytes that occur; zero is for the ends of strings, also if a text has zeros
    inside = np.ones(len(joined), bool)
    inside[ends] = False
    present = np.zeros(256, bool)
    present[joined[inside]] = True
    if present.all():
        raise ValueError("one byte value must be free; UTF-8 leaves thirteen")
    number = np.zeros(256, np.uint8)
    number[present] = np.arange(1, present.sum() + 1)
    symbols = np.where(inside, number[joined], 0).astype(np.uint8)
    order, lcp = bounded_prefixes(symbols, depth)
    counts = np.maximum(sizes - depth + 1, 0)
    firsts = np.cumsum(counts) - counts
    place = np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(firsts, counts)
    owner = np.full(len(symbols), np.iinfo(np.int64).max)
    owner[place] = np.repeat(owners, counts)
    groups = np.flatnonzero(lcp < depth)
    least = np.minimum.reduceat(owner[order], groups)
    found = np.empty(len(symbols), np.int64)
    found[order] = np.repeat(least, np.diff(np.append(groups, len(symbols))))
    return found[place], firsts
