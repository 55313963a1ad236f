"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column by column.

Round j inserts, for every string that is long enough, the symbol before its suffix of
length j: the rank of that suffix's own first symbol in the transform so far gives the
place. The common-prefix array follows from the same ranks: two neighbours that start
with symbol c share one symbol more than the smallest value between the two places of c
in the round before. Transform and common prefixes are streams that each round reads and
writes once from end to end; a collection is bounded by the caller, so they are buffers.

Symbols are integers in any order. `shared_starts` takes BLOCK bytes for a symbol and
enters each string BLOCK times, each time ending a byte earlier, so that every byte
starts a suffix and there are only a few dozen rounds.
"""

from __future__ import annotations

import numpy as np

from scorebook.llm.words import BASE_INV, mix, powers, prefix_sums

BLOCK = 16


def build(columns: np.ndarray, lens: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Transform and common prefixes (with the suffix before, at most `cap`) over all suffixes in sorted order.

    columns[j, i] is the symbol of string i that is j places from its right end, 0 behind its lens[i] symbols.
    The empty suffixes come first, by string; equal suffixes are in no particular order."""
    m = len(lens)
    depth = int(lens.max()) if m else 0
    symbols = columns[0].astype(np.int64)
    common = np.zeros(m, np.uint16)
    active = np.flatnonzero(lens > 0)
    place = active.copy()  # of each active string's last suffix
    for j in range(1, depth + 1):
        n = len(symbols)
        order, rank, ended = _ranks(symbols)
        r, c = rank[place], symbols[place]
        new = m - ended + r
        # neighbours that start with the same symbol
        left = order[np.maximum(r - 1, 0)]
        has_left = (r > 0) & (symbols[left] == c)
        right = order[np.minimum(r + 1, n - 1)]
        has_right = (r < n - 1) & (symbols[right] == c)
        least = _Least(common)
        lcp_left = least(left, place, has_left, cap)
        lcp_right = least(place, right, has_right, cap)
        old = np.ones(n + len(active), bool)
        old[new] = False
        symbols, common = _merged(symbols, columns[j][active], old, new), _merged(common, lcp_left, old, new)
        nxt = new[has_right] + 1  # the next suffix now follows the new one (or another new one, set above)
        fix = old[nxt]
        common[nxt[fix]] = lcp_right[has_right][fix]
        stay = lens[active] > j
        active, place = active[stay], new[stay]
    return symbols, common


def _ranks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Stable order of the symbols, the place of each in it, and how many strings have ended."""
    n = len(symbols)
    bits = max(1, (n - 1).bit_length())
    order = np.sort((symbols << bits) | np.arange(n)) & ((1 << bits) - 1)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    return order, rank, n - int(np.count_nonzero(symbols))


def _merged(have: np.ndarray, add: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    out = np.empty(len(old), have.dtype)
    out[old] = have
    out[new] = add
    return out


class _Least:
    """Smallest values of stretches of an array, from the smallest of all stretches of 1, 2, 4, ... elements."""

    def __init__(self, x: np.ndarray):
        self.levels = [x]

    def __call__(self, a: np.ndarray, b: np.ndarray, use: np.ndarray, cap: int) -> np.ndarray:
        """1 + the smallest of x[a + 1 .. b] (at most `cap`) where `use`, else 0."""
        out = np.zeros(len(a), np.uint16)
        rows = np.flatnonzero(use)
        if not len(rows):
            return out
        lo, size = a[rows] + 1, b[rows] - a[rows]
        level = np.frexp(size.astype(np.float64))[1] - 1
        while len(self.levels) <= int(level.max()):
            x, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(x[:-half], x[half:]))
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            x = self.levels[k]
            out[rows[at]] = np.minimum(np.minimum(x[lo[at]], x[lo[at] + size[at] - (1 << int(k))]), cap - 1) + 1
        return out


def shared_starts(strings: list[bytes], length: int, block: int = BLOCK) -> list[np.ndarray]:
    """Per string, the starts of its `length`-byte substrings that another string holds too. Blocks are compared by
    64-bit fingerprints."""
    if length % block:
        raise ValueError("the length must be a multiple of the block")
    sizes = np.array([len(s) for s in strings], np.int64)
    base = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(strings), np.uint8)
    at = np.arange(max(len(buf) - block + 1, 0))
    sums = prefix_sums(buf)
    with np.errstate(over="ignore"):
        grams = mix((sums[at + block] - sums[at]) * powers(BASE_INV, len(sums))[at])
    ids = np.unique(grams, return_inverse=True)[1] + 1
    text = np.repeat(np.arange(len(strings)), block)
    end = sizes[text] - np.tile(np.arange(block), len(strings))  # each copy's length in bytes
    lens = np.maximum(end // block, 0)
    depth = int(lens.max()) if len(lens) else 0
    start = end[None, :] - (np.arange(depth + 1)[:, None] + 1) * block
    columns = np.where(start >= 0, ids[np.clip(base[text] + start, 0, max(len(ids) - 1, 0))] if len(ids) else 0, 0)
    want = length // block
    symbols, common = build(columns, lens, want)
    none = np.zeros(0, np.int64)
    if depth < want:
        return [none for _ in strings]
    # walk each copy from its empty suffix to the long ones
    _, rank, _ = _ranks(symbols)
    place, active = np.arange(len(lens)), np.arange(len(lens))
    found = []
    for j in range(depth + 1):
        if j >= want:
            found.append((place, text[active], end[active] - j * block))
        stay = lens[active] > j
        place, active = rank[place[stay]], active[stay]
    place, owner, first = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(place)
    group = np.cumsum(common < want)[place[order]]  # suffixes that agree on `length` bytes
    owner, first = owner[order], first[order]
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    many = np.minimum.reduceat(owner, cut) != np.maximum.reduceat(owner, cut)
    hit = np.repeat(many, np.diff(np.append(cut, len(group))))
    owner, first = owner[hit], first[hit]
    order = np.lexsort((first, owner))
    edge = np.searchsorted(owner[order], np.arange(len(strings) + 1))
    return [first[order[edge[i]:edge[i + 1]]] for i in range(len(strings))]
