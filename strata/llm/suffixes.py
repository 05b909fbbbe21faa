"""A suffix array of byte strings by two-stage sorting.

Suffixes smaller than their successors are sorted directly; all others follow
from one scan over the buckets of first bytes, since such a suffix is its first
byte before a suffix that is already in place.  Strings end in a byte below all
others, and order is exact to ``depth`` bytes.
"""

from __future__ import annotations

import numpy as np

from .words import powers, random64


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All strings as one array of 1..256 with a 0 after each, and their starts."""
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if strings else np.empty(0, np.int64)
    text = np.zeros(int(sizes.sum()), np.uint16)
    body = np.ones(len(text), bool)
    body[starts + sizes - 1] = False
    text[body] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    return text, starts


def eights(text: np.ndarray) -> np.ndarray:
    """At each place, the next seven symbols as one number (nine bits each)."""
    padded = np.concatenate([text, np.zeros(8, text.dtype)]).astype(np.uint64)
    key = np.zeros(len(text), np.uint64)
    for i in range(7):
        key = key << np.uint64(9) | padded[i : i + len(text)]
    return key


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a byte later (ends of strings count as such)."""
    n = len(text)
    after = np.append(text[1:], np.uint16(0))
    differs = np.where(text != after, np.arange(n), n)
    change = np.minimum(np.minimum.accumulate(differs[::-1])[::-1], n - 1)
    return (text[change] < after[change]) | (text == 0)


def prefix_hashes(text: np.ndarray, depth: int) -> np.ndarray:
    """A 64-bit hash of the next ``depth`` symbols at each place (fewer at the end)."""
    n = len(text)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(random64(257, 31)[text] * powers(n), out=sums[1:])
        ends = np.minimum(np.arange(n) + depth, n)
        return (sums[ends] - sums[:n]) * powers(n, inverse=True)


def direct_sort(key: np.ndarray, whole: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in order of the suffixes there, by seven symbols at a time;
    only ties whose next ``depth`` symbols (``whole``) differ go on."""
    order = places[np.argsort(key[places])]
    group = np.concatenate([[0], np.cumsum(key[order[1:]] != key[order[:-1]])]) if len(order) else order
    for d in range(7, depth, 7):
        unlike = (group[1:] == group[:-1]) & (whole[order[1:]] != whole[order[:-1]])
        going = np.zeros(int(group[-1]) + 1 if len(group) else 0, bool)
        going[group[1:][unlike]] = True
        at = np.flatnonzero(going[group])
        if not len(at):
            break
        further = order[at] + d
        own = np.where(further < len(key), key[np.minimum(further, len(key) - 1)], np.uint64(0))
        turn = np.lexsort((own, group[at]))
        order[at], own = order[at[turn]], own[turn]
        new = np.zeros(len(order), np.int64)
        new[at[1:]] = (own[1:] != own[:-1]) & (group[at[1:]] == group[at[:-1]])
        group = group + np.cumsum(new)
    return order


def suffix_array(text: np.ndarray, key: np.ndarray, depth: int) -> np.ndarray:
    """All places of ``text`` in order of their suffixes, exact to ``depth`` symbols."""
    n = len(text)
    direct = smaller_than_next(text)
    rank = np.full(n, -1, np.int64)
    ends = np.flatnonzero(text == 0)
    rank[ends] = np.arange(len(ends))
    order, filled = [ends], len(ends)

    sorted_s = direct_sort(key, prefix_hashes(text, depth), np.flatnonzero(direct & (text > 0)), depth)
    s_bounds = np.searchsorted(text[sorted_s], np.arange(1, 258))
    rest = np.flatnonzero(~direct)
    rest = rest[np.argsort(text[rest], kind="stable")]
    l_bounds = np.searchsorted(text[rest], np.arange(1, 258))
    after = np.append(text[1:], np.uint16(0))
    for c in range(1, 257):
        own = rest[l_bounds[c - 1] : l_bounds[c]]
        if len(own):  # those before a smaller byte, in its order; then each run a byte longer
            layer = own[after[own] < c]
            layer = layer[np.argsort(rank[layer + 1], kind="stable")]
            while len(layer):
                rank[layer] = filled + np.arange(len(layer))
                order.append(layer)
                filled += len(layer)
                before = layer[layer > 0] - 1
                layer = before[text[before] == c]
        own = sorted_s[s_bounds[c - 1] : s_bounds[c]]
        rank[own] = filled + np.arange(len(own))
        order.append(own)
        filled += len(own)
    return np.concatenate(order)


def adjacent_prefixes(key: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix of ``order`` and the one before it, up to
    ``depth`` symbols (in steps of seven, the last step exact)."""
    lcp, going = np.zeros(max(0, len(order) - 1), np.int64), np.ones(max(0, len(order) - 1), bool)
    for d in [*range(0, depth - 7, 7), depth - 7]:
        a, b = order[1:][going] + d, order[:-1][going] + d
        same = key[np.minimum(a, len(key) - 1)] == key[np.minimum(b, len(key) - 1)]
        going[np.flatnonzero(going)[~same]] = False
        lcp[going] = d + 7
    return lcp
