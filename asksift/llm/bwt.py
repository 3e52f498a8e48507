"""Repeated substrings of a fixed length by interval expansion on a BWT.

``repeats_of_length`` builds the suffix order of a text to the length asked
for, takes its Burrows-Wheeler transform, and finds common-prefix boundaries
breadth first: an interval of rows that share a prefix w of length l is extended
backwards by each symbol c that precedes it, which gives the interval of cw.
Where cw's interval begins or ends inside a longer one, the rows there have a
common prefix of exactly l, so boundaries come out by increasing value, and the
expansion stops when l reaches the length asked for. Rows between two
boundaries then share at least that many symbols.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, length: int) -> np.ndarray:
    """Suffix positions sorted by their first ``length`` symbols at least, by
    prefix doubling; 0 is the least symbol and ends every string."""
    n = len(text)
    rank = text.astype(np.int64)
    # Pack several symbols into the first key.
    packed, width = rank.copy(), 1
    for j in range(1, 7):
        packed = packed << 8
        packed[: max(0, n - j)] |= rank[j:]
        width += 1
    order = np.argsort(packed)
    while True:
        key = packed[order]
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = key[1:] != key[:-1]
        ranks = np.empty(n, np.int64)
        ranks[order] = np.cumsum(new)
        if width >= length or ranks[order[-1]] == n - 1:
            return order
        follow = np.zeros(n, np.int64)
        follow[: max(0, n - width)] = ranks[width:] + 1
        packed = ranks * (n + 1) + follow
        order = np.argsort(packed)
        width *= 2


def repeats_of_length(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order of a text, and for each row whether a new class begins
    there: rows of one class share their first ``length`` symbols.

    ``text`` is a string of symbols 1..255 that ends with 0, with 0 between its
    parts; a common prefix never runs over a 0.
    """
    n = len(text)
    order = suffix_order(text, length)
    bwt = text[order - 1]
    # Row of cw for the row of w that c precedes: symbols keep their order.
    by_symbol = np.argsort(bwt, kind="stable")
    row_after = np.empty(n, np.int64)
    row_after[by_symbol] = np.arange(n)
    starts = np.searchsorted(bwt[by_symbol], np.arange(257))
    boundary = np.zeros(n + 1, bool)
    boundary[[0, n]] = True
    # Level 0 is one interval of all rows; level 1 has one per symbol. Rows of
    # the end mark are all classes of their own.
    boundary[: starts[1] + 1] = True
    boundary[starts[1:257]] = True
    begins = np.unique(starts[1:256])
    begins = begins[begins < n]
    ends = np.append(begins[1:], n) if len(begins) else begins
    level = 1
    while level < length and len(begins):
        # Only intervals of several rows can hold a longer repeat's boundary;
        # the others' extensions are single rows, whose edges are set by the
        # intervals around them.
        sizes = ends - begins
        rows = np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        owner = np.repeat(np.arange(len(begins)), sizes)
        symbol = bwt[rows]
        inside = symbol != 0
        rows, owner, symbol = rows[inside], owner[inside], symbol[inside]
        target = row_after[rows]
        key = owner * 256 + symbol
        by_key = np.argsort(key, kind="stable")
        key, target = key[by_key], target[by_key]
        head = np.ones(len(key), bool)
        head[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(head)
        new_begins = target[at]
        new_ends = new_begins + np.diff(np.append(at, len(key)))
        fresh = ~boundary[new_begins] | ~boundary[new_ends]
        boundary[new_begins] = True
        boundary[new_ends] = True
        begins, ends = new_begins[fresh], new_ends[fresh]
        level += 1
    return order, boundary[:n]
