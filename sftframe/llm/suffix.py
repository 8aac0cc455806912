"""Suffix arrays by induced sorting, and permuted common prefixes, as array operations of one shard.

Suffixes are of type S if smaller than the next suffix, else of type L; a leftmost S suffix (LMS) follows an L one.
The substrings between LMS places are sorted and named; the string of names is sorted by recursion; and the order
of all suffixes is induced from that of the LMS suffixes.  For byte strings the induction is the linear scan of the
buckets, a bucket at a time.  In the recursion the alphabet is large, so suffixes are sorted by their symbols up to
the next LMS place and then by its rank, which gives the same order.
"""

from __future__ import annotations

import numpy as np

_SMALL_ALPHABET = 1024
_KEY_BITS = 62


def _types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; the end of the string counts as smaller than any symbol."""
    n = len(s)
    step = np.empty(n, np.int8)
    step[:-1] = np.sign(np.diff(s.astype(np.int64, copy=False))).astype(np.int8)
    step[-1] = -1
    known = np.flatnonzero(step)
    return np.repeat(step[known] > 0, np.diff(known, prepend=-1))


def _by_symbols(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, tail: np.ndarray | None):
    """Order and equality classes of the strings ``symbols[begin : end + 1]``, ties broken by ``tail``.

    As many symbols as fit into a 62-bit key are compared at a time; later rounds see only what is still tied.
    """
    bits = int(symbols.max()).bit_length()
    per = max(1, _KEY_BITS // bits)

    def key(rows, at):
        value = np.zeros(len(rows), np.int64)
        first, last = begin[rows] + at, end[rows]
        for step in range(per):
            place = first + step
            value <<= bits
            value |= np.where(place <= last, symbols[np.minimum(place, last)], 0)
        return value

    rows = np.arange(len(begin))
    value = key(rows, 0)
    order = np.argsort(value, kind="stable")
    sorted_value = value[order]
    head = np.ones(len(order), bool)
    head[1:] = sorted_value[1:] != sorted_value[:-1]
    tied = ~head
    tied[:-1] |= ~head[1:]
    places = np.flatnonzero(tied)
    own = np.cumsum(head[places]) - 1
    at = per
    while len(places):
        rows = order[places]
        more = begin[rows] + at <= end[rows]
        if tail is None:
            open_groups = np.zeros(own[-1] + 1, bool)
            open_groups[own[more]] = True
            kept = open_groups[own]
            places, rows, more, own = places[kept], rows[kept], more[kept], own[kept]
            if not len(places):
                break
        # A string that is over among longer ones ends with the whole text and comes first.
        value = np.where(more, key(rows, at), 0 if tail is None else tail[rows])
        sub = np.lexsort((value, own))
        order[places] = rows[sub]
        value, own = value[sub], own[sub]
        change = np.ones(len(places), bool)
        change[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
        head[places] |= change
        tied = ~change
        tied[:-1] |= ~change[1:]
        places, own = places[tied], np.cumsum(change[tied]) - 1
        at += per
    return order, np.cumsum(head) - 1


def _sorted_lms(s: np.ndarray, is_s: np.ndarray) -> np.ndarray:
    """LMS places in the order of their suffixes."""
    places = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(places) < 2:
        return places
    symbols = s.astype(np.int64) * 2 + is_s
    end = np.append(places[1:], len(s) - 1)
    order, classes = _by_symbols(symbols, places, end, None)
    names = np.empty(len(places), np.int64)
    names[order] = classes + 1
    if classes[-1] + 1 == len(places):
        return places[order]
    return places[suffix_array(names)]


def _induce_buckets(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    n, size = len(s), int(s.max()) + 1
    counts = np.bincount(s, minlength=size)
    ends = np.cumsum(counts)
    heads = ends - counts
    symbol = s.astype(np.uint16)
    order = np.full(n, -1, np.int64)
    lms_counts = np.bincount(s[lms], minlength=size)
    lms_ends = np.cumsum(lms_counts)

    def place(block, wanted, slots, step):
        before = block - 1
        before = before[before >= 0]
        before = before[is_s[before] == wanted]
        if not len(before):
            return
        keys = symbol[before]
        sorting = np.argsort(keys, kind="stable")
        before, keys = before[sorting], keys[sorting]
        cuts = np.flatnonzero(np.diff(keys, prepend=-1))
        sizes = np.diff(np.append(cuts, len(keys)))
        within = np.arange(len(keys)) - np.repeat(cuts, sizes)
        first = keys[cuts]
        order[np.repeat(slots[first], sizes) + step * within] = before
        slots[first] += step * sizes

    slots = heads.copy()
    order[slots[s[n - 1]]] = n - 1
    slots[s[n - 1]] += 1
    l_ends = np.empty(size, np.int64)
    for c in np.flatnonzero(counts):
        at = heads[c]
        while at < slots[c]:
            block = order[at : slots[c]]
            at = slots[c]
            place(block, False, slots, 1)
        l_ends[c] = slots[c]
        if lms_counts[c]:
            place(lms[lms_ends[c] - lms_counts[c] : lms_ends[c]], False, slots, 1)
    slots = ends - 1
    for c in np.flatnonzero(counts)[::-1]:
        at = ends[c] - 1
        while at > slots[c]:
            block = order[slots[c] + 1 : at + 1][::-1].copy()
            at = slots[c]
            place(block, True, slots, -1)
        if l_ends[c] > heads[c]:
            place(order[heads[c] : l_ends[c]][::-1], True, slots, -1)
    return order


def _induce_by_rank(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    n = len(s)
    places = np.sort(lms)
    rank = np.empty(len(lms) + 1, np.int64)
    rank[np.searchsorted(places, lms)] = np.arange(1, len(lms) + 1)
    rank[-1] = 0
    begin = np.arange(n)
    following = np.searchsorted(places, begin, "right")
    end = np.append(places, n - 1)[following]
    order, _ = _by_symbols(s.astype(np.int64) * 2 + is_s, begin, end, rank[following])
    return order


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``s`` (symbols of 1 or more) in ascending order."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    is_s = _types(s)
    lms = _sorted_lms(s, is_s)
    if not len(lms):
        if not is_s.any():
            return np.arange(n - 1, -1, -1)
        lms = np.zeros(0, np.int64)
    if int(s.max()) < _SMALL_ALPHABET:
        return _induce_buckets(s, is_s, lms)
    return _induce_by_rank(s, is_s, lms)


def permuted_lcp(s: np.ndarray, order: np.ndarray, heads: np.ndarray, limit: int) -> np.ndarray:
    """For every place the length that its suffix shares with the one before it in the order, up to ``limit``.

    A value is computed only where it does not follow from the place before (a place whose left symbol differs
    from that of its neighbour's) and at ``heads``; from there it falls by one a place.  Values are exact below
    ``limit`` for places less than that far behind the last computed one.  ``s`` has one or two bytes a symbol.
    """
    n = len(s)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    computed = np.ones(n, bool)
    left = before[1:]
    computed[1:] = (left < 1) | (s[:-1] != s[np.maximum(left - 1, 0)])
    computed[heads] = True
    places = np.flatnonzero(computed)
    per = 8 // s.itemsize
    words = np.zeros(n + 16, s.dtype)
    words[:n] = s
    view = np.lib.stride_tricks.sliding_window_view(words, per)
    shared = np.zeros(len(places), np.int64)
    live = np.flatnonzero(before[places] >= 0)
    for at in range(0, limit, per):
        if not len(live):
            break
        a, b = places[live] + at, before[places[live]] + at
        inside = np.maximum(a, b) < n
        live, a, b = live[inside], a[inside], b[inside]
        unlike = view[a].view(np.uint64)[:, 0] ^ view[b].view(np.uint64)[:, 0]
        same = unlike == 0
        lowest = unlike[~same] & (~unlike[~same] + np.uint64(1))
        shared[live[~same]] += (np.log2(lowest.astype(np.float64)) // (64 // per)).astype(np.int64)
        shared[live[same]] += per
        live = live[same]
    shared = np.minimum(shared, np.maximum(n - np.maximum(places, before[places]), 0))
    head = np.zeros(n, np.int64)
    head[places] = np.arange(len(places))
    head = np.maximum.accumulate(head)
    return np.maximum(shared[head] - (np.arange(n) - places[head]), 0)
