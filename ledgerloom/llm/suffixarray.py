"""Suffix arrays of byte texts by induced sorting, in numpy.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The leftmost S
suffixes are sorted first, by their substrings; equal substrings get equal names, and where names are not
unique the string of names, at most half as long, is sorted by prefix doubling on whole arrays. The order of all
other suffixes is then induced in two linear scans. Over few symbols, as in bytes, a scan goes bucket by bucket on whole arrays: a
bucket's entries are known once all smaller ones are, except for runs of one symbol, which are taken one place
of the run at a time. Over many, or in short texts, it goes place by place.
"""

from __future__ import annotations

import numpy as np

# Places that the plain scans work off in the time that a bucket takes on arrays.
BUCKET_COST = 128


def _is_smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one, the end mark, is."""
    n = len(text)
    step = np.sign(np.diff(text)).astype(np.int8)
    # An equal neighbour has the type of the next place where the symbols differ.
    differs = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(differs[::-1])[::-1]
    smaller = np.ones(n, bool)
    inside = following < n
    smaller[:-1][inside] = step[following[inside]] > 0
    smaller[:-1][~inside] = False
    return smaller


def _induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the leftmost smaller ones (``seeds``) in order."""
    n = len(text)
    tails = np.cumsum(sizes)
    heads = tails - sizes
    order = np.full(n, -1, np.int64)
    # The seeds of a bucket stand at its end.
    seed_symbols = text[seeds]
    seed_counts = np.bincount(seed_symbols, minlength=len(sizes))
    seed_first = np.concatenate(([0], np.cumsum(seed_counts)))
    used = np.flatnonzero(sizes)
    larger_next = heads.copy()

    def deal(entries: np.ndarray, want_smaller: bool, next_place: np.ndarray, backward: bool) -> None:
        before = entries[entries > 0] - 1
        before = before[smaller[before] == want_smaller]
        if not len(before):
            return
        symbols = text[before]
        by = np.argsort(symbols, kind="stable")
        before, symbols = before[by], symbols[by]
        kinds, first, counts = np.unique(symbols, return_index=True, return_counts=True)
        rank = np.arange(len(before)) - np.repeat(first, counts)
        if backward:
            order[np.repeat(next_place[kinds], counts) - rank] = before
            next_place[kinds] -= counts
        else:
            order[np.repeat(next_place[kinds], counts) + rank] = before
            next_place[kinds] += counts

    for symbol in used:
        done = heads[symbol]
        while done < larger_next[symbol]:
            stop = larger_next[symbol]
            deal(order[done:stop], False, larger_next, False)
            done = stop
        mine = seeds[seed_first[symbol] : seed_first[symbol + 1]]
        if len(mine):
            deal(mine, False, larger_next, False)
    smaller_next = tails - 1
    for symbol in used[::-1]:
        done = tails[symbol] - 1
        while done > smaller_next[symbol]:
            stop = smaller_next[symbol]
            deal(order[stop + 1 : done + 1][::-1], True, smaller_next, True)
            done = stop
        larger = order[heads[symbol] : larger_next[symbol]]
        if len(larger):
            deal(larger[::-1], True, smaller_next, True)
    # The end mark is in no other suffix's left context within its bucket; it stands first.
    order[0] = n - 1
    return order


def _induce_one_by_one(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same in two plain scans, for texts with nearly as many symbols as places."""
    n, symbols = len(text), text.tolist()
    # The symbol before each place if that suffix is larger, or smaller, than this one; else -1. Free places
    # of the order hold 0, which has nothing before it.
    before = np.concatenate(([-1], text[:-1]))
    before_smaller = np.concatenate(([False], smaller[:-1]))
    larger_before = np.where(before_smaller, -1, before).tolist()
    smaller_before = np.where(before_smaller, before, -1).tolist()
    tails = np.cumsum(sizes)
    order = [0] * n
    tail = tails.tolist()
    for i in reversed(seeds.tolist()):
        c = symbols[i]
        tail[c] -= 1
        order[tail[c]] = i
    head = (tails - sizes).tolist()
    # A place is filled before the scan reads it.
    for i in order:
        c = larger_before[i]
        if c >= 0:
            place = head[c]
            order[place] = i - 1
            head[c] = place + 1
    # Every smaller suffix is dealt anew, from the right; a seed's place is filled before it is read.
    tail = tails.tolist()
    for i in reversed(order):
        c = smaller_before[i]
        if c >= 0:
            tail[c] = place = tail[c] - 1
            order[place] = i - 1
    order[0] = n - 1
    return np.array(order, np.int64)


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a string of positive names, in order, a suffix before those that it begins.

    As many names as a number holds are compared first; each round then doubles how far suffixes are told
    apart, by the ranks of what follows. Only suffixes that are still tied are sorted again.
    """
    n = len(names)
    bits = int(names.max()).bit_length()
    known = max(1, 62 // bits)
    padded = np.concatenate((names, np.zeros(known, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(known):
        key = (key << bits) | padded[k : k + n]
    # The order holds equal suffixes side by side; a rank is the place of the first of them, counted from 1.
    order, rank = np.arange(n), np.ones(n, np.int64)
    place = np.arange(n)
    while True:
        by = np.argsort(key)
        at, key = order[place][by], key[by]
        order[place] = at
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank[at] = place[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))] + 1
        place = place[~(new & np.append(new[1:], True))]
        if not len(place):
            return order
        after = order[place] + known
        key = rank[order[place]] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)], 0)
        known *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; ``text`` holds non-negative symbols and a single 0 at its end."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    text = text.astype(np.int32)
    smaller = _is_smaller(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(text)
    # A bucket costs the array version some steps whatever its size.
    induce = _induce if np.count_nonzero(sizes) * BUCKET_COST < n else _induce_one_by_one
    rough = induce(text, smaller, leftmost[np.argsort(text[leftmost], kind="stable")], sizes)
    is_left = np.zeros(n, bool)
    is_left[leftmost] = True
    sorted_left = rough[is_left[rough]]
    # Names: substrings up to the next leftmost smaller suffix, that one's first symbol included.
    number = np.full(n, -1, np.int64)
    number[leftmost] = np.arange(len(leftmost))
    ends = np.append(leftmost[1:], n - 1)
    mine = number[sorted_left]
    start, length = sorted_left, ends[mine] - sorted_left
    same = np.zeros(len(mine), bool)
    alike = np.flatnonzero(length[1:] == length[:-1]) + 1
    offset = 0
    while len(alike):
        alike = alike[text[start[alike] + offset] == text[start[alike - 1] + offset]]
        ended = length[alike] == offset
        same[alike[ended]] = True
        alike = alike[~ended]
        offset += 1
    names = np.empty(len(mine), np.int64)
    names[mine] = np.cumsum(~same)
    if len(mine) and names.max() < len(mine):
        sorted_left = leftmost[_by_doubling(names)]
    return induce(text, smaller, sorted_left, sizes)


def common_prefixes(text: np.ndarray, order: np.ndarray, longest: int) -> np.ndarray:
    """Permuted common prefixes: for each suffix, in text order, the length it shares with the one
    before it in ``order``, up to ``longest``. Eight symbols are compared at a time."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    wide = np.zeros(n + longest + 8, np.uint8)
    wide[:n] = text
    words = np.ndarray(len(wide) - 7, np.uint64, wide, strides=(1,)).copy()
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(before >= 0)
    other = before[live]
    for offset in range(0, longest, 8):
        differ = words[live + offset] ^ words[other + offset]
        alike = differ == 0
        # The lowest set bit tells how many bytes are alike; numbers are little-endian.
        ended = differ[~alike]
        low = ended & (~ended + np.uint64(1))
        shared[live[~alike]] = offset + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        live, other = live[alike], other[alike]
    shared[live] = longest
    return np.minimum(shared, longest)
