"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai's common prefixes, binary search."""

from __future__ import annotations

import numpy as np

WORD = 8


def words(data: np.ndarray, spare: int) -> np.ndarray:
    """At each position the next eight bytes as a big-endian number (zeros beyond the end)."""
    padded = np.concatenate([data, np.zeros(spare + WORD, np.uint8)])
    out = np.zeros(len(data) + spare, np.uint64)
    for k in range(WORD):
        out = (out << np.uint64(8)) | padded[k:k + len(out)]
    return out


def suffix_array(at: np.ndarray, n: int) -> np.ndarray:
    """Starts of the n suffixes in order; ``at``: :func:`words` of the text.

    Suffixes in order of their first h bytes are in groups of equal ones.  Each is refined by the
    group of what follows h bytes later, which doubles h (Larsson and Sadakane); groups of one are
    sorted and left alone.
    """
    # Seven bytes, then how many bytes are left, so that the end sorts before any byte.
    h = WORD - 1
    left = np.minimum(n - np.arange(n), WORD).astype(np.uint64)
    key = (at[:n] & ~np.uint64(0xFF)) | left
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.concatenate(([True], key[1:] != key[:-1])) if n else np.zeros(0, bool)
    rank = np.full(n + 1, -1, np.int64)  # place of the group's first member
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while True:
        alone = head & np.concatenate((head[1:], [True]))
        places = np.flatnonzero(~alone)
        if not len(places):
            return order
        members = order[places]
        group = rank[members]
        after = rank[np.minimum(members + h, n)]
        # By group, then what follows; members of a group stand together already.
        by = np.argsort(group * (n + 2) + after + 1, kind="stable")
        members, group, after = members[by], group[by], after[by]
        order[places] = members
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
        head[places] = new
        rank[members] = np.maximum.accumulate(np.where(new, places, 0))
        h *= 2


def _same_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes that two arrays of words have in common."""
    x = a ^ b
    same = np.full(len(x), WORD)
    for k in range(WORD):
        same -= x >= np.uint64(1 << (8 * k))
    return same


def common_prefixes(at: np.ndarray, order: np.ndarray, limit: int, block: int = 512) -> np.ndarray:
    """For each place in the suffix array, the bytes its suffix shares with the one before (0 for
    the first), up to ``limit``.  ``at``: :func:`words` with ``limit`` spare positions or more.

    Kasai's method goes through the text in order: the next suffix shares at least one byte less
    than the last.  Here blocks of the text go side by side, each at its own pace: in a round it
    compares a word and either goes on with the next word or with the next suffix.  So a long
    prefix in one block doesn't keep the others waiting, and there are hardly more rounds than
    positions in a block, however short the text.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    i = np.arange(0, n, block)
    ends = np.minimum(i + block, n)
    length = np.zeros(len(i), np.int64)
    while len(i):
        j = before[i]
        most = np.where(j < 0, 0, np.minimum(limit, n - np.maximum(i, j)))
        same = _same_bytes(at[i + length], at[j + length])
        length = np.minimum(length + same, most)
        shared[i] = length
        over = (same < WORD) | (length >= most)
        i = i + over
        length = np.maximum(length - over, 0)
        left = i < ends
        if not left.all():
            i, ends, length = i[left], ends[left], length[left]
    return shared[order]


def _before(at: np.ndarray, a: np.ndarray, bt: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each string of ``size`` bytes at a sorts before that at b, and whether they are equal."""
    less, equal = np.zeros(len(a), bool), np.ones(len(a), bool)
    open_ = np.arange(len(a))
    for k in range(0, size, WORD):
        x, y = at[a[open_] + k], bt[b[open_] + k]
        if size - k < WORD:
            drop = np.uint64(8 * (WORD - size + k))
            x, y = x >> drop, y >> drop
        differ = x != y
        less[open_[differ]] = x[differ] < y[differ]
        equal[open_[differ]] = False
        open_ = open_[~differ]
        if not len(open_):
            break
    return less, equal


def found_in(at: np.ndarray, starts: np.ndarray, other: np.ndarray, other_order: np.ndarray, size: int) -> np.ndarray:
    """Which strings of ``size`` bytes of one shard occur among the sorted strings of another."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(other_order))
    found = np.zeros(len(starts), bool)
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        less, equal = _before(other, other_order[middle], at, starts[open_], size)
        found[open_[equal]] = True
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[~equal]
        open_ = open_[low[open_] < high[open_]]
    return found


def repeated_strings(items: list[bytes], size: int, chunk_bytes: int) -> list[np.ndarray]:
    """For each item, which of its strings of ``size`` bytes (by start) occur at another place in
    the items.  Items go in chunks (shards) of bounded size, each with a suffix array; what isn't
    repeated in its own chunk is looked up in the others by binary search."""
    chunks: list[list[int]] = []
    room = 0
    for k, item in enumerate(items):
        if not chunks or room < len(item):
            chunks.append([])
            room = max(chunk_bytes, len(item))
        chunks[-1].append(k)
        room -= len(item)
    sorted_chunks = []
    out: list[np.ndarray] = [np.zeros(max(0, len(x) - size + 1), bool) for x in items]
    for chunk in chunks:
        sizes = np.array([len(items[k]) for k in chunk], np.int64)
        data = np.frombuffer(b"".join(items[k] for k in chunk), np.uint8)
        at = words(data, size + WORD)
        order = suffix_array(at, len(data))
        prefixes = common_prefixes(at, order, size)
        # Only strings that end within their item count; what two of those share is the least of
        # the common prefixes on the way from one to the other.
        inside = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data)) >= size
        places = np.flatnonzero(inside[order])
        strings = order[places]
        repeated = np.zeros(len(data), bool)
        if len(places) > 1:
            same = np.minimum.reduceat(prefixes, places[:-1] + 1)
            # The last segment would run on to the end of the array: cut it at the last string.
            same[-1] = prefixes[places[-2] + 1:places[-1] + 1].min()
            same = same >= size
            repeated[strings[1:][same]] = True
            repeated[strings[:-1][same]] = True
        sorted_chunks.append((chunk, sizes, at, strings, repeated))
    for a, (_, _, at, strings, repeated) in enumerate(sorted_chunks):
        for b, (_, _, other, other_strings, _) in enumerate(sorted_chunks):
            left = strings[~repeated[strings]]
            if a != b and len(left):
                repeated[left[found_in(at, left, other, other_strings, size)]] = True
    for chunk, sizes, _, _, repeated in sorted_chunks:
        for k, start in zip(chunk, (np.cumsum(sizes) - sizes).tolist()):
            out[k] = repeated[start:start + len(out[k])]
    return out
