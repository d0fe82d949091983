"""Suffix order by induced sorting with queues that go to disk.

Suffixes are scanned in order; each puts its predecessor in the queue of the predecessor's first character.  A queue hands its entries
back in the order they came, which is their order among the suffixes of that character, so the queues together are a priority queue by
(character, rank of the suffix behind it).  Entries are handled in arrays: all suffixes known for a character at once, then those that
they induce for the same character, and so on.  A queue that holds more than `memory` bytes moves its arrays to an unnamed file.

The first induction orders the substrings between leftmost-smaller positions, which are then named; the shorter text of names is ordered
to the depth asked for by rank doubling; the second induction spreads its order over all suffixes.
"""

from __future__ import annotations

import tempfile

import numpy as np

from .common import powers

BASE = 0xA0761D6478BD642F


class Store:
    """One unnamed file of a task for arrays that queues don't keep in memory; it goes with the task."""

    def __init__(self, memory: int):
        self.memory, self.held, self.file = memory, 0, None

    def put(self, x: np.ndarray):
        if self.held + x.nbytes <= self.memory:
            self.held += x.nbytes
            return x
        self.file = self.file or tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(x.tobytes())
        return at, len(x), x.dtype

    def get(self, x) -> np.ndarray:
        if isinstance(x, np.ndarray):
            self.held -= x.nbytes
            return x
        self.file.seek(x[0])
        return np.frombuffer(self.file.read(x[1] * x[2].itemsize), x[2])

    def close(self):
        if self.file:
            self.file.close()


class Queues:
    def __init__(self, size: int, store: Store):
        self.of, self.store = [[] for _ in range(size)], store

    def push(self, positions: np.ndarray, chars: np.ndarray) -> None:
        if not len(positions):
            return
        order = np.argsort(chars, kind="stable")
        chars, positions = chars[order], positions[order]
        cut = np.flatnonzero(np.diff(chars)) + 1
        for c, part in zip(chars[np.concatenate([[0], cut])].tolist(), np.split(positions, cut)):
            self.of[c].append(self.store.put(part))

    def take(self, c: int) -> np.ndarray:
        parts, self.of[c] = [self.store.get(x) for x in self.of[c]], []
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _types(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next; the last is."""
    n = len(t)
    up = np.empty(n, np.int8)
    up[:-1] = np.sign(t[1:].astype(np.int32) - t[:-1])
    up[-1] = 1
    nearest = np.where(up != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    return up[nearest] > 0


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, size: int, memory: int) -> np.ndarray:
    """Order of all suffixes from that of the seeds (the leftmost-smaller positions)."""
    store = Store(memory)
    try:
        seeded, queues = Queues(size, store), Queues(size, store)
        seeded.push(seeds, t[seeds])
        larger: list = []
        for c in range(size):
            out, block = [], queues.take(c)
            while len(block):
                out.append(block)
                before = block[block > 0] - 1
                before = before[~small[before]]
                ch = t[before]
                queues.push(before[ch != c], ch[ch != c])
                block = before[ch == c]
            own = np.concatenate(out) if out else np.zeros(0, np.int32)
            larger.append(store.put(own))
            own = seeded.take(c)
            before = own[own > 0] - 1
            queues.push(before, t[before])
        queues = Queues(size, store)
        result, at = np.empty(len(t), np.int32), len(t)
        for c in range(size - 1, -1, -1):
            block = queues.take(c) if c else np.array([len(t) - 1], np.int32)
            while len(block):
                at -= len(block)
                result[at : at + len(block)] = block[::-1]
                if not c:
                    break
                before = block[block > 0] - 1
                before = before[small[before]]
                ch = t[before]
                queues.push(before[ch != c], ch[ch != c])
                block = before[ch == c]
            own = store.get(larger[c])
            at -= len(own)
            result[at : at + len(own)] = own
            own = own[::-1]
            before = own[own > 0] - 1
            before = before[small[before]]
            queues.push(before, t[before])
        return result
    finally:
        store.close()


def _tied(rank: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Those, listed in the order of their ranks, that share a rank; a rank is the number of smaller ones."""
    r = rank[some]
    same = r[1:] == r[:-1]
    return some[np.append(same, False) | np.concatenate([[False], same])] if len(some) else some


def suffix_order(text: np.ndarray, depth: int, memory: int = 64 << 20) -> np.ndarray:
    """Positions of text (values from 1) in the order of their suffixes; those that agree in `depth` values may be in any order."""
    t = np.append(text, 0).astype(np.uint16)
    n, size = len(t), int(t.max()) + 1
    small = _types(t)
    seeds = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    flag = np.zeros(n, bool)
    flag[seeds] = True
    order = _induce(t, small, seeds, size, memory)
    order = order[flag[order]]
    ends = np.append(seeds[1:], n - 1)  # each substring goes on to the next seed, included
    number = np.empty(n, np.int32)
    number[seeds] = np.arange(len(seeds))
    k = number[order]
    p, inverse = powers(BASE, n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((t.astype(np.uint64) + np.uint64(1)) * p, dtype=np.uint64)])
    sign = (total[ends[k] + 1] - total[seeds[k]]) * inverse[seeds[k]]
    new = np.ones(len(k), bool)
    new[1:] = (sign[1:] != sign[:-1]) | (ends[k][1:] - seeds[k][1:] != ends[k][:-1] - seeds[k][:-1])
    rank = np.empty(len(k), np.int64)
    rank[k] = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    deep = np.append(seeds, n).astype(np.int64)
    reach, m, tied = 1, len(k), _tied(rank, k)
    while len(tied) and reach <= depth // 2 + 1:  # a substring has two values at least
        key = rank[tied] * (m + 1)
        inside = tied + reach < m
        key[inside] += rank[tied[inside] + reach] + 1
        order = np.argsort(key)
        key, tied = key[order], tied[order]
        group, at = rank[tied], np.arange(len(tied))
        first = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), at, 0))
        head = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), at, 0))
        rank[tied] = group + head - first
        reach *= 2
        tied = _tied(rank, tied)
        tied = tied[deep[np.minimum(tied + reach, m)] - seeds[tied] < depth]  # agree as far as asked for
    seeds = seeds[np.argsort(rank, kind="stable")]
    return _induce(t, small, seeds, size, memory)[1:]


def repeated(segments: list[bytes], widths: tuple[int, ...], memory: int = 64 << 20, starts_of: list[int] | None = None) -> list[tuple[np.ndarray, ...]]:
    """For each segment and each width (the first is the largest) the starts of its windows of so many bytes that also start elsewhere in the segments.

    starts_of: how many places of each segment count as starts, where what follows them is only there to be read on.
    """
    sizes = np.array([len(s) for s in segments], np.int64)
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.uint16) + np.uint16(2)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text[starts + sizes] = 1
    order = suffix_order(text, widths[0], memory)
    room = (np.repeat(starts + sizes, sizes + 1) - np.arange(len(text))).astype(np.int32)  # bytes left in the segment
    if starts_of is not None:
        place = np.arange(len(text)) - np.repeat(starts, sizes + 1)
        room[place >= np.repeat(np.array(starts_of, np.int64), sizes + 1)] = 0
    owns = [order[room[order] >= width].astype(np.int64) for width in widths]
    same = [np.ones(max(0, len(own) - 1), bool) for own in owns]
    for base in (BASE, 0xE7037ED1A0B428DB):
        p, inverse = powers(base, len(text))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(text * p, dtype=np.uint64)])
        for width, own, equal in zip(widths, owns, same):
            h = (total[own + width] - total[own]) * inverse[own]
            equal &= h[1:] == h[:-1]
    found = []
    for own, equal in zip(owns, same):
        out = np.zeros(len(room), bool)
        out[own[1:][equal]] = True
        out[own[:-1][equal]] = True
        found.append(out)
    return [tuple(np.flatnonzero(out[s : s + k]) for out in found) for s, k in zip(starts, sizes)]
