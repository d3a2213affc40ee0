"""Suffix sorting by induction, with queues that go to disk.

Suffixes are of type S (smaller than the next) or L. The leftmost S suffixes (LMS) are sorted first:
their substrings by one round of induction, and where substrings are equal, by sorting the string of
their names in the same way, recursively. From sorted LMS suffixes, all L suffixes follow in one
ascending pass and all S suffixes in one descending pass: each suffix taken from the queue puts its left neighbour
into the queue if that is of the wanted type.

The queue is a priority queue by first character; within a character it is first in, first out, which is the
order that induction needs. Tuples are taken a whole character at a time (and in waves, where a
character repeats), so numpy does the work. Past ``memory`` tuples the queue's largest characters
move to files; text and result are memory-mapped by the caller where they are large.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

from tabula.llm.textnum import range_hashes

MEMORY = 8_000_000
#: Beyond so many different names a level is sorted by doubling instead of one queue turn per name.
NAMES = 1_024


class BucketQueue:
    """Positions queued by character, first in, first out in each; parts beyond ``memory`` wait on disk."""

    def __init__(self, characters: int, folder: str, memory: int = MEMORY):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(characters)]
        self.files: list[list[tuple[int, int]]] = [[] for _ in range(characters)]
        self.sizes = np.zeros(characters, np.int64)
        self.memory = memory
        self.disk = tempfile.TemporaryFile(dir=folder)

    def push(self, characters: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(characters, kind="stable")
        keys, starts = np.unique(characters[order], return_index=True)
        for key, part in zip(keys, np.split(positions[order], starts[1:])):
            self.parts[key].append(part)
            self.sizes[key] += len(part)
        while self.sizes.sum() > self.memory:
            self._spill(int(self.sizes.argmax()))

    def _spill(self, key: int) -> None:
        data = np.concatenate(self.parts[key])
        self.disk.seek(0, 2)
        self.files[key].append((self.disk.tell(), len(data)))
        data.tofile(self.disk)
        self.disk.flush()
        self.parts[key], self.sizes[key] = [], 0

    def pop(self, key: int) -> np.ndarray:
        """All positions of a character, in the order they came."""
        found = []
        for at, n in self.files[key]:
            self.disk.seek(at)
            found.append(np.fromfile(self.disk, np.int64, n))
        found += self.parts[key]
        self.files[key], self.parts[key], self.sizes[key] = [], [], 0
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def close(self) -> None:
        self.disk.close()


def _types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last character must be the only smallest one."""
    n = len(text)
    change = np.flatnonzero(text[:-1] != text[1:])
    following = change[np.searchsorted(change, np.arange(n - 1))]
    small = np.ones(n, bool)
    small[:-1] = text[following] < text[following + 1]
    return small


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, characters: int, folder: str, memory: int) -> Iterator[np.ndarray]:
    """All suffixes in order, from LMS suffixes in order (or LMS substrings from LMS positions in any order)."""
    of_seed = text[seeds]
    by_char = seeds[np.argsort(of_seed, kind="stable")]
    ends = np.searchsorted(np.sort(of_seed), np.arange(characters + 1))
    queue, large = BucketQueue(characters, folder, memory), BucketQueue(characters, folder, memory)

    def left_of(wave: np.ndarray, want_small: bool) -> tuple[np.ndarray, np.ndarray]:
        before = wave[wave > 0] - 1
        before = before[small[before] == want_small]
        return text[before], before

    for c in range(characters):
        wave = queue.pop(c)
        while len(wave):
            large.push(np.full(len(wave), c), wave)
            chars, before = left_of(wave, False)
            same = chars == c
            queue.push(chars[~same], before[~same])
            wave = before[same]
        chars, before = left_of(by_char[ends[c]: ends[c + 1]], False)
        queue.push(chars, before)
    out: list[np.ndarray] = []
    for c in range(characters - 1, -1, -1):
        waves, wave = [], queue.pop(c)
        if c == 0:
            wave = np.asarray([len(text) - 1])
        while len(wave):
            waves.append(wave)
            chars, before = left_of(wave, True)
            same = chars == c
            queue.push(chars[~same], before[~same])
            wave = before[same] if c else wave[:0]
        own = large.pop(c)
        queue.push(*left_of(own[::-1], True))
        out += [w for w in waves] + [own[::-1]]
    queue.close()
    large.close()
    for part in reversed(out):
        yield part[::-1]


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of many different names, by doubling ranks."""
    rank, reach, n = names.astype(np.int64), 1, len(names)
    while True:
        after = np.full(n, -1, np.int64)
        after[: max(0, n - reach)] = rank[reach:]
        order = np.lexsort((after, rank))
        new = np.cumsum((np.diff(rank[order], prepend=-1) != 0) | (np.diff(after[order], prepend=-2) != 0)) - 1
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        reach *= 2


def suffix_order(text: np.ndarray, folder: str, memory: int = MEMORY) -> np.ndarray:
    """Starts of all suffixes in ascending order. ``text`` ends with its only 0; other values are positive."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    characters = int(text.max()) + 1
    if characters > NAMES:
        return _doubled(text)
    small = _types(text)
    first = np.zeros(n, bool)
    first[1:] = small[1:] & ~small[:-1]
    seeds = np.flatnonzero(first)
    if len(seeds) > 1:
        stops = np.append(seeds[1:] + 1, n)
        order = np.concatenate([p[first[p]] for p in _induce(text, small, seeds, characters, folder, memory)])
        place = np.searchsorted(seeds, order)
        hashes = range_hashes(text, seeds, stops)[place]
        lengths = (stops - seeds)[place]
        fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (lengths[1:] != lengths[:-1]))
        names = np.empty(len(seeds), np.int64)
        names[place] = np.cumsum(fresh) - 1
        seeds = order if fresh.all() else seeds[suffix_order(names, folder, memory)]
    return np.concatenate(list(_induce(text, small, seeds, characters, folder, memory)))


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Whether each suffix shares at least ``most`` characters with the one before it, compared in full."""
    enough = np.zeros(len(order), bool)
    same = np.flatnonzero((order[1:] + most <= len(text)) & (order[:-1] + most <= len(text)))
    for i in range(most):
        same = same[text[order[same] + i] == text[order[same + 1] + i]]
    enough[same + 1] = True
    return enough
