"""Suffix order and common prefixes of a text by induced sorting with queues that spill to disk.

Suffixes that start a valley of the text (LMS) are put in order first: their substrings by induction, the shorter string
of their names by recursion. Two sweeps then induce the order of all others: a sweep pops the suffixes of one character
after another and pushes each one's predecessor, with the length of the prefix that it shares with the one pushed
before it, to the queue of its own character. Pushes arrive in order, so a first-in first-out file per character is a
priority queue. Queues beyond ``memory`` bytes go to one scratch file, and so does the text. Everything runs
in numpy, a queue chunk at a time.

Order and prefixes are exact up to ``depth`` characters; suffixes that agree so far are neighbours in any order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY = 1 << 28
#: Queue entries that are popped at a time.
PIECE = 1 << 20


class Queues:
    """First-in first-out queues of (position, shared prefix), by character."""

    def __init__(self, memory: int, scratch):
        self.chunks: dict[int, list] = {}
        self.memory, self.held, self.scratch = memory, 0, scratch

    def push(self, char: int, at: np.ndarray, shared: np.ndarray) -> None:
        size = at.nbytes + shared.nbytes
        if self.held + size > self.memory:
            self.scratch.seek(0, 2)
            entry = (self.scratch.tell(), len(at))
            self.scratch.write(at.astype(np.int64).tobytes() + shared.astype(np.uint8).tobytes())
        else:
            self.held += size
            entry = (at, shared)
        self.chunks.setdefault(char, []).append(entry)

    def size(self, char: int) -> int:
        return len(self.chunks.get(char, ()))

    def take(self, char: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Chunks from ``k`` on as one, up to about ``PIECE`` entries, and the number of the next chunk."""
        parts, n = [], 0
        while k < self.size(char) and n < PIECE:
            parts.append(self.get(char, k))
            n, k = n + len(parts[-1][0]), k + 1
        return (*map(np.concatenate, zip(*parts)), k)

    def take_back(self, char: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """As ``take``, of the chunks before ``k``; the number of the first chunk taken."""
        parts, n = [], 0
        while k > 0 and n < PIECE:
            k -= 1
            parts.append(self.get(char, k))
            n += len(parts[-1][0])
        return (*map(np.concatenate, zip(*parts[::-1])), k)

    def get(self, char: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.chunks[char][k]
        if isinstance(a, int):
            self.scratch.seek(a)
            return np.frombuffer(self.scratch.read(8 * b), np.int64), np.frombuffer(self.scratch.read(b), np.uint8)
        return a, b

    def drop(self, char: int) -> None:
        for a, b in self.chunks.pop(char, ()):
            if not isinstance(a, int):
                self.held -= a.nbytes + b.nbytes


def types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last character is the only least one."""
    up = text[:-1] < text[1:]
    differs = np.flatnonzero(text[:-1] != text[1:])
    out = np.ones(len(text), bool)
    out[:-1] = up[differs[np.searchsorted(differs, np.arange(len(text) - 1))]]
    return out


def range_min(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``x[low..high]`` for every pair; the largest number where the range is empty."""
    out = np.full(len(low), 255, np.uint8)
    size = high - low + 1
    level, width = x, 1
    while True:
        own = (size >= width) & (size < 2 * width)
        if own.any():
            out[own] = np.minimum(level[low[own]], level[high[own] - width + 1])
        if 2 * width > len(x) or not (size >= 2 * width).any():
            return out
        level = np.minimum(level[:-width], level[width:])
        width *= 2


class Sweep:
    """Pushes the predecessors of the given type for one sweep."""

    def __init__(self, text: np.ndarray, smaller: np.ndarray, kind: bool, queues: Queues, depth: int):
        self.text, self.smaller, self.kind, self.queues, self.depth = text, smaller, kind, queues, depth
        #: Least shared prefix among what was popped since a character's last push.
        self.since: dict[int, int] = {}

    def pop(self, at: np.ndarray, shared: np.ndarray) -> None:
        ok = np.flatnonzero((at > 0) & (self.smaller[np.maximum(at - 1, 0)] == self.kind))
        least = int(shared.min()) if len(shared) else 255
        chars = self.text[at[ok] - 1]
        order = np.argsort(chars, kind="stable")
        ok, chars = ok[order], chars[order]
        first = np.flatnonzero(np.append(True, chars[1:] != chars[:-1])) if len(chars) else np.zeros(0, np.int64)
        if self.depth == 1:
            # Names only: no prefixes are carried.
            for k, a in enumerate(first.tolist()):
                z = int(first[k + 1]) if k + 1 < len(first) else len(ok)
                self.queues.push(int(chars[a]), at[ok[a:z]] - 1, np.zeros(z - a, np.uint8))
            return
        before = np.empty(len(ok), np.int64)
        before[1:] = ok[:-1]
        before[first] = -1
        mins = range_min(shared, before + 1, ok)
        ends = np.append(first[1:], len(ok))
        starts = [int(chars[a]) for a in first.tolist()]
        after = range_min(shared, ok[ends - 1] + 1, np.full(len(first), len(shared) - 1)) if len(first) else mins[:0]
        for char in self.since.keys() - set(starts):
            self.since[char] = min(self.since[char], least)
        for char, a, z, rest in zip(starts, first.tolist(), ends.tolist(), after.tolist()):
            own = mins[a:z]
            new = np.minimum(own, self.depth - 1) + 1
            new[0] = min(self.depth, min(self.since[char], int(own[0])) + 1) if char in self.since else 0
            self.since[char] = rest
            self.queues.push(char, at[ok[a:z]] - 1, new.astype(np.uint8))


def shared_prefix(text: np.ndarray, a: int, b: int, depth: int) -> int:
    size = min(depth, len(text) - max(a, b))
    differs = np.flatnonzero(text[a : a + size] != text[b : b + size])
    return int(differs[0]) if len(differs) else size


def neighbours(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Shared prefix of each suffix in ``order`` and the one before it, ``depth`` at most; four characters at a time."""
    padded = np.concatenate([text, np.zeros(depth + 4, np.uint16)]).astype(np.uint64)
    n = len(text) + depth
    four = padded[:n] | (padded[1 : n + 1] << np.uint64(16)) | (padded[2 : n + 2] << np.uint64(32)) | (padded[3 : n + 3] << np.uint64(48))
    out = np.zeros(len(order), np.uint8)
    left, right, open_ = order[:-1], order[1:], np.arange(1, len(order))
    for k in range(0, depth, 4):
        differs = four[left + k] ^ four[right + k]
        equal = np.where(differs == 0, 4, 0)
        for lanes in (1, 2, 3):
            equal += (differs != 0) & (differs & np.uint64((1 << (16 * lanes)) - 1) == 0)
        out[open_] = k + equal
        same = differs == 0
        left, right, open_ = left[same], right[same], open_[same]
        if not len(open_):
            break
    return np.minimum(out, depth)


def induce(
    text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, shared: np.ndarray, depth: int, memory: int, scratch
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the last to the first, in pieces: positions, and the prefix shared with the one before."""
    of = text[lms]
    bounds = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    valleys = dict(zip(of[bounds].tolist(), zip(bounds.tolist(), np.append(bounds[1:], len(lms)).tolist())))
    chars = np.flatnonzero(np.bincount(text)).tolist()
    large = Queues(memory, scratch)
    sweep = Sweep(text, smaller, False, large, depth)
    for char in chars:
        k, last = 0, None
        while k < large.size(char):
            at, own, k = large.take(char, k)
            sweep.pop(at, own)
            last = int(at[-1])
        if char in valleys:
            a, z = valleys[char]
            own = shared[a:z].copy()
            own[0] = 0 if last is None else shared_prefix(text, last, int(lms[a]), depth)
            sweep.pop(lms[a:z], own)
    small = Queues(memory, scratch)
    sweep = Sweep(text, smaller, True, small, depth)
    for char in reversed(chars):
        k, last = 0, None
        while k < small.size(char):
            at, own, k = small.take(char, k)
            sweep.pop(at, own)
            yield at, own
            last = int(at[-1])
        small.drop(char)
        # The larger kind backwards: a piece's first prefix belongs to the last of the piece before it.
        carried, k = None, large.size(char)
        while k > 0:
            at, own, k = large.take_back(char, k)
            back = np.append(own[:0:-1], 0).astype(np.uint8)
            back = np.roll(back, 1)
            if carried is not None:
                back[0] = carried
            elif last is not None:
                back[0] = shared_prefix(text, last, int(at[-1]), depth)
            sweep.pop(at[::-1], back)
            yield at[::-1], back
            carried = int(own[0])
        large.drop(char)


def double(ranks: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of a short string of names, up to ``depth`` of them, by doubling."""
    width, n = 1, len(ranks)
    ranks = ranks.astype(np.uint64)
    while True:
        keys = ranks << np.uint64(32)
        keys[: n - width] |= ranks[width:] + np.uint64(1)
        order = np.argsort(keys, kind="stable")
        new = np.append(False, keys[order][1:] != keys[order][:-1])
        ranks = np.empty(n, np.uint64)
        ranks[order] = np.cumsum(new).astype(np.uint64)
        width *= 2
        if width >= depth or width >= n or int(ranks[order[-1]]) == n - 1:
            return order


def valley_order(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, depth: int, memory: int, scratch) -> np.ndarray:
    """The LMS suffixes in order, up to ``depth`` characters."""
    start = lms[np.argsort(text[lms], kind="stable")]
    none = np.zeros(len(start), np.uint8)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    pieces = [at[is_lms[at]] for at, _ in induce(text, smaller, start, none, 1, memory, scratch)]
    # The sweeps leave out the end, which is the least.
    order = np.concatenate([*pieces, lms[-1:]])[::-1]
    end = np.empty(len(text), np.int64)
    end[lms] = np.append(lms[1:], lms[-1]) + 1
    size = end[order] - order
    same = np.append(False, size[1:] == size[:-1])
    left, right, open_ = order[:-1][same[1:]], order[1:][same[1:]], np.flatnonzero(same)
    k = 0
    while len(open_):
        go = left + k < end[left]
        equal = np.ones(len(left), bool)
        equal[go] = text[left[go] + k] == text[right[go] + k]
        same[open_[~equal]] = False
        keep = equal & go
        left, right, open_, k = left[keep], right[keep], open_[keep], k + 1
    names = np.empty(len(text), np.int64)
    names[order] = np.cumsum(~same) - 1
    string = names[lms]
    if int(string.max()) == len(lms) - 1:
        return order
    depth = depth // 2 + 2
    if 24 * len(string) <= memory:
        return lms[double(string, depth)]
    deeper = types(string)
    valleys = np.flatnonzero(deeper[1:] & ~deeper[:-1]) + 1
    sorted_valleys = valley_order(string, deeper, valleys, depth, memory, scratch)
    shared = np.zeros(len(valleys), np.uint8)
    pieces = [at for at, _ in induce(string, deeper, sorted_valleys, shared, 1, memory, scratch)]
    return lms[np.concatenate([*pieces, np.array([len(string) - 1])])[::-1]]


def suffixes(text: np.ndarray, depth: int, memory: int = MEMORY, scratch=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of ``text`` from the last to the first, in pieces: positions, shared prefixes with the one before.

    The last character of ``text`` must be its only 0. ``scratch`` is a binary file for what exceeds ``memory``.
    """
    if len(text) < 2:
        return
    own = scratch or tempfile.TemporaryFile()
    smaller = types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = valley_order(text, smaller, lms, depth, memory, own)
    yield from induce(text, smaller, order, neighbours(text, order, depth), depth, memory, own)
    if scratch is None:
        own.close()
