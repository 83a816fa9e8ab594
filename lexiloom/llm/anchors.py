"""Content-chosen anchors: which stretches of texts can hold a byte string of some length twice."""

from __future__ import annotations

import numpy as np

from lexiloom.llm.common import _BYTES, _power, mix

#: Bytes of an anchor; a window of ``length`` bytes has ``length - GRAM + 1`` of them to choose from.
GRAM = 20


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of the ``width`` bytes from every place that has as many."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    n, have = len(x) - width + 1, 1
    while 2 * have <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of every stretch.

    Each window of ``length`` bytes inside a row picks the anchor of least hash, the leftmost of equals. Neighbouring
    windows with one anchor are a stretch. Equal windows pick equal anchors, so a window that is also
    elsewhere lies in a stretch whose anchor is also elsewhere.
    """
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return np.zeros(0, np.uint64), none, none
    hashes = gram_hashes(data, GRAM)
    # 32 bits of the hash, then the place: the leftmost of equals is the least.
    keyed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    chosen = (sliding_min(keyed, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Windows that do not run over the end of their row.
    inside = np.ones(n, bool)
    ends = offsets[1:][np.diff(offsets) > 0]
    over = np.zeros(len(data) + 1, np.int64)
    np.add.at(over, np.maximum(ends - length + 1, 0), 1)
    np.add.at(over, ends, -1)
    inside = np.cumsum(over)[:n] == 0
    place = np.flatnonzero(inside)
    if not len(place):
        return np.zeros(0, np.uint64), none, none
    anchor = chosen[place]
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    # Chosen hashes are small; mixed again they are spread evenly.
    return mix(hashes[anchor[first]] + np.uint64(1)), place[first], np.diff(np.append(first, len(place)))
