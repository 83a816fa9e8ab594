"""Induced sorting against sorted suffixes."""

import random

import numpy as np
import pytest

from lexiloom.llm import induced as I


def run(raw, depth, memory):
    text = np.append(np.frombuffer(raw, np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16)
    at, shared = zip(*I.suffixes(text, depth, memory)) if len(text) > 1 else ((), ())
    return np.concatenate([*at, np.zeros(0, np.int64)]), np.concatenate([*shared, np.zeros(0, np.uint8)])


@pytest.mark.parametrize("memory", [1 << 26, 300])
@pytest.mark.parametrize("seed", range(12))
def test_order_and_prefixes(seed, memory):
    random.seed(seed)
    letters = random.choice([b"a", b"ab", b"abc", bytes(range(256)), b"mississippi"])
    raw = bytes(random.choice(letters) for _ in range(random.choice([1, 2, 3, 10, 200, 1500])))
    raw += raw[: len(raw) // 2] * random.choice([0, 1, 2])
    for depth in (4, 50):
        at, shared = run(raw, depth, memory)
        assert sorted(at.tolist()) == list(range(len(raw)))
        heads = [raw[i : i + depth] for i in at.tolist()]
        assert heads == sorted(heads, reverse=True)
        for k in range(1, len(heads)):
            a, b = heads[k - 1], heads[k]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == n, (k, a, b)


def test_empty():
    assert len(run(b"", 5, 100)[0]) == 0
