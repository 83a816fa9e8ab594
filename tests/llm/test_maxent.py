"""Base scores against plain Python, proper probabilities, and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lexiloom.llm import maxent as M


def tokens(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def base(docs):
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    count = Counter(w for d, t in docs if not held[d] for w in tokens(t))
    n, v = sum(count.values()), len(count)
    return {
        d: (held[d], len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for d, t in docs
    }


@pytest.fixture(scope="module")
def docs():
    random.seed(17)
    out = [None, "", " \n", "The THE the", "É é\x1c ß", "word " * 5000]
    for k in range(300):
        # Two languages: after one of its words comes another.
        own = [f"{'ab'[k % 2]}{i}{random.choice([['ing', 'tion'], ['en', 'o']][k % 2])}" for i in range(40)]
        out.append(" ".join(random.choice(own + (["the", "of"] if k % 2 else ["der", "und"]) * 8) for _ in range(random.randint(5, 80))))
    return list(enumerate(out))


@pytest.mark.parametrize("batch", [M.BATCH, 30_000])
def test_scores(spark, docs, batch):
    frame = spark.createDataFrame([(d, t, 0.5) for d, t in docs], "doc_id long, text string, score double")
    got = {r.doc_id: r for r in M.lm_scores(frame, epochs=4, step=64, batch_bytes=batch).collect()}
    want = base(docs)
    assert got.keys() == want.keys()
    for d, (held, n, known, total, score) in want.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, score, rel_tol=1e-9)
        assert r.score < 0
    own = [r for r in got.values() if r.held_out and r.doc_id > 5]
    assert sum(r.score for r in own) > 0.95 * sum(r.base_score for r in own)


def test_probabilities_sum_to_one():
    sums = {s: (10 + s, 100 + 7 * s) for s in range(M.SUFFIXES)} | {M.SUFFIXES: (1, 40)}
    counts = M.Counts(sums, [(99, 3, 50), (98, 3, 20)])
    # All (c + 1) of known tokens, and one unknown.
    assert sum(counts.size[k] for k in range(M.CLASSES) if counts.size[k] > 1) + 1 == counts.tokens + counts.kinds + 1
    weights = np.random.default_rng(1).normal(size=((1 << M.BITS) + 1, M.CLASSES)).astype(np.float32)
    rows = M.feature_rows(np.arange(5, 25, dtype=np.uint64), np.arange(20))
    assert np.allclose(M.class_probabilities(weights, rows).sum(axis=1), 1, atol=1e-5)


def test_packing():
    for numbers in (np.arange(300, dtype=np.uint32), np.zeros(0, np.int64), np.array([2**60, 1], np.uint64)):
        assert (M.unpack(M.pack(numbers), numbers.dtype) == numbers).all()


def test_edges(spark):
    frame = spark.createDataFrame([(1, "a b"), (None, "c"), (1, "a b")], "doc_id long, text string")
    out = M.lm_scores(frame).collect()
    assert [r.n_tokens for r in out] == [3, 3] and out[0].score == out[1].score
    assert M.lm_scores(frame.limit(0)).count() == 0


def test_weights_are_averaged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(M, "FAN_IN", 3)
    rows = [(k % 2, k // 2, k // 2 + 1, M.pack(np.full(4, k // 2, np.float16))) for k in range(40)]
    out = M._averaged(spark.createDataFrame(rows, M.CHANGES), 20).orderBy("piece").collect()
    mean = sum(k * (k + 1) for k in range(20)) / sum(range(1, 21))
    assert [r.steps for r in out] == [210, 210]
    assert all(abs(M.unpack(r.change, np.float16) - mean).max() < 0.05 for r in out)
