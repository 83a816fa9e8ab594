"""Label model against known accuracies, and the classifier against labels."""

import random

import numpy as np
import pytest

from lexiloom.llm import weak_labels as W

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    return W.classify(docs, labels).join(labels, "doc_id").collect()


def test_held_out_labels_of_quality(judged):
    """Quality labels are never seen by the model."""
    clean = [r for r in judged if r.quality and not r.toxic]
    junk = [r for r in judged if not r.quality]
    assert len(clean) > 100 and len(junk) > 20
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk)


def test_toxic_documents_are_rejected(judged):
    toxic = [r for r in judged if r.toxic]
    assert len(toxic) > 20 and sum(not r.kept for r in toxic) >= 0.9 * len(toxic)


def test_accuracies_are_recovered():
    rng = np.random.default_rng(5)
    n = 40_000
    kind = rng.choice(6, n, p=[0.85, 0.03, 0.03, 0.03, 0.03, 0.03])
    hit = np.full((6, W.N_LABELLERS), 0.003)
    for k, own in enumerate(W.FAULTS, 1):
        hit[k, list(own)] = 0.8
    votes = (rng.random((n, W.N_LABELLERS)) < hit[kind]).astype(int)
    votes[rng.random(votes.shape) < 0.1] = -1
    patterns, counts = np.unique(["".join("012"[x + 1] for x in row) for row in votes], return_counts=True)
    shares, rates = W.fit_accuracies(patterns.tolist(), counts.tolist())
    assert abs(shares[0] - 0.85) < 0.02
    for k, own in enumerate(W.FAULTS, 1):
        assert np.allclose(rates[k, list(own)], 0.8, atol=0.08)
    found = dict(zip(patterns.tolist(), W.posterior(W.decode_patterns(patterns.tolist()), shares, rates)))
    guess = np.array([found["".join("012"[x + 1] for x in row)] > 0.5 for row in votes])
    assert (guess == (kind > 0)).mean() > 0.97


def test_measures():
    texts = ["", "a b c", "GO!! NOW!! YES!!", "x | y | z", "na na na na", "w%% v$$ u"]
    raw = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    n, m, _, _ = W.measure(np.frombuffer(raw, np.uint8), offsets, np.zeros(len(texts), np.uint64), np.zeros(0, np.uint64))
    assert n.tolist() == [0, 3, 3, 5, 4, 3]
    name = {x: m[:, i] for i, x in enumerate(W.MEASURES)}
    assert name["shouts"].tolist() == [0, 0, 1, 0, 0, 0] and name["bangs"].tolist() == [0, 0, 1, 0, 0, 0]
    assert name["bars"][3] == 0.4 and name["stutters"][4] == 0.75 and round(name["symbol_words"][5], 3) == 0.667


def test_edges(spark):
    random.seed(1)
    prose = lambda: " ".join("".join(random.choice(["the", "an", "ti"]) for _ in range(3)) for _ in range(60))
    docs = [(i, prose(), "en", True) for i in range(60)]
    docs += [(100 + i, " ".join(f"W{i}%%%" for i in range(60)), "en", True) for i in range(6)]
    docs += [(200, None, None, None), (201, "", "en", None), (202, "same " * 30_000, "en", True), (None, "lost", "en", None), (0, prose(), "en", True)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, kept boolean")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = W.classify(frame, labels).collect()
    assert len(out) == len(docs) - 1
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[i] for i in range(60)) and not any(kept[100 + i] for i in range(6)) and not kept[202]
    left = W.keep_good(frame, labels)
    assert left.columns == frame.columns and left.filter("doc_id IS NULL").count() == 1
    assert W.classify(frame.limit(0), labels).count() == 0
    assert W.keep_good(frame.drop("lang"), labels).count() == left.count()
