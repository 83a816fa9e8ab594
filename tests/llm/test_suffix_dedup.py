"""Repeated strings against a dictionary of all windows."""

import hashlib
import random

import pytest

from lexiloom.llm import suffix_dedup as S


def brute(docs, length=50):
    first = {}
    raws = [(d, (t or "").encode()) for d, t in docs if d is not None]
    for d, raw in raws:
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            first[w] = min(d, first.get(w, d))
    out = []
    for d, raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    random.seed(8)
    word = lambda: "".join(random.choice(["tion", "the", "é", "an", "er", "日", "s "]) for _ in range(3))
    passages = [" ".join(word() for _ in range(random.choice([4, 6, 9, 30]))) for _ in range(8)]
    texts = []
    for k in range(160):
        parts = [random.choice(passages) if random.random() < 0.4 else " ".join(word() for _ in range(random.randint(0, 20))) for _ in range(random.randint(0, 5))]
        texts.append("\n".join(parts))
    texts += texts[:20] + [None, "", "a" * 49, "a" * 50, "a" * 51, "a" * 4000, "ab" * 900, passages[0], passages[3] * 3, "x" + passages[3], "=" * 80 + "\n" + "=" * 80]
    random.shuffle(texts)
    return list(enumerate(texts, 3))


@pytest.mark.parametrize("batch,memory,shard", [(S.BATCH, 1 << 26, S.SHARD), (4000, 5000, 300)])
def test_brute_force(spark, docs, batch, memory, shard):
    frame = spark.createDataFrame([(d, t, 1, b"") for d, t in docs], "doc_id long, text string, n_bytes int, kept binary")
    got = S.remove_repeats(frame, batch_bytes=batch, memory=memory, shard_bytes=shard).collect()
    want = brute(docs)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert sum(r[2] for r in want) > 5000


def test_edges(spark):
    own = random.Random(2)
    long = "".join(own.choice("abcdefgh ") for _ in range(200_000))
    docs = [(2, long), (1, long[1000:1500]), (None, long), (7, "q" * 60), (7, "q" * 60), (8, "q" * 55), (9, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed, r.n_spans) for r in S.remove_repeats(frame).collect())
    assert got == [(1, 0, 0), (2, 500, 1), (7, 0, 0), (7, 0, 0), (8, 55, 1), (9, 0, 0)]
    assert S.remove_repeats(frame.limit(0)).count() == 0


def test_digests(spark):
    out = {r.doc_id: r for r in S.digests(spark.createDataFrame([(1, "é" * 60), (2, "é" * 40 + "!")], "doc_id long, text string")).collect()}
    assert out[2].n_removed == 80 and out[2].kept_sha256 == hashlib.sha256(b"!").hexdigest()
