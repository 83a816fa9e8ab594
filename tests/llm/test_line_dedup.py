"""Shared lines against plain Python."""

import hashlib
import random
from collections import defaultdict

import pytest

from lexiloom.llm import line_dedup as L

SPACES = " \t\n\x0b\f\r"


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACES))


def brute(docs, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for d, t in docs:
        if d is not None:
            for line in (t or "").split("\n"):
                holders[key(line)].add(d)
    shared = {k: max(ids) for k, ids in holders.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for d, t in docs:
        if d is not None:
            lines = (t or "").split("\n")
            kept = [x for x in lines if key(x) not in shared or shared[key(x)] == d]
            out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    random.seed(2)
    common = [f"  This is Shared line {k} with words enough to count éÉ " + "x" * (k % 9) for k in range(25)]
    out = []
    for k in range(400):
        lines = [random.choice(common) if random.random() < 0.5 else f"own line {k} {random.random()}" for _ in range(random.randint(0, 8))]
        # One line that most documents hold, and lines just below the length.
        lines += ["\tHOT hot hot hot hot hot hot hot hot hot hot"] * random.choice([0, 1, 3]) + ["a" * 39, "É" * 39 + "\r"]
        random.shuffle(lines)
        out.append("\n".join(x.upper() if random.random() < 0.2 else x for x in lines))
    out += [None, "", "\n\n", "\n".join(["hot " * 10_000] * 3)]
    return list(enumerate(out))


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_brute_force(spark, docs, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame([(d, t, 7, "k") for d, t in docs], "doc_id long, text string, pos int, key string")
        got = L.line_digests(frame, L.keep_bitmaps(frame)).collect()
        assert sorted(tuple(r) for r in got) == brute(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_stream_in_small_batches(spark, docs):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        frame = spark.createDataFrame(docs[:80], "doc_id long, text string")
        got = L.line_digests(frame, L.keep_bitmaps(frame)).collect()
        assert sorted(tuple(r) for r in got) == brute(docs[:80])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_cut_lines_keeps_columns_and_odd_rows(spark):
    line = "a line that is long enough to be counted here"
    docs = [(i, f"{line}\nown {i}", "keep", i) for i in range(6)] + [(None, line, "keep", 1), (7, None, "keep", None), (3, f"{line}\nown 3", "keep", 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, keep_bitmap string, n_chars long")
    out = L.cut_lines(frame, L.keep_bitmaps(frame))
    assert out.columns == frame.columns
    got = sorted((str(r.doc_id), r.text, r.keep_bitmap, r.n_chars) for r in out.collect())
    own = [(str(i), f"own {i}", "keep", 5) for i in (0, 1, 2, 3, 3, 4)]
    assert got == sorted([*own, ("5", f"{line}\nown 5", "keep", 5), ("None", line, "keep", 1), ("7", None, "keep", None)])
    assert L.keep_bitmaps(frame.limit(0)).count() == 0
    assert L.cut_lines(frame.limit(0), L.keep_bitmaps(frame.limit(0))).count() == 0


def test_bitmaps():
    assert L.unpack(None, 3).tolist() == [True] * 3
