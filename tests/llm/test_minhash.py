"""Near duplicates against all pairs compared by brute force."""

import random

import pytest

from lexiloom.llm import components as C
from lexiloom.llm import minhash as M

SPACES = " \t\n\x0b\f\r"


def shingles(text, k=5):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").translate({ord(c): " " for c in SPACES}).split(" ")
    words = [w for w in words if w]
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(docs, percent=85):
    sets = {d: shingles(t) for d, t in docs if d is not None}
    low = {d: d for d in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    return sorted((d, len(sets[d]), find(d)) for d in ids)


@pytest.fixture(scope="module")
def docs():
    random.seed(3)
    pool = [f"w{i}" for i in range(300)]
    out, shared = [], [random.choice(pool) for _ in range(60)]
    for family in range(14):
        base = [random.choice(pool) for _ in range(random.choice([3, 5, 12, 60, 150]))] + shared * (family % 2)
        for _ in range(random.choice([1, 2, 6, 25])):
            own = list(base)
            for _ in range(random.randint(0, 4)):
                own[random.randrange(len(own))] = random.choice(pool)
            out.append(" ".join(own))
    # A chain: neighbours are alike, the ends are not.
    own = [random.choice(pool) for _ in range(150)]
    for _ in range(25):
        own = own[2:] + [random.choice(pool), random.choice(pool)]
        out.append(" ".join(own))
    out += out[:8] + [None, "", " \n", "one two", "ONE\ttwo", "one  two three", "É é", "é É"]
    random.shuffle(out)
    return list(enumerate(out, 5))


def test_brute_force(spark, rows, docs):
    found = M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == brute(docs)


def test_clashing_columns_and_edges(spark, docs):
    long = " ".join(f"x{i % 7000}y{i % 13}" for i in range(60_000))
    some = [(1, long), (2, long + " end"), (3, None), (None, long), (None, None), (2, long + " end"), (4, "tie a b c d"), (5, "TIE a b c d")]
    frame = spark.createDataFrame([(d, t, 0, [1], "k") for d, t in some], "doc_id long, text string, rep int, halves array<int>, key string")
    kept = M.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None", "None"]
    assert M.near_duplicates(frame.limit(0)).count() == 0
    assert M.keep_one(frame.limit(0)).count() == 0


def test_no_pair_alike(spark):
    docs = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(20)]
    found = M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id for r in found)


def test_components(spark, rows):
    random.seed(9)
    links = [(i + 1, i) for i in range(60)] + [(100, 140), (140, 120), (120, 120), (100, 140), (200, 199)]
    random.shuffle(links)
    found = {r.node: r.comp for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, 140: 100, 120: 100, 200: 199}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [70, 80, 85, 95])
def test_half_keys_reach_the_threshold(percent):
    halves, per_half = M.half_keys(percent)
    assert M.missed(percent / 100, halves, per_half) < 1e-4 <= M.missed(percent / 100, halves - 1, per_half)
    assert M.half_keys(85) == (21, 5)


def test_pipeline_links_at_80_percent(spark):
    """Pairs from 0.80 to 0.85, which the stage must find and op9's threshold must not."""
    import corpus_pipeline as P

    random.seed(8)
    docs = []
    for i in range(150):
        own = [f"w{random.randrange(10**6)}" for _ in range(104)]
        docs += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:86]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    low = {d for d, _, c in brute(docs, 80) if d == c}
    assert len(low) == 150 and len({d for d, _, c in brute(docs, 85) if d == c}) == 300
    assert {r.doc_id for r in P.near_duplicates(spark, frame, "").collect()} == low
