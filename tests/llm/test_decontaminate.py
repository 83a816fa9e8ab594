"""Decontamination against the exact edit distance of every item to every document."""

import random

import numpy as np
import pytest

from lexiloom.llm import decontaminate as D

ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string, item_id string, edits int"


def words(text):
    table = {c: " " for c in map(chr, range(33, 127)) if not c.isalnum()}
    return "".join(table.get(c, c.lower() if c.isascii() else c) for c in text or "").split()


def least_edits(item, doc):
    """Sellers: least edit distance to any run of words."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in doc:
        new = [0]
        for k, x in enumerate(item):
            new.append(min(row[k] + (x != w), row[k + 1] + 1, new[k] + 1))
        row, best = new, min(best, new[-1])
    return best


def brute(docs, items, percent):
    out = set()
    for i, text in items:
        own = words(text)
        if i is None or not own:
            continue
        for d, doc in docs:
            if d is not None and (e := least_edits(own, words(doc))) <= (len(own) * (100 - percent) // 100 if len(own) >= 5 else 0):
                out.add((d, i, e))
    return out


@pytest.fixture(scope="module")
def cases():
    random.seed(11)
    pool = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    items = [(i, " ".join(random.choice(pool) for _ in range(random.choice([5, 6, 9, 10, 15, 23, 40, 59])))) for i in range(25)]
    docs = []
    for d in range(260):
        body = [random.choice(pool) for _ in range(random.randint(0, 120))]
        for _ in range(random.randint(0, 2)):
            own = random.choice(items)[1].split()
            for _ in range(random.randint(0, max(1, len(own) // 4))):
                k, kind = random.randrange(len(own)), random.randrange(3)
                own[k : k + (kind != 2)] = [] if kind == 0 and len(own) > 1 else [random.choice(pool)]
            at = random.randint(0, len(body))
            body[at:at] = own
        docs.append((d, (" " if d % 3 else ",\n").join(body)))
    return docs, items


def test_bit_vectors(cases):
    docs, items = cases
    index = D.Items([i for i, _ in items], [t for _, t in items], 80, 0.99)
    for d, doc in docs[:30]:
        coded = {w: h for w, h in zip(words(doc), hashes(doc).tolist())}
        for k in range(0, len(items), 4):
            assert index.distance(k, [coded[w] for w in words(doc)]) == least_edits(words(items[k][1]), words(doc))


def hashes(text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    return D.plain_words(data, np.array([0, len(data)]))[0]


@pytest.mark.parametrize("block", [1000, 7])
def test_recall_against_brute_force(spark, cases, block):
    docs, items = cases
    found = D.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), block=block)
    found, expected = {tuple(r) for r in found.collect()}, brute(docs, items, 80)
    assert {x[:2] for x in found} <= {x[:2] for x in expected}
    assert len(expected) > 100 and len(found & expected) >= 0.99 * len(expected)
    assert {x for x in expected if x[2] == 0} <= found


def test_edges(spark, rows):
    item = "one two three four five six seven eight nine ten"
    items = [(1, item), (2, None), (3, ""), (None, item), (4, "one two"), (1, item)]
    docs = [
        (1, None), (2, ""), (3, item), (4, "x " * 20_000 + item.upper().replace(" ", ", ") + " y" * 20_000), (5, item[:30]),
        (None, item), (3, item), (6, "one two three zero five six seven nine nine ten"), (7, "one, two"),
    ]
    docs = spark.createDataFrame([(d, t, "a", 1) for d, t in docs], DOCS)
    items = spark.createDataFrame(items, ITEMS)
    short = [(d, 4, 0) for d in (3, 4, 5, 6, 7)]
    assert rows(D.matches(docs, items)) == sorted([(3, 1, 0), (4, 1, 0), (6, 1, 2), *short], key=repr)
    out = {r.doc_id: (r.contaminated, r.n_items, r.item_ids) for r in D.contamination(docs, items).collect()}
    assert out[3] == (True, 2, [1, 4]) and out[1] == (False, 0, []) and out[7] == (True, 1, [4])
    assert sorted(str(r.doc_id) for r in D.clean(docs, items).collect()) == ["1", "2", "None"]
    assert D.clean(docs, items).columns == docs.columns
    assert D.matches(docs.limit(0), items).count() == D.matches(docs, items.limit(0)).count() == 0


def test_tables_reach_the_recall():
    n, hit = D.tables_for(0.99, 0.75), 0.25**D.SAMPLED
    assert 1 - (1 - hit) ** n >= 0.99 > 1 - (1 - hit) ** (n - 1)


def edited(own, n, pool, rnd):
    """``own`` with exactly ``n`` words removed, replaced or put in."""
    own = list(own)
    for k in sorted(rnd.sample(range(len(own)), n), reverse=True):
        kind = rnd.randrange(3)
        own[k : k + (kind != 2)] = [] if kind == 0 else [rnd.choice(pool)]
    return own


def test_short_items_match_word_for_word(spark, rows):
    rnd = random.Random(4)
    pool = [f"w{i}" for i in range(30)]
    items = [(k, " ".join(rnd.choice(pool) for _ in range(1 + k % 4))) for k in range(40)]
    docs = [(d, " ".join(rnd.choice(pool) for _ in range(rnd.randrange(25)))) for d in range(200)]
    found = {tuple(r) for r in D.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)).collect()}
    assert found == brute(docs, items, 80) and len(found) > 100


@pytest.mark.parametrize("n, percent", [(24, 80), (59, 80), (100, 80), (200, 80), (400, 80), (24, 70), (24, 60), (24, 50), (100, 60)])
def test_recall_at_the_full_allowance(n, percent):
    rnd = random.Random(n)
    pool = [f"w{i}" for i in range(5000)]
    items = [[rnd.choice(pool) for _ in range(n)] for _ in range(150)]
    index = D.Items(list(range(150)), [" ".join(x) for x in items], percent, 0.99)
    docs = [" ".join(["x", *edited(x, n * (100 - percent) // 100, pool, rnd), "y"]) for x in items]
    data = np.frombuffer("".join(docs).encode(), np.uint8)
    found = index.matches(*D.plain_words(data, np.cumsum([0, *map(len, docs)])))
    assert sum((k, k) in found for k in range(150)) >= (0.99 if percent == 80 else 0.97) * 150
    assert all(r == i and least_edits(items[i], docs[r].split()) == e for (r, i), e in list(found.items())[:10])


@pytest.mark.parametrize("n", [2049, 7000])
def test_very_long_item(spark, rows, n):
    rnd = random.Random(n)
    pool = [f"w{i}" for i in range(3000)]
    long, short = [rnd.choice(pool) for _ in range(n)], "one two three four five six seven eight nine ten"
    near, far = edited(long, n // 6, pool, rnd), edited(long, n // 3, pool, rnd)
    docs = [(1, " ".join(["x"] * 50 + near)), (2, " ".join(far)), (3, " ".join(long)), (4, short), (5, " ".join(long[: n // 2]))]
    items = spark.createDataFrame([(1, " ".join(long)), (2, short)], ITEMS)
    found = {(d, i): e for d, i, e in rows(D.matches(spark.createDataFrame(docs, "doc_id long, text string"), items))}
    assert found.keys() == {(1, 1), (3, 1), (4, 2)} and found[3, 1] == found[4, 2] == 0 and 0 < found[1, 1] <= n // 6


def test_blocks_are_bounded_by_their_text(spark, cases, monkeypatch, rows):
    docs, items = (spark.createDataFrame(x, s) for x, s in zip(cases, ("doc_id long, text string", ITEMS)))
    whole = rows(D.matches(docs, items))
    monkeypatch.setattr(D, "BLOCK_BYTES", 1000)
    assert rows(D.matches(docs, items)) == whole
