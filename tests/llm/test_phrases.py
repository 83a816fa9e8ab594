"""Collocations against counting in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from lexiloom.llm import phrases as P


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def brute(docs, least=10, top=2000, absorb=50):
    sizes, f = Counter(), defaultdict(Counter)
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            w = tuple(x for x in re.split(r"[ \t]+", piece) if x)
            sizes[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(w[i : i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        good = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        held = defaultdict(int)
        for p, a in good.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    held[part] = max(held[part], a)
        found = []
        for p, a in good.items():
            if len(p) == 3 or not held[p] or 100 * held[p] < absorb * a:
                score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -s))
    return sorted(out)


def frame(spark, docs, parts=6):
    return spark.createDataFrame([(t, g, 1, "x") for t, g in docs], "text string, lang string, id long, word string").repartition(parts)


def texts(n):
    random.seed(n)
    vocabulary = ["the", "Of", "and", "Straße", "ﬁn", "x", "1.5", "日本", "né", "-", "|", "a b", "New York City", "in the end"] + [f"w{k}" for k in range(30)]
    out = []
    for _ in range(n):
        words = [random.choice(vocabulary[: random.choice([4, 14, 44])]) for _ in range(random.randint(0, 60))]
        text = ""
        for w in words:
            text += w + random.choice([" "] * 8 + ["  ", "\t", ", ", ".", "\n", "\x0b", "?!", " \x1f", "\xa0"])
        out.append((text, random.choice(["en", "en", "en", "de", None, "und"])))
    return out


def got(spark, docs, parts=6, **more):
    result = P.collocations(frame(spark, docs, parts), **more)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in result.collect())


@pytest.mark.parametrize(
    "batch_bytes, budget, least, top", [(1 << 23, 1 << 21, 10, 2000), (2000, 50, 10, 2000), (2000, 50, 3, 40), (300, 1, 1, 5)]
)
def test_brute_force(spark, batch_bytes, budget, least, top):
    docs = texts(250)
    docs += [("hot pair " * 400 + ". hot pair of x", "en")] * 6 + [(f"hot pair w{k % 40}", "en") for k in range(300)]
    docs += [("en de en " * 12, "de"), ("de en de " * 12, "en")]  # words that are names of languages
    docs += [(None, "en"), ("", None), (" \t\n.", "de"), ("one two three", "only here")]
    assert got(spark, docs, batch_bytes=batch_bytes, budget=budget, min_count=least, top=top) == brute(docs, least, top)


def test_absorbed_by_any_longer_candidate(spark):
    docs = [("a b c. " * 10 + "a b. " * 10 + "b c. " * 11, "en")]
    found = {r[2]: r for r in got(spark, docs)}
    assert set(found) == {"a b c", "b c"} and got(spark, docs) == brute(docs)


def test_very_long_text_and_exact_products(spark):
    docs = [("yes no " * 60_000, "en"), ("yes no maybe " * 12, "en"), ("yes " * 50_000, "en")]
    assert got(spark, docs, parts=2) == brute(docs)


def test_hash_collisions_start_over(spark, monkeypatch):
    real = P.word_key
    monkeypatch.setattr(P, "word_key", lambda hashes, salt: hashes & P.np.uint64(3) if salt == 0 else real(hashes, salt))
    # Workers import the module anew, so the forced hash travels in the function itself.
    parse = P._parse

    def forced(it, size, salt):
        P.word_key = (lambda hashes, salt: hashes & P.np.uint64(3)) if salt == 0 else real
        yield from parse(it, size, salt)

    monkeypatch.setattr(P, "_parse", forced)
    docs = texts(60)
    assert got(spark, docs, min_count=3) == brute(docs, 3)


def test_products_beyond_64_bits(spark):
    a, left, right = 987_654_321_012_345, 998_999_999_999_999, 999_999_999_999_989
    row = spark.sql(f"SELECT {a}L AS a, {left}L AS l, {right}L AS r").selectExpr(P._score("a", "l", "r") + " AS score").first()
    assert row.score == 1000000 * a * a // (left * right)


def test_empty(spark):
    assert got(spark, [("a", "en")][:0] or [(None, None)]) == []
    assert P.collocations(frame(spark, [("a", "b")]).limit(0)).count() == 0
    assert P.collocations(spark.createDataFrame([("a b. " * 12,)], "text string")).count() == 1
