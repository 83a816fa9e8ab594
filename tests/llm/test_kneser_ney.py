"""Base rules against plain Python, and the model against a dictionary version."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexiloom.llm import kneser_ney as K


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed)


@pytest.fixture(scope="module")
def docs():
    random.seed(21)
    out = [None, "", " \n\t", "a\n\na\n a\na \n", "one\ntwo\r\none\ntwo", "# * $ % & | < >\x1c é ü 日本", "a b c d e a b c d e", "a " * 9, "b " * 10]
    for _ in range(120):
        pool = [random.choice(["ab", "cde", "fé", "g|h", "the", "of"]) for _ in range(random.choice([1, 2, 6]))]
        out.append("".join(random.choice(pool) + random.choice([" ", "  ", "\n", "\n\n", "\r\n"]) for _ in range(random.randint(1, 60))))
    return list(enumerate(out))


def test_base_rules(spark, docs):
    frame = spark.createDataFrame([(d, t, 1, None) for d, t in docs], "doc_id long, text string, n_words int, lang string")
    got = {r.doc_id: tuple(r)[1:7] for r in K.judge(frame).collect()}
    assert got == {d: base(t) for d, t in docs}
    assert K.judge(frame.limit(0)).count() == 0


def model(texts, order):
    """Interpolated modified Kneser-Ney over byte n-grams, by the book."""
    counts = {order: Counter()}
    for text in texts:
        raw = b"\0" * (order - 1) + text.encode()
        counts[order].update(raw[i : i + order] for i in range(len(raw) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    p = {b"": 1 / 256}
    for k in range(1, order + 1):
        n = Counter(counts[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        cut = [min(max(d, 0.1), j - 0.1) for j, d in enumerate(raw, 1)]
        total, freed = Counter(), Counter()
        for g, c in counts[k].items():
            total[g[:-1]] += c
            freed[g[:-1]] += cut[min(c, 3) - 1]
        for g, c in counts[k].items():
            p[g] = (c - cut[min(c, 3) - 1] + freed[g[:-1]] * p[g[1:]]) / total[g[:-1]]
    return p


@pytest.mark.parametrize("entries", [10**6, 50])
def test_perplexity(spark, docs, entries):
    p = model([t or "" for _, t in docs], 4)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for doc_id, _, n, _, log_perplexity in K.perplexities(frame, order=4, entries=entries).collect():
        raw = b"\0" * 3 + (docs[doc_id][1] or "").encode()
        logs = [math.log(p[raw[i : i + 4]]) for i in range(len(raw) - 3)]
        assert n == len(logs)
        assert (log_perplexity is None) if not logs else math.isclose(log_perplexity, -sum(logs) / len(logs), rel_tol=1e-5)


def test_bands_reject_gibberish_and_keep_prose(spark):
    random.seed(4)
    syllables = ["the", "an", "ti", "on", "er", "re", "sh", "en"]
    prose = lambda n: " ".join("".join(random.choice(syllables) for _ in range(random.randint(1, 4))) for _ in range(n))
    docs = [(i, prose(120), "en") for i in range(200)]
    docs += [(900 + i, " ".join("".join(random.choice("qxzjkvwy%#") for _ in range(6)) for _ in range(80)), "en") for i in range(4)]
    kept = {r.doc_id: r.kept for r in K.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[900 + i] for i in range(4))


def test_edges(spark):
    docs = [(1, "x" * 300_000 + " y", "en"), (None, "lost", "en"), (2, "same " * 4, None), (2, "same " * 4, None), (3, None, "de")]
    out = K.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert sorted(r.doc_id for r in out) == [1, 2, 2, 3]
    assert not [r for r in out if r.doc_id == 3][0].kept


def held_out(texts, d, order):
    """By the book with the counts of all texts but one; discounts and single bytes are those of all."""
    grams = [Counter(raw[i : i + order] for i in range(len(raw) - order + 1)) for raw in (b"\0" * (order - 1) + t.encode() for t in texts)]
    every = sum(grams, Counter())
    others, cuts, single = {order: every - grams[d]}, {}, None
    for k in range(order, 0, -1):
        n = Counter(every.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        cuts[k] = [0, *(min(max(x, 0.1), j - 0.1) for j, x in enumerate(raw, 1))]
        single = every
        every = Counter(g[1:] for g in every)
        others[k - 1] = Counter(g[1:] for g in others[k])

    def p(g):
        k, own = len(g), single if len(g) == 1 else others[len(g)]
        if not k:
            return 1 / 256
        after = [c for x, c in own.items() if x[:-1] == g[:-1]]
        if not after:
            return p(g[1:])
        return (own[g] - cuts[k][min(own[g], 3)] + sum(cuts[k][min(c, 3)] for c in after) * p(g[1:])) / sum(after)

    return sum(c * math.log(p(g)) for g, c in grams[d].items())


@pytest.mark.parametrize("entries", [10**6, 50])
def test_a_text_is_scored_by_the_others(spark, docs, entries):
    texts = [t or "" for _, t in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    scored = {r.doc_id: r for r in K.perplexities(frame, order=4, entries=entries, held_out=True).collect()}
    for d in (4, 5, 9, 20, 33):
        assert math.isclose(scored[d].log_perplexity, -held_out(texts, d, 4) / scored[d].n_bytes, rel_tol=1e-6)


def test_junk_is_rejected_and_good_kept(spark):
    """Labelled documents that pass the base rules. Bands come from the texts; no label is used."""
    sf = "/root/testdata/sf0.1"
    judged = K.judge(spark.read.parquet(f"{sf}/documents.parquet")).filter("NOT base_failed")
    rated = judged.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id")
    kept = {r.quality: r.share for r in rated.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] >= 0.995 and kept[0] <= 0.05


def test_junk_teaches_nothing(spark):
    good = [(k, f"plain words make text number {k} that one may read and learn from", "en") for k in range(30)]
    junk = [(100 + k, "$$$ plain%%% words### &&& " * 5 + str(k), "en") for k in range(60)]
    other = [(300, "### ### nothing but signs here *** and there $$$ %%% ||| ### of it", "xx"), (301, None, "xx")]
    frame = spark.createDataFrame(good + junk + other, "doc_id long, text string, lang string")
    scored = {r.doc_id: r for r in K.perplexities(frame, held_out=True, teach=True).collect()}
    assert all(scored[d].taught == (d < 100) for d in scored) and scored[301].log_perplexity is None
    assert min(scored[d].log_perplexity for d in scored if 100 <= d < 300) > max(scored[d].log_perplexity for d in range(30))
    alone = {r.doc_id: r.log_perplexity for r in K.perplexities(frame.filter("doc_id < 100"), held_out=True).collect()}
    assert all(math.isclose(scored[d].log_perplexity, alone[d], rel_tol=1e-9) for d in alone)
    judged = {r.doc_id: r for r in K.judge(frame).collect()}
    assert all(judged[d].kept for d in range(30)) and not any(judged[d].kept for d in judged if d >= 100 and not judged[d].base_failed and d < 300)
    # A language of which nothing is learned goes by what it has.
    assert judged[300].kept and judged[300].low < judged[300].perplexity < judged[300].high
