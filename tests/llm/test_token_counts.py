"""Token counts against the library on whole texts."""

import random

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from lexiloom.llm import token_counts as T

WORDS = ["the", "cat's", "I'll", " ", "\n\n", "\t", "naïve", "1234", "3.14", "--", "日本語の文。", "<|endoftext|>", "Привет", "x" * 30, "...", " ", "é", "👍🏽", "'", "''s", "<|", "endoftext|>", "  "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(path(T.FILE))


def random_text(n):
    out = ""
    while len(out) < n:
        out += random.choice(WORDS) + random.choice(["", " ", " ", ", ", "\n"])
    return out


def expected(library, docs, limit=T.LIMIT):
    out = []
    for d, t in docs:
        if d is not None:
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            out.append((d, len((t or "").encode()), n, n > limit))
    return sorted(out)


def frame(spark, docs):
    return spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], "doc_id long, text string, uid int, part int, n_tokens string")


def test_against_the_library(spark, library):
    random.seed(13)
    docs = [(k, random_text(random.choice([3, 50, 300, 2000, 9000]))) for k in range(60)]
    docs += [(100, None), (101, ""), (None, "no id"), (102, " "), (5, docs[5][1]), (5, "another of that id " * 40)]
    # Without a stable place: alike throughout, then in the middle only.
    docs += [(110, "x" * 700), (111, "𝒳" * 500 + " end"), (112, "words in front " * 20 + "q" * 400 + " and behind" * 30), (113, "<|endoftext|>" * 90)]
    got = T.token_counts(frame(spark, docs), chunk=100, overlap=20)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(tuple(r) for r in got.collect()) == expected(library, docs)


def test_production_parameters(spark, library):
    random.seed(4)
    docs = [(1, random_text(200_000)), (2, "z" * 80_000), (3, random_text(40_000) + "y" * 50_000 + random_text(40_000)), (4, "short")]
    assert sorted(tuple(r) for r in T.token_counts(frame(spark, docs)).collect()) == expected(library, docs)


def test_stable_places_hold_in_any_surroundings(library):
    random.seed(5)
    counter = T.Counter(T.tokenizer_file())
    for _ in range(300):
        text = random_text(60)
        ends = {a for a, _ in library.encode(text, add_special_tokens=False).offsets}
        for p in counter.stable_places(text, 0, len(text)):
            assert p in ends
            whole = library.encode(text, add_special_tokens=False).ids
            assert library.encode(text[:p], add_special_tokens=False).ids + library.encode(text[p:], add_special_tokens=False).ids == whole


def test_segments_add_up(library, monkeypatch):
    random.seed(6)
    monkeypatch.setattr(T, "CACHED", 50)
    counter = T.Counter(T.tokenizer_file())
    texts = [random_text(random.choice([0, 10, 200, 3000])) for _ in range(200)] + ["", " ", "a", "a  b", "a\n\n b \t c", "é \u00e9 x\u00a0 y \u3000z", "don't 's <|endoftext|> <|endoftext|>"]
    for k in range(0, len(texts), 9):
        assert counter.counts(texts[k : k + 9]) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts[k : k + 9]]


def test_edges(spark):
    empty = frame(spark, [(1, "a")]).limit(0)
    assert T.token_counts(empty).count() == 0
    with pytest.raises(ValueError):
        T.token_counts(empty, overlap=1)
    with pytest.raises(ValueError):
        T.Counter('{"pre_tokenizer": {"type": "Whitespace"}, "added_tokens": []}')


def test_given_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = expected(library, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    for chunk, overlap in ((T.CHUNK, T.OVERLAP), (500, 60)):
        assert sorted(tuple(r) for r in T.token_counts(docs, chunk=chunk, overlap=overlap).collect()) == want
