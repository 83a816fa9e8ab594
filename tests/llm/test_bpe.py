"""BPE against the library whose ids it must give."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from lexiloom.llm import bpe

ODD = [
    None, "", " ", "  \n\t x", "a", "Grüße   an alle\x1cx\x1d y", "'s don't we'LL it'd", "x" * 3000, "ab" * 700, "\U0001f600" * 300,
    "<|endoftext|> 12345 ١٢٣ ½ ²", "é" * 50, "\n\n\n   \n", "日本語のテキスト" * 40, "\x85  　", "a​b", "..." * 100, "!" * 257, "z" * 256,
]


@pytest.fixture(scope="module")
def own():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.RANKS), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_at_random(own):
    random.seed(5)
    ours = bpe.Bpe(bpe.ranks_file(), P.PATTERN)
    texts = ["".join(random.choice("abeinrstéüñ ß01.,!\n'  ") for _ in range(random.randint(0, 90))) for _ in range(600)]
    texts += ["".join(random.choice("etaoin") for _ in range(n)) for n in (3, 4, 5, 8, 9, 16, 17, 255, 256, 257, 400)]
    for text, ids in zip(texts, ours.encode(texts)):
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == own.encode_ordinary(text)
        assert ours.decode(ids) == text.encode()


def test_cache_is_bounded(own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 5)
    ours = bpe.Bpe(bpe.ranks_file(), P.PATTERN)
    for text in ("one two three four", "five six seven eight nine ten", "one two"):
        ids = ours.encode([text])[0]
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == own.encode_ordinary(text)


def test_documents(spark, rows, own):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "lost", "x"), (5, ODD[5], "x")], "doc_id long, text string, ids string")
    expected = []
    for i, text in [*enumerate(ODD), (5, ODD[5])]:
        ids = own.encode_ordinary(text or "")
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        expected.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows(bpe.digests(docs)) == sorted(expected, key=repr)
    assert bpe.digests(docs.limit(0)).count() == 0


def test_given_documents(spark, own):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for doc_id, n, ids in bpe.encode(docs).collect():
        expected = own.encode_ordinary(texts[doc_id] or "")
        assert n == len(expected) and bytes(ids) == b"".join(x.to_bytes(4, "little") for x in expected)
