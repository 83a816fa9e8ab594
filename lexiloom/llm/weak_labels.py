"""Quality without gold labels: heuristic labellers, their accuracies by EM, and a linear scorer.

Labellers look at one fault each, overlap, and vote *bad*, *fine* or nothing. Their vote patterns are counted
by Spark over all documents (there are at most 3 to the power of labellers of them), and
expectation-maximisation on the counts estimates how often each labeller is right, for each fault. The posterior
of each pattern labels the documents; a logistic scorer over hashed features (steps of the shape measures,
and words) is trained on these soft labels and decides.

``SAMPLE`` bounds the documents that the scorer is fitted on, and the labelled rows from which terms of abuse are
learned: those with the smallest hash of ``doc_id``. Votes, accuracies and scores cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import mix, run_starts, span_hashes, text_chunks, word_bounds
from lexiloom.llm.decontaminate import PLAIN
from lexiloom.llm.minhash import shingle_sets
from lexiloom.session import materialize

SAMPLE = 20_000
STEM_BYTES = (4, 5, 6)
BITS = 18
EPOCHS = 12
REJECT = 0.5
MEASURES = ("symbol_chars", "symbol_words", "shouts", "bangs", "bars", "stutters", "repeats", "sameness", "same_lines", "abuse", "abusive_terms")
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>~^=\\"]] = True
_SALT = np.random.default_rng(6).integers(0, 2**63, 64, dtype=np.uint64)

#: Steps by which a measure becomes features.
STEPS = np.array([0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9])


def _total(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between the bounds ``first``."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[first[1:]] - sums[first[:-1]]


def stems(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of every plain word, its hash, and keys of its language with the word and its first 4, 5 and 6 bytes."""
    plain = PLAIN[data]
    starts, ends, rows = word_bounds(plain, offsets)
    cuts = [ends, *(np.minimum(starts + k, ends) for k in STEM_BYTES)]
    hashes = [span_hashes(plain, starts, cut) for cut in cuts]
    return rows, hashes[0], np.stack([mix(h ^ langs[rows]) for h in hashes])


def language_keys(rows: pa.RecordBatch) -> np.ndarray:
    """A 64-bit key of each row's language; 0 without one."""
    names = [(x or "").encode() for x in rows.column("lang").to_pylist()]
    ends = np.cumsum([len(x) for x in names])
    hashes = span_hashes(np.frombuffer(b"".join(names), np.uint8), ends - [len(x) for x in names], ends)
    return np.where(np.diff(ends, prepend=0) > 0, hashes, np.uint64(0))


def measure(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words per row, the measures of each row, word hashes, and the first word of each row."""
    starts, ends, rows = word_bounds(data, offsets)
    n_rows = len(offsets) - 1
    first = np.searchsorted(rows, np.arange(n_rows + 1))
    words = span_hashes(data, starts, ends)
    n = np.diff(first)

    def in_word(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[ends] - sums[starts]

    symbols = SYMBOL[data]
    double = data == ord("!")
    double[:-1] &= data[1:] == ord("!")
    double[-1:] = False
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    out = np.zeros((n_rows, len(MEASURES)))
    some, chars = np.maximum(n, 1), np.maximum(np.diff(offsets), 1)
    out[:, 0] = _total(symbols, offsets) / chars
    out[:, 1] = _total(in_word(symbols) > 0, first) / some
    out[:, 2] = _total((in_word(upper) > 1) & (in_word(lower) == 0), first) / some
    out[:, 3] = _total(in_word(double) > 0, first) / some
    out[:, 4] = _total((in_word(data == ord("|")) > 0) & (ends - starts == 1), first) / some
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    out[:, 5] = _total(same, first) / some
    windows = np.maximum(n - 4, 1)
    out[:, 6] = np.where(n >= 20, 1 - np.array([len(x) for x in shingle_sets(data, offsets)]) / windows, 0)
    kinds = np.array([len(np.unique(words[a:z])) for a, z in zip(first[:-1].tolist(), first[1:].tolist())])
    out[:, 7] = np.where(n >= 20, 1 - kinds / some, 0)
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([offsets[:-1], breaks + 1, offsets[-1:]]))
    filled = edges[:-1] < edges[1:]
    lines = span_hashes(data, edges[:-1][filled], edges[1:][filled])
    line_row = np.searchsorted(offsets, edges[:-1][filled], "right") - 1
    order = np.lexsort((lines, line_row))
    distinct = np.bincount(line_row[order][run_starts(line_row[order], lines[order])], minlength=n_rows)
    n_lines = np.bincount(line_row, minlength=n_rows)
    out[:, 8] = np.where(n_lines >= 5, 1 - distinct / np.maximum(n_lines, 1), 0)
    plain_rows, hashes, keys = stems(data, offsets, langs)
    hit = np.isin(keys, terms).any(axis=0) if len(terms) else np.zeros(len(hashes), bool)
    out[:, 9] = np.bincount(plain_rows[hit], minlength=n_rows)
    order = np.lexsort((hashes[hit], plain_rows[hit]))
    of, which = plain_rows[hit][order], hashes[hit][order]
    out[:, 10] = np.bincount(of[run_starts(of, which)], minlength=n_rows)
    return n, out, words, first


def votes(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Votes of the labellers (1 bad, 0 fine, -1 none), a row per document."""
    bad = np.stack(
        [
            m[:, 0] >= 0.02,
            m[:, 1] >= 0.1,
            m[:, 2] >= 0.25,
            m[:, 3] >= 0.1,
            m[:, 2] + m[:, 3] >= 0.4,
            m[:, 4] >= 0.1,
            m[:, 1] + m[:, 4] >= 0.3,
            m[:, 5] >= 0.3,
            m[:, 5] + m[:, 7] >= 0.7,
            m[:, 6] >= 0.35,
            m[:, 8] >= 0.4,
            (m[:, 9] >= 2) & (1000 * m[:, 9] >= n),
            m[:, 10] >= 2,
        ],
        axis=1,
    ).astype(np.int8)
    # Shares of a few words say nothing; without a word no labeller has an opinion.
    bad[n < 8, :9] = -1
    bad[n < 40, 9:11] = -1
    bad[n == 0] = -1
    return bad


N_LABELLERS = 13


def _vote(batches: Iterable[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        n, m, _, _ = measure(data, offsets, language_keys(rows), terms)
        given = votes(n, m)
        text = (given + ord("1")).astype(np.uint8).view(f"S{N_LABELLERS}").ravel().astype(str)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(text)], names=["doc_id", "pattern"])


#: Labellers by the fault they look for: symbols, shouting, tables, repetition, abuse.
FAULTS = ((0, 1, 6), (2, 3, 4), (5, 6), (7, 8, 9, 10), (11, 12))


def decode_patterns(patterns: list[str]) -> np.ndarray:
    return np.frombuffer("".join(patterns).encode(), np.uint8).reshape(-1, N_LABELLERS).astype(int) - ord("1")


def class_weights(v: np.ndarray, shares: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Probability of each class (fine first, then the faults) given the votes."""
    logs = np.log(shares) + (v == 1) @ np.log(rates).T + (v == 0) @ np.log(1 - rates).T
    logs = np.exp(logs - logs.max(axis=1, keepdims=True))
    return logs / logs.sum(axis=1, keepdims=True)


def fit_accuracies(patterns: list[str], counts: list[int], rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the classes (fine, and one for each fault), and each labeller's rate of bad votes in each.

    Rates are estimated by expectation-maximisation from the counts of vote patterns; a labeller that
    abstains says nothing. A document may be bad in one way and fine in all others, so every fault is a class;
    labellers of a fault are held to find at least half of it and to blame at most 1 in 50 fine documents, and a
    few pseudo-counts keep rates off 0 and 1. So no class can change its meaning, however rare.
    """
    v, c = decode_patterns(patterns), np.array(counts, float)[:, None]
    own = np.zeros((len(FAULTS) + 1, N_LABELLERS), bool)
    for k, labellers in enumerate(FAULTS, 1):
        own[k, list(labellers)] = True
    rates = np.where(own, 0.7, 0.01)
    shares = np.array([0.9] + [0.1 / len(FAULTS)] * len(FAULTS))
    for _ in range(rounds):
        w = class_weights(v, shares, rates) * c
        shares = (w.sum(axis=0) + 1) / (c.sum() + len(shares))
        rates = (w.T @ (v == 1) + np.where(own, 7, 0.1)) / (w.T @ (v >= 0) + 10)
        rates = np.where(own, np.clip(rates, 0.5, 0.999), rates)
        rates[0] = np.minimum(rates[0], 0.02)
    return shares, rates


def posterior(v: np.ndarray, shares: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Probability that documents with these votes are bad."""
    return 1 - class_weights(v, shares, rates)[:, 0]


def features(n: np.ndarray, m: np.ndarray, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: the step of each measure (a fixed number a row), and a bucket per word."""
    shape = np.minimum(m, 1)
    steps = np.searchsorted(STEPS, shape, "left")
    steps = np.concatenate([steps, np.minimum(np.log2(n + 1).astype(int), 20)[:, None]], axis=1).astype(np.uint64)
    keys = mix(steps + _SALT[: steps.shape[1]] * np.uint64(64)) >> np.uint64(64 - BITS)
    return keys.astype(np.int64), (words >> np.uint64(64 - BITS)).astype(np.int64)


def score(weights: np.ndarray, shape: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = np.diff(first)
    sums = np.concatenate([[0.0], np.cumsum(weights[words])])
    logit = weights[shape].sum(axis=1) + (sums[first[1:]] - sums[first[:-1]]) / np.sqrt(np.maximum(n, 1))
    return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def _train(batches: Iterable[pa.RecordBatch], terms: np.ndarray, labels: dict[str, float]) -> Iterator[pa.RecordBatch]:
    """Logistic regression by mini-batches with a step per weight, on the bounded sample."""
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1.0)
    sample = []
    for rows, data, offsets in text_chunks(batches, 1 << 18):
        n, m, words, first = measure(data, offsets, language_keys(rows), terms)
        given = (votes(n, m) + ord("1")).astype(np.uint8).view(f"S{N_LABELLERS}").ravel().astype(str)
        shape, buckets = features(n, m, words, first)
        sample.append((shape, buckets.astype(np.int32), first, np.array([labels[x] for x in given])))
    for epoch in range(EPOCHS):
        for shape, words, first, y in sample:
            error = score(weights, shape, words, first) - y
            n = np.diff(first)
            grad = np.bincount(shape.ravel(), np.repeat(error, shape.shape[1]), 1 << BITS)
            grad += np.bincount(words, np.repeat(error / np.sqrt(np.maximum(n, 1)), n), 1 << BITS)
            squares += grad * grad
            weights -= 0.5 * grad / np.sqrt(squares)
    yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()], pa.binary())], names=["weights"])


def _count_stems(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        langs = language_keys(rows)
        row, _, keys = stems(data, offsets, langs)
        toxic = rows.column("toxic").to_numpy().astype(bool)
        # Once a document.
        order = np.lexsort((keys.ravel(), np.tile(row, len(keys))))
        of, key = np.tile(row, len(keys))[order], keys.ravel()[order]
        one = run_starts(of, key)
        of, key = of[one], key[one]
        distinct, where = np.unique(key, return_inverse=True)
        lang = np.zeros(len(distinct), np.uint64)
        lang[where] = langs[of]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(lang.view(np.int64)),
                pa.array(distinct.view(np.int64)),
                pa.array(np.bincount(where, toxic[of], len(distinct)).astype(np.int64)),
                pa.array(np.bincount(where, minlength=len(distinct)), pa.int64()),
            ],
            names=["lang", "key", "t", "n"],
        )
        kinds, where = np.unique(langs, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kinds.view(np.int64)),
                pa.nulls(len(kinds), pa.int64()),
                pa.array(np.bincount(where, toxic, len(kinds)).astype(np.int64)),
                pa.array(np.bincount(where, minlength=len(kinds)), pa.int64()),
            ],
            names=["lang", "key", "t", "n"],
        )


def learn_terms(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Keys of words and word beginnings that mark the toxic among at most ``sample`` labelled documents.

    By language: a term is in at least a fifth of the toxic texts and 200 times as likely there as elsewhere;
    copies count once. All such terms are taken; as each is in a fifth of the toxic texts, they are at most five times the
    words of one. Without labels there are none, and the labellers for
    abuse find nothing.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    labelled = language_texts(docs).join(materialize(chosen, "labelled-ids"), "doc_id")
    one = labelled.groupBy(F.xxhash64("text").alias("copy")).agg(F.max(F.struct("toxic", "text", "lang")).alias("one"))
    parts = one.select("one.*").mapInArrow(_count_stems, "lang long, key long, t long, n long")
    counts = materialize(parts.groupBy("lang", "key").agg(F.sum("t").alias("t"), F.sum("n").alias("n")), "stem-counts")
    totals = counts.filter("key IS NULL").select("lang", F.col("t").alias("toxic"), (F.col("n") - F.col("t")).alias("other"))
    marked = counts.filter("key IS NOT NULL").join(totals, "lang").filter(
        (F.col("t") >= 3) & (F.col("t") >= 0.2 * F.col("toxic"))
        & (F.col("t") * F.col("other") >= 200 * (F.col("n") - F.col("t") + 0.02) * F.col("toxic"))
    )
    keys = [r.key for r in marked.select("key").collect()]
    return np.sort(np.array(keys, np.int64).view(np.uint64))


def language_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text, lang``; the language is null where ``docs`` has none."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang")
    ).filter("doc_id IS NOT NULL")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, bad_votes, posterior, score, kept`` of every document.

    ``posterior`` is the label model's probability that the document is bad, ``score`` the linear
    scorer's; ``kept`` means a score below ``REJECT``. Abuse (terms learned from ``labels.toxic``) is bad too.

    Null and empty texts get no vote, the prior as posterior, and are kept or not as the scorer says of a
    text without words. Rows without a ``doc_id`` are left out, repeated rows are judged each, an empty table
    gives an empty one, other columns do not matter. ``labels`` may be empty.
    """
    texts = language_texts(docs)
    terms = learn_terms(docs, labels, sample)
    voted = materialize(texts.mapInArrow(lambda it: _vote(it, terms), "doc_id long, pattern string"), "votes")
    counted = voted.groupBy("pattern").count().orderBy("pattern").collect()
    if not counted:
        return voted.select("doc_id", F.lit(0).alias("bad_votes"), F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(True).alias("kept"))
    patterns = [r[0] for r in counted]
    model = fit_accuracies(patterns, [r[1] for r in counted])
    soft = dict(zip(patterns, posterior(decode_patterns(patterns), *model).tolist()))
    ids = materialize(voted.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "sample-ids")
    chosen = texts.join(ids, "doc_id", "left_semi")
    trained = chosen.repartition(1).sortWithinPartitions("doc_id", "text").mapInArrow(lambda it: _train(it, terms, soft), "weights binary")
    weights = np.frombuffer(trained.first()[0], np.float32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            n, m, words, first = measure(data, offsets, language_keys(rows), terms)
            given = votes(n, m)
            text = (given + ord("1")).astype(np.uint8).view(f"S{N_LABELLERS}").ravel().astype(str)
            p = score(weights, *features(n, m, words, first), first)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array((given == 1).sum(axis=1), pa.int32()),
                    pa.array([soft[x] for x in text.tolist()], pa.float64()),
                    pa.array(p, pa.float64()),
                    pa.array(p < REJECT),
                ],
                names=["doc_id", "bad_votes", "posterior", "score", "kept"],
            )

    return texts.mapInArrow(run, "doc_id long, bad_votes int, posterior double, score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without those that the scorer rejects; rows without a ``doc_id`` stay."""
    judged = classify(docs, labels, sample)
    gone = materialize(judged.filter("NOT kept").select("doc_id"), "rejected")
    return docs.join(gone, "doc_id", "left_anti")
