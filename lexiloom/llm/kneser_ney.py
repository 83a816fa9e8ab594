"""Perplexity under a modified Kneser-Ney model of byte n-grams, with bands per language.

Tasks count the n-grams of their rows and Spark sums them; continuation counts and discounts are aggregations of
the count tables. N-grams are bytes because their number is bounded by the script, not by the vocabulary: over
words it would grow with the corpus (nearly every second word pair here is new). The counts go to the tasks in
sorted arrays, from which numpy interpolates the probabilities of all orders.

``judge`` learns from the texts that pass the base rules and are hardly made of symbols, so that junk does not make itself
likely, and scores all texts. A text that is learned from is scored by the counts of all others: its own are taken off the highest order, and n-grams that
nothing else has off the continuation counts below, so that unseen n-grams fall back to shorter contexts. Counts of
single bytes and the discounts stay those of the corpus. A model larger than ``ENTRIES`` is taken in blocks of
context bytes, with one pass over the texts each; the sums of the blocks add up, and one block at a time is held.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import SPACE, mix, run_starts, span_hashes, text_chunks, word_bounds
from lexiloom.llm.minhash import _PLACE
from lexiloom.operators.joins import join_small
from lexiloom.session import materialize

ORDER = 5
ENTRIES = 8_000_000
HELD = 2_000_000
#: A text may be this many times as far from the median of its language as the quantiles of this share.
WIDER, TAIL = 2.0, 0.005
#: The least distance that is allowed, and the length at which that of short texts is twice as wide.
SPREAD, SHORT = 0.05, 400
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Symbols among the characters of a text that the model learns from.
MAX_SYMBOL_PERCENT = 1
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def ngram_keys(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The ``order`` bytes up to each byte, as a number; before a row's start there are zeros."""
    keys = data.astype(np.uint64)
    since = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(1, order):
        earlier = np.zeros(len(data), np.uint64)
        earlier[k:] = data[: len(data) - k]
        earlier[since < k] = 0
        keys |= earlier << np.uint64(8 * k)
    return keys


def _count(batches: Iterable[pa.RecordBatch], order: int, teach: bool) -> Iterator[pa.RecordBatch]:
    def out(keys, counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], names=["key", "c"]
        )

    def merged(parts):
        keys, counts = (np.concatenate(x) for x in zip(*parts))
        distinct, where = np.unique(keys, return_inverse=True)
        return distinct, np.bincount(where, counts, len(distinct)).astype(np.int64)

    parts, held = [], 0
    for _, data, offsets in text_chunks(batches):
        if len(data):
            keys, own = ngram_keys(data, offsets, order), np.repeat(learned(data, offsets, teach), np.diff(offsets))
            rest = np.unique(keys[~own])
            parts += [np.unique(keys[own], return_counts=True), (rest, np.zeros(len(rest), np.int64))]
            held += len(parts[-2][0]) + len(rest)
        if held > HELD:
            parts = [merged(parts)]
            held = len(parts[0][0])
            if held > HELD // 2:
                yield out(*parts[0])
                parts, held = [], 0
    if parts:
        yield out(*merged(parts))


def learned(data: np.ndarray, offsets: np.ndarray, teach: bool) -> np.ndarray:
    """Which rows the model learns from: all, or those that ``teaches`` names."""
    return teaches(data, offsets) if teach else np.ones(len(offsets) - 1, bool)


def count_ngrams(texts: DataFrame, order: int = ORDER, teach: bool = False) -> DataFrame:
    """``key, c``: every n-gram of the texts, and how often those that are learned from have it."""
    parts = texts.mapInArrow(lambda it: _count(it, order, teach), "key long, c long")
    return parts.groupBy("key").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more."""
    n = dict(counts.filter("c <= 4").groupBy("c").count().collect())
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [
        1 - 2 * y * n2 / n1 if n1 else 0.5,
        2 - 3 * y * n3 / n2 if n2 else 1.0,
        3 - 4 * y * n4 / n3 if n3 else 1.5,
    ]
    return [min(max(d, 0.1), k - 0.1) for k, d in enumerate(raw, 1)]


def lower_orders(counts: DataFrame, order: int = ORDER) -> tuple[np.ndarray, dict[int, list[float]]]:
    """Probabilities of single bytes, and the discounts of every order from 2 on, by continuation counts."""
    discounts, table = {}, counts.filter("c > 0")
    for k in range(order, 0, -1):
        if k < order:
            # A lower order counts the distinct bytes that precede.
            suffix = F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1))
            table = materialize(table.groupBy(suffix.alias("key")).agg(F.count("*").alias("c")), f"continuations-{k}")
        discounts[k] = _discounts(table)
    singles = np.zeros(256)
    found = np.array(table.collect(), np.int64).reshape(-1, 2)
    if len(found):
        cut = _cut(found[:, 1], discounts[1])
        singles[found[:, 0]] = found[:, 1] - cut
        singles = (singles + cut.sum() / 256) / found[:, 1].sum()
    return singles, discounts


def _blocks(ends: list[tuple[int, int]], entries: int) -> list[list[int]]:
    """Context bytes, most n-grams first, in as few blocks of about ``entries`` n-grams as they fit in one by one."""
    blocks: list[list] = []
    for end, n in sorted(ends, key=lambda x: (-x[1], x[0])):
        fit = next((b for b in blocks if b[0] + n <= entries), None)
        if fit is None:
            blocks.append(fit := [0, []])
        fit[0] += n
        fit[1].append(end)
    return [b[1] for b in blocks]


def _cut(counts: np.ndarray, discounts: list[float]) -> np.ndarray:
    """What is taken off each count; nothing off 0."""
    return np.array([0.0, *discounts])[np.minimum(counts, 3)]


class Model:
    """Interpolated modified Kneser-Ney of the n-grams of some context ends, in sorted arrays per order.

    The lower orders follow from the highest: all n-grams that end in the same context byte are here. ``singles`` are
    the probabilities of single bytes, ``discounts`` those of every order from 2 on.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, singles: np.ndarray, discounts: dict[int, list[float]]):
        self.order, self.singles, self.discounts, self.levels = order, singles, discounts, {}
        at = np.argsort(keys)
        keys, counts = keys[at].astype(np.uint64), counts[at].astype(np.int64)
        for k in range(order, 1, -1):
            contexts = keys >> np.uint64(8)
            first = run_starts(contexts)
            if len(first):
                totals, freed = np.add.reduceat(counts, first), np.add.reduceat(_cut(counts, discounts[k]), first)
            else:
                totals, freed = counts, counts.astype(float)
            self.levels[k] = keys, counts, contexts[first], totals, freed
            keys, where = np.unique(keys & self.mask(k - 1), return_inverse=True)
            counts = np.bincount(where, counts > 0, len(keys)).astype(np.int64)

    @staticmethod
    def mask(k: int) -> np.uint64:
        return np.uint64((1 << (8 * k)) - 1)

    def log_p(self, pairs: np.ndarray, own: np.ndarray, held_out: bool) -> np.ndarray:
        """Logarithms of the probabilities of ``pairs``, sorted and distinct: row, then n-gram.

        With ``held_out``, ``own`` of each n-gram's occurrences are the row's: they are taken off, and so are
        n-grams that nothing else has from the continuation counts below, down to order 2.
        """
        full, steps = self.mask(self.order), []
        own = own.astype(np.int64) if held_out else np.zeros(len(pairs), np.int64)
        for k in range(self.order, 1, -1):
            keys, counts, contexts, totals, freed = self.levels[k]
            all_ = counts[np.searchsorted(keys, pairs & self.mask(k))]
            left = all_ - own
            context = pairs >> np.uint64(8)
            first = run_starts(context)
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pairs))))
            at = np.searchsorted(contexts, context[first] & self.mask(k - 1))
            kept = _cut(left, self.discounts[k])
            total = totals[at] - np.add.reduceat(own, first)
            free = freed[at] - np.add.reduceat(_cut(all_, self.discounts[k]) - kept, first)
            lower, where = np.unique((pairs & ~full) | (pairs & self.mask(k - 1)), return_inverse=True)
            steps.append((left - kept, total[group], np.maximum(free, 0)[group], where))
            own = np.bincount(where, (left == 0) & (own > 0), len(lower)).astype(np.int64) if held_out else np.zeros(len(lower), np.int64)
            pairs = lower
        p = self.singles[(pairs & np.uint64(255)).astype(np.int64)]
        for seen, total, free, where in reversed(steps):
            rest = p[where]
            # Where nothing is left of a context, the shorter one stands for it.
            p = np.where(total > 0, (seen + free * rest) / np.maximum(total, 1), rest)
        return np.log(p)


def _row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _score(batches: Iterable[pa.RecordBatch], model, ends: np.ndarray, held_out: bool, teach: bool) -> Iterator[pa.RecordBatch]:
    table = model.value
    order = table.order
    for rows, data, offsets in text_chunks(batches):
        keys = ngram_keys(data, offsets, order)
        row = np.repeat(np.arange(rows.num_rows, dtype=np.uint64), np.diff(offsets))
        pairs = (row << np.uint64(8 * order) | keys)[ends[(keys >> np.uint64(8) & np.uint64(255)).astype(np.int64)]]
        pairs.sort()
        first = run_starts(pairs)
        own = np.diff(np.append(first, len(pairs)))
        at = (pairs[first] >> np.uint64(8 * order)).astype(np.int64)
        taught = learned(data, offsets, teach)
        logs = table.log_p(pairs[first], own * taught[at], held_out) if len(pairs) else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                rows.column("lang"),
                pa.array(np.bincount(at, logs * own, rows.num_rows)),
                pa.array(np.bincount(at, own, rows.num_rows).astype(np.int64)),
                pa.array(taught),
            ],
            names=["doc_id", "lang", "log_p", "n_bytes", "taught"],
        )


def language_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, text``; nulls count as empty."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    ).filter("doc_id IS NOT NULL")


def perplexities(
    docs: DataFrame, order: int = ORDER, entries: int = ENTRIES, held_out: bool = False, teach: bool = False
) -> DataFrame:
    """``doc_id, lang, n_bytes, taught, log_perplexity`` of every document; without text null.

    With ``held_out`` a row is scored by the counts of all others. With ``teach`` the counts are those of the
    documents that look like prose (``taught``), and all are scored.
    """
    texts = language_texts(docs)
    counts = materialize(count_ngrams(texts, order, teach), "ngrams")
    singles, discounts = lower_orders(counts, order)
    end = F.shiftright("key", 8).bitwiseAND(F.lit(255))
    parts = texts.select("doc_id", "lang", F.lit(0.0).alias("log_p"), F.lit(0).cast("long").alias("n_bytes"), F.lit(False).alias("taught"))
    context = docs.sparkSession.sparkContext
    for block in _blocks([tuple(r) for r in counts.groupBy(end).count().collect()], entries):
        own = counts.filter(end.isin(block)).toArrow()
        keys, n = (own.column(x).to_numpy() for x in ("key", "c"))
        shared = context.broadcast(Model(keys, n, order, singles, discounts))
        here = np.zeros(256, bool)
        here[block] = True
        part = texts.mapInArrow(
            lambda it, shared=shared, here=here: _score(it, shared, here, held_out, teach),
            "doc_id long, lang string, log_p double, n_bytes long, taught boolean",
        )
        # One block at a time: its model is let go before the next is read.
        parts = parts.unionByName(materialize(part, "block-scores"))
        shared.destroy()
    sums = parts.groupBy("doc_id", "lang").agg(
        F.sum("log_p").alias("log_p"), F.sum("n_bytes").alias("n_bytes"), F.max("taught").alias("taught")
    )
    return sums.select("doc_id", "lang", "n_bytes", "taught", F.when(F.col("n_bytes") > 0, -F.col("log_p") / F.col("n_bytes")).alias("log_perplexity"))


def bands(scored: DataFrame) -> DataFrame:
    """``lang, middle, below, above``: median of the log perplexity, and how far from it a text may be.

    That is ``WIDER`` times as far as the ``TAIL`` quantiles of the texts that are learned from, and at least ``SPREAD``. A language
    without such texts goes by all it has.
    """

    def of_taught(column: Column, share: float) -> Column:
        return F.coalesce(F.percentile_approx(F.when(F.col("taught"), column), share, 10_000), F.percentile_approx(column, share, 10_000))

    middle = materialize(scored.groupBy("lang").agg(of_taught(F.col("log_perplexity"), 0.5).alias("middle")), "medians")
    away = (F.col("log_perplexity") - F.col("middle")) / _width(F.col("n_bytes"))
    # A row per language: broadcast, or else salted, so that no language is a hot key.
    tails = join_small(scored, middle, ["lang"], ["doc_id"]).groupBy("lang").agg(
        (-of_taught(away, TAIL)).alias("below"), of_taught(away, 1 - TAIL).alias("above")
    )
    limits = (F.greatest(WIDER * F.col(x), F.lit(SPREAD)).alias(x) for x in ("below", "above"))
    return middle.join(tails, "lang").select("lang", "middle", *limits)


def _width(n_bytes: Column) -> Column:
    """How much wider the band is for a text of this length."""
    return F.lit(1.0) + F.lit(float(SHORT)) / F.greatest(n_bytes, F.lit(1))


def word_measures(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Words, their characters, symbols, and words in repeated windows of every row."""
    starts, ends, row = word_bounds(data, offsets)
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(row, np.arange(len(offsets)))
    repeated = np.zeros(len(words) + 1, np.int64)
    n = max(0, len(words) - WINDOW + 1)
    if n:
        windows = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            windows += words[k : k + n] * _PLACE[k]
        windows = mix(windows) + mix(row[:n].astype(np.uint64) + np.uint64(1))
        place = np.flatnonzero(row[:n] == row[WINDOW - 1 :])
        order = np.argsort(windows[place])
        run = windows[place][order]
        twice = np.zeros(len(run), bool)
        twice[1:] = run[1:] == run[:-1]
        twice[:-1] |= run[1:] == run[:-1]
        at = place[order[twice]]
        np.add.at(repeated, at, 1)
        np.add.at(repeated, at + WINDOW, -1)
    repeats = np.cumsum(repeated)[:-1] > 0
    points = ((data & 0xC0) != 0x80) & ~SPACE[data]
    return [np.diff(first), _row_sums(points, offsets), _row_sums(SYMBOL[data], offsets), _row_sums(repeats, first)]


def repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines of every row that are not blank and equal an earlier one."""
    n_rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    line_row = np.searchsorted(offsets, begin, "right") - 1
    stop = np.minimum(np.append(begin[1:], len(data)), offsets[line_row + 1])
    stop = stop - ((stop > begin) & (data[stop - 1] == 10))
    solid = np.concatenate([[0], np.cumsum(~SPACE[data])])
    filled = solid[stop] > solid[begin]
    begin, stop, line_row = begin[filled], stop[filled], line_row[filled]
    lines = span_hashes(data, begin, stop)
    order = np.lexsort((lines, line_row))
    distinct = line_row[order][run_starts(line_row[order], lines[order])]
    return np.bincount(line_row, minlength=n_rows) - np.bincount(distinct, minlength=n_rows)


def base_rules(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def teaches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that the model learns from: those that pass the base rules and are hardly made of symbols."""
    n_words, chars, symbols, repeats = word_measures(data, offsets)
    return ~base_rules(n_words, repeats) & (100 * symbols <= MAX_SYMBOL_PERCENT * chars)


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        *counts, repeats = word_measures(data, offsets)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (*counts, repeated_lines(data, offsets), repeats))],
            names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        )


def judge(docs: DataFrame, order: int = ORDER, entries: int = ENTRIES) -> DataFrame:
    """Base rules and perplexity band of every document.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lang, perplexity, low,
    high``: words are runs without ASCII white space; ``base_failed`` means fewer than ``MIN_WORDS`` words or more than
    ``MAX_REPEAT_PERCENT`` in 100 of them in 5-word windows that the text holds twice. ``kept`` means that neither
    that holds nor the perplexity (per byte) leaves the language's band ``low`` to ``high``.

    Null and empty texts have no words, fail and have no perplexity. Languages that are null are one language. Rows
    without a ``doc_id`` are left out; repeated rows of one id share one perplexity, that of their texts together, and
    give a row each. Empty tables give empty tables, other columns do not matter.
    """
    texts = language_texts(docs)
    measured = texts.mapInArrow(
        _measure, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    )
    scored = materialize(perplexities(docs, order, entries, held_out=True, teach=True), "perplexities")
    some = scored.filter("log_perplexity IS NOT NULL")
    limits = materialize(bands(some), "bands")
    none = scored.filter("log_perplexity IS NULL").select("*", *(F.lit(None).cast("double").alias(x) for x in ("middle", "below", "above")))
    rated = join_small(some, limits, ["lang"], ["doc_id"]).unionByName(none)
    width = _width(F.col("n_bytes"))
    rated = rated.select(
        "doc_id",
        "lang",
        F.exp("log_perplexity").alias("perplexity"),
        F.exp(F.col("middle") - F.col("below") * width).alias("low"),
        F.exp(F.col("middle") + F.col("above") * width).alias("high"),
    )
    rated = rated.groupBy("doc_id").agg(F.min(F.struct("lang", "perplexity", "low", "high")).alias("r"))
    out = measured.join(rated, "doc_id").select(*measured.columns, "r.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    inside = F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    return out.select(*measured.columns, failed.alias("base_failed"), (~failed & inside).alias("kept"), "lang", "perplexity", "low", "high")
