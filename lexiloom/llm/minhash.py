"""Near-duplicate documents by minhash with tensored banding.

Few small *half keys*, each of a few minhashes, are computed per document; the keys of the
hash tables are all pairs of two half keys. ``h`` half keys give ``h * (h - 1) / 2`` tables, so the
number of minhashes grows with the square root of the number of tables. Both numbers follow from the
threshold (``half_keys``), so that a pair at it is missed, as at most one half key agrees, less than once in
``1 / MISSED``: at 0.85 there are 21 half keys of 5 minhashes (210 tables of 10), at 0.80 there are 23 of 4 (253 tables
of 8). Of pairs of similarity 0.4, as documents have that share a long passage, one in fifty is compared at 0.85
and one in nine at 0.80.

Documents with the same shingles are one class, whatever their number, and only the class's least id
takes part. A half key that one class alone has is dropped before pairs are formed. Within a
table's bucket members are first compared with one leader, then with another, and their
components are contracted. Members still apart are compared with each other, at the first table that a pair
shares and if sketches of ``BITS`` one-bit minhashes are not more than ``DEVIATIONS`` standard deviations below the
similarity (one in a million pairs that are alike). Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import TO_LOWER, mix, span_hashes, text_chunks, texts_of, word_bounds
from lexiloom.llm.components import components
from lexiloom.session import materialize

WORDS = 5
PERCENT = 85
#: Share of pairs at the threshold that may be missed, chance aimed at that a half key of theirs agrees, most half keys.
MISSED, AGREE, MOST = 1e-4, 0.42, 99
BITS, DEVIATIONS = 1024, 5
_RANDOM = np.random.default_rng(20240909)
_FLIP = _RANDOM.integers(0, 2**63, 105, dtype=np.uint64)
_TIMES = _RANDOM.integers(0, 2**63, 105, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BIT_FLIP = _RANDOM.integers(0, 2**32, BITS, dtype=np.uint32)
_BIT_TIMES = _RANDOM.integers(0, 2**31, BITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def missed(share: float, halves: int, per_half: int) -> float:
    """How likely fewer than two half keys of a pair of that similarity agree."""
    agree = share**per_half
    return (1 - agree) ** halves + halves * agree * (1 - agree) ** (halves - 1)


def half_keys(percent: int) -> tuple[int, int]:
    """Half keys, and minhashes in each, for a threshold; alike sets need two of one."""
    if percent >= 100:
        return 2, 1
    share = percent / 100
    per_half = max(1, round(math.log(AGREE) / math.log(share)))
    halves = 2
    while missed(share, halves, per_half) >= MISSED:
        halves += 1
        if halves > MOST:
            raise ValueError(f"too many half keys for {percent} percent")
    return halves, per_half


def _minhash_keys(k: int) -> tuple[np.uint64, np.uint64]:
    """What minhash ``k`` flips and multiplies by."""
    if k < len(_FLIP):
        return _FLIP[k], _TIMES[k]
    flip, times = mix(np.array([2 * k, 2 * k + 1], np.uint64) * _PLACE[12])
    return flip, times | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a short text is one shingle, an empty one none."""
    data = TO_LOWER[data]
    starts, ends, rows = word_bounds(data, offsets)
    hashes = span_hashes(data, starts, ends)
    windows = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        windows += hashes[k : k + len(windows)] * _PLACE[k]
    windows = mix(windows)
    first = np.searchsorted(rows, np.arange(len(offsets)))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(windows[a : b - words + 1]))
        else:
            whole = (hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)
            out.append(mix(whole) if b > a else windows[:0])
    return out


def _sign(batches: Iterable[pa.RecordBatch], words: int, n_halves: int, per_half: int) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        sets = shingle_sets(data, offsets, words)
        sizes = np.array([len(x) for x in sets])
        flat = np.concatenate([*sets, np.zeros(1, np.uint64)])
        some = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[some]
        halves = np.zeros((len(sets), n_halves), np.uint64)
        sums = np.zeros((len(sets), 2), np.uint64)
        if some.any():
            flat = flat[:-1]
            for half in range(n_halves):
                key = np.full(len(starts), half, np.uint64)
                for k in range(half * per_half, (half + 1) * per_half):
                    flip, times = _minhash_keys(k)
                    key = mix(key ^ np.minimum.reduceat((flat ^ flip) * times, starts))
                halves[some, half] = key
            sums[some, 0] = np.add.reduceat(mix(flat + _PLACE[10]), starts)
            sums[some, 1] = np.add.reduceat(mix(flat + _PLACE[11]), starts)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(sets) + 1) * n_halves, pa.int32()), pa.array(halves.ravel().view(np.int64))
        )
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(sums[:, 0].view(np.int64)),
                pa.array(sums[:, 1].view(np.int64)),
                lists,
            ],
            names=["doc_id", "n_shingles", "set1", "set2", "halves"],
        )


def signatures(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, set1, set2, halves``: size and fingerprint of the shingle set, half keys."""
    ddl = "doc_id long, n_shingles long, set1 long, set2 long, halves array<long>"
    halves, per_half = half_keys(percent)
    return texts_of(docs).mapInArrow(lambda it: _sign(it, words, halves, per_half), ddl)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One-bit minhashes of every set, ``BITS`` of them in 64-bit words."""
    some = np.array([len(x) > 0 for x in sets], bool)
    bits = np.zeros((len(sets), BITS), np.uint8)
    if some.any():
        flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        sizes = np.array([len(x) for x in sets])
        starts = (np.cumsum(sizes) - sizes)[some]
        for k in range(BITS):
            least = np.minimum.reduceat((flat ^ _BIT_FLIP[k]) * _BIT_TIMES[k], starts)
            bits[some, k] = mix(least.astype(np.uint64)) & np.uint64(1)
    return np.packbits(bits, axis=1).view(np.int64)


def _sets(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        sets = shingle_sets(data, offsets, words)
        words_of = pa.ListArray.from_arrays(
            pa.array(np.arange(len(sets) + 1) * (BITS // 64), pa.int32()), pa.array(sketches(sets).ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([x.tobytes() for x in sets], pa.binary()), words_of],
            names=["doc_id", "shingles", "sketch"],
        )


def _confirm(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("left_set").to_pylist(), batch.column("right_set").to_pylist()
        linked = []
        for a, b in zip(left, right):
            both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            linked.append(100 * shared >= percent * (len(both) - shared))
        keep = pa.array(linked, pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


def _table_rows(halves: DataFrame) -> DataFrame:
    """``key, place, rep, n`` for every pair of shared half keys of a class; ``place`` says which two they are."""
    lists = halves.groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("half", "value"))).alias("own"))
    pairs = F.expr(
        "flatten(transform(own, (x, i) -> transform(slice(own, i + 2, 99), "
        "y -> struct(xxhash64(x.half, y.half, x.value, y.value) AS key, 100 * x.half + y.half AS place))))"
    )
    return lists.filter(F.size("own") > 1).select("rep", "n", F.inline(pairs))


def _sides(side: str) -> list[tuple[str, str]]:
    return [("rep", side), ("n", side + "n"), ("comp", side + "c"), ("halves", side + "halves"), ("sketch", side + "sketch")]


def _close(percent: int) -> Column:
    """Sizes that allow the similarity."""
    return F.lit(100) * F.least("an", "bn") >= F.lit(percent) * F.greatest("an", "bn")


def _alike(percent: int) -> Column:
    """Sketches that do not rule out the similarity."""
    agree = (1 + percent / 100) / 2
    most = BITS * (1 - agree) + DEVIATIONS * (BITS * agree * (1 - agree)) ** 0.5
    words = [F.bit_count(F.get("asketch", k).bitwiseXOR(F.get("bsketch", k))) for k in range(BITS // 64)]
    return sum(words[1:], words[0]) <= int(most)


def _first_table() -> Column:
    """Whether ``place`` names the first two half keys that agree, so that a pair comes from one table only."""
    same = "array_join(zip_with(ahalves, bhalves, (x, y) -> if(x = y, '1', '0')), '')"
    return F.expr(f"place = 100 * (instr({same}, '1') - 1) + locate('1', {same}, instr({same}, '1') + 1) - 1")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    A document's set is its distinct shingles of ``words`` words (A-Z lower-cased); with fewer words it
    is the whole sequence, without words (or text) it is empty and linked with nothing. Documents
    are linked if 100 * intersection >= ``percent`` * union; ``component_id`` is the least id reachable.

    Rows without a ``doc_id`` are left out. Repeated rows of an id give equal results if their texts are
    equal; of unlike texts each row stands for itself under that id. Empty tables give empty
    tables, and other columns do not matter.
    """
    signed = materialize(signatures(docs, words, percent), "signatures")
    reps = materialize(
        signed.filter("n_shingles > 0")
        .groupBy("set1", "set2")
        .agg(F.min(F.struct("doc_id", "n_shingles", "halves")).alias("least"))
        .select("set1", "set2", F.col("least.doc_id").alias("rep"), F.col("least.n_shingles").alias("n"), F.col("least.halves").alias("halves")),
        "classes",
    )
    halves = materialize(reps.select("rep", "n", F.posexplode("halves").alias("half", "value")), "half-keys")
    shared = materialize(
        halves.groupBy("half", "value").count().filter("count > 1").select("half", "value"), "shared-half-keys"
    )
    tables = materialize(_table_rows(halves.join(shared, ["half", "value"], "left_semi")), "tables")
    buckets = materialize(
        tables.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high").select("key"), "buckets"
    )
    tables = materialize(tables.join(buckets, "key", "left_semi"), "shared-tables")
    # Full sets of the classes that share a bucket.
    wanted = tables.select(F.col("rep").alias("doc_id")).distinct()
    own = texts_of(docs).join(wanted, "doc_id", "left_semi")
    sets = materialize(own.mapInArrow(lambda it: _sets(it, words), "doc_id long, shingles binary, sketch array<long>"), "shingle-sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        full = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left_set")), "a")
        full = full.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right_set")), "b")
        return full.select("a", "b", "left_set", "right_set").mapInArrow(lambda it: _confirm(it, percent), "a long, b long")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.filter(_close(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    found, tested = None, None
    placed = tables.withColumn("comp", F.col("rep"))
    for turn in ("least", "other", "rest"):
        mixed = placed.groupBy("key").agg(
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            (F.min if turn == "least" else F.max)(F.struct("rep", "n", "comp")).alias("lead"),
        ).filter("low <> high")
        leaders = materialize(mixed.select("key", "lead.*"), f"leaders-{turn}")
        if turn == "rest":
            live = placed.join(leaders.select("key"), "key", "left_semi")
            known = reps.select("rep", "halves").join(sets.select(F.col("doc_id").alias("rep"), "sketch"), "rep")
            live = materialize(live.join(known, "rep"), "still-apart")
            left = live.select("key", "place", *(F.col(x).alias(y) for x, y in _sides("a")))
            right = live.select("key", *(F.col(x).alias(y) for x, y in _sides("b")))
            fits = (F.col("ac") < F.col("bc")) & _close(percent) & _alike(percent) & _first_table()
            pairs = left.join(right, (left["key"] == right["key"]) & fits)
        else:
            left = leaders.select("key", F.col("rep").alias("a"), F.col("n").alias("an"), F.col("comp").alias("ac"))
            right = placed.select("key", F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("comp").alias("bc"))
            pairs = right.join(left, "key").filter("ac <> bc")
        pairs = ordered(pairs)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, f"pairs-{turn}")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = confirm(pairs)
        if found is not None:
            links = links.unionByName(found.select(F.col("node").alias("a"), F.col("comp").alias("b")))
        found = components(links)
        if turn != "rest":
            placed = materialize(
                tables.join(found, F.col("rep") == F.col("node"), "left").select("key", "place", "rep", "n", F.coalesce("comp", "rep").alias("comp")),
                f"placed-{turn}",
            )
    classes = reps.select("set1", "set2", "rep").join(found, F.col("rep") == F.col("node"), "left")
    classes = materialize(classes.select("set1", "set2", F.coalesce("comp", "rep").alias("component")), "class-components")
    # An empty set has no class; it is its own component.
    return signed.join(classes, ["set1", "set2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without those that are linked to a smaller id; one document of each component stays.

    Rows without a ``doc_id`` stay.
    """
    gone = near_duplicates(docs, words, percent).filter("component_id <> doc_id").select("doc_id")
    return docs.join(materialize(gone, "near-duplicates"), "doc_id", "left_anti")
