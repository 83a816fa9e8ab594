"""Phrase collocations from a truncated suffix tree that is built in independent groups of word prefixes.

1. Tasks turn runs of texts into batches: the distinct words, and a number into them per word, with marks between pieces.
   Spark counts the words. Only words as frequent as a candidate must be get an id; the others end a suffix.
2. Every batch sorts its suffixes, cut after three words, and adds up equal ones: the leaves of its part of the tree.
3. Vertical partitioning. Word prefixes are grouped in id order until their words' counts reach the budget of a group. A group
   whose leaves exceed it (that of a word which is everywhere, or of a pair which is) is cut again at longer prefixes: the second and
   third word, at places drawn evenly from its leaves.
4. Each group is one subtree: its leaves are sorted once more, and the count of a phrase is the total of the leaves below its node.
   Only a pair whose leaves were cut apart is added up afterwards.
5. Candidates are few. Scores, containment and ranks are DataFrame joins over them, in exact decimals.

Words go by 64-bit hashes until they have an id. Hashes are compared with the words themselves; a frequent word that shares its hash with
another makes the counting start over with another hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import TO_LOWER, mix, run_starts, span_hashes, text_chunks, word_bounds
from lexiloom.llm.maxent import pack, unpack
from lexiloom.operators.topk import top_k
from lexiloom.session import materialize

MIN_COUNT, TOP, ABSORB_PERCENT = 10, 2000, 50
#: Bytes of text in a batch, and leaves that a group may have.
BATCH, BUDGET = 1 << 23, 1 << 21
#: Groups of one cut, and drawn leaves for each of them.
FAN, DRAWN = 4096, 16
#: Ids in a range whose counts are added up to place the first cuts.
RANGES = 4096
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BLANKED = TO_LOWER.copy()
BLANKED[BREAK] = 0x20

PARSED = pa.schema(
    [("batch", pa.int64()), ("place", pa.int32()), ("key", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("tokens", pa.binary())]
)
PARSED_DDL = "batch long, place int, key long, lang string, word string, n long, tokens binary"


def word_key(hashes: np.ndarray, salt: int) -> np.ndarray:
    return mix(hashes + np.uint64(salt))


class Words:
    """Words of a batch: keys in text order, where pieces begin, and the distinct ones as strings."""

    def __init__(self, salt: int):
        self.salt, self.size = salt, 0
        self.keys: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []
        self.distinct: list[tuple[np.ndarray, pa.Array, pa.Array]] = []

    def add(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]) -> None:
        self.size += len(data)
        plain = BLANKED[data]
        starts, ends, rows = word_bounds(plain, offsets)
        if not len(starts):
            return
        codes, kind = np.unique(np.array(langs, object), return_inverse=True)
        lang = np.array([hash_text(x) for x in codes], np.uint64)[kind]
        keys = word_key(span_hashes(plain, starts, ends) ^ mix(lang)[rows], self.salt)
        breaks = np.concatenate([[0], np.cumsum(BREAK[data])])[starts]
        begins = np.ones(len(starts), bool)
        begins[1:] = (breaks[1:] != breaks[:-1]) | (rows[1:] != rows[:-1])
        self.keys.append(keys)
        self.begins.append(begins)
        own, first, where = np.unique(keys, return_index=True, return_inverse=True)
        # Words that are not the first one of their key, byte by byte, are listed too.
        listed = np.concatenate([first, np.flatnonzero(~same_words(plain, starts, ends, kind[rows], first[where]))])
        sizes = ends[listed] - starts[listed]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts[listed] - bounds[:-1], sizes) + np.arange(bounds[-1])
        text = pa.StringArray.from_buffers(len(listed), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(plain[at].tobytes()))
        self.distinct.append((keys[listed], text, pa.array(codes[kind][rows[listed]], pa.string())))

    def rows(self, batch: int) -> Iterator[pa.RecordBatch]:
        """A row per distinct word, and one with the batch's words by their place (from 1; 0 ends a piece).

        Another word with the key of a listed one gets place 0.
        """
        if not self.keys:
            return
        keys, begins = np.concatenate(self.keys), np.concatenate(self.begins)
        distinct, where, n = np.unique(keys, return_inverse=True, return_counts=True)
        tokens = np.zeros(len(keys) + int(begins.sum()), np.uint32)
        tokens[np.arange(len(keys)) + np.cumsum(begins)] = where + 1
        every, words, langs = np.concatenate([x[0] for x in self.distinct]), *(pa.concat_arrays([x[k] for x in self.distinct]) for k in (1, 2))
        _, first, of = np.unique(every, return_index=True, return_inverse=True)
        leads = pa.array(first[of])
        other = ~(pc.equal(words, words.take(leads)).to_numpy(False) & pc.equal(langs, langs.take(leads)).to_numpy(False))
        listed = np.concatenate([first, np.flatnonzero(other)])
        size, more = len(listed), len(listed) - len(first)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size, batch)),
                pa.array(np.append(np.arange(1, len(first) + 1), np.zeros(more, int)), pa.int32()),
                pa.array(every[listed].view(np.int64)),
                langs.take(pa.array(listed)),
                words.take(pa.array(listed)),
                pa.array(np.append(n, np.ones(more, int)), pa.int64()),
                pa.nulls(size, pa.binary()),
            ],
            schema=PARSED,
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip([batch, None, None, None, None, None, pack(tokens)], PARSED)], schema=PARSED
        )


def same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, langs: np.ndarray, leads: np.ndarray) -> np.ndarray:
    """Whether each word has the bytes and the language of the word at its lead."""
    sizes = ends - starts
    same = (sizes == sizes[leads]) & (langs == langs[leads])
    size = np.where(same, sizes, 0)
    bounds = np.cumsum(size)
    step = np.arange(bounds[-1]) - np.repeat(bounds - size, size)
    differs = data[np.repeat(starts, size) + step] != data[np.repeat(starts[leads], size) + step]
    same[np.repeat(np.arange(len(starts)), size)[differs]] = False
    return same


def hash_text(text: str) -> int:
    raw = np.frombuffer(text.encode(), np.uint8)
    return int(span_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)]))[0])


def _parse(rows: Iterable[pa.RecordBatch], size: int, salt: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 24
    words = Words(salt)
    for part, data, offsets in text_chunks(rows):
        words.add(data, offsets, part.column("lang").to_pylist())
        if words.size >= size:
            yield from words.rows(number)
            words, number = Words(salt), number + 1
    yield from words.rows(number)


def count_words(docs: DataFrame, batch_bytes: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    """Parsed batches, and the counts of words: ``key, lang, word, n``."""
    salt = 0
    while True:
        parsed = materialize(docs.mapInArrow(lambda it, salt=salt: _parse(it, batch_bytes, salt), PARSED_DDL), "phrase-batches")
        # A word has a row per batch, however frequent.
        dealt = parsed.filter("tokens IS NULL").select("key", "lang", "word", "n").repartition("key")
        counts = materialize(dealt.groupBy("key", "lang", "word").agg(F.sum("n").alias("n")), "word-counts")
        frequent = counts.filter(F.col("n") >= min_count).select("key")
        if counts.join(frequent, "key", "left_semi").groupBy("key").count().filter("count > 1").isEmpty():
            return parsed, counts
        salt += 1


def numbered(counts: DataFrame, min_count: int) -> DataFrame:
    """``id, key, lang, word, n`` of the frequent words, with ids from 1 without gaps."""
    spark = counts.sparkSession
    kept = materialize(counts.filter(F.col("n") >= min_count).withColumn("at", F.monotonically_increasing_id()), "frequent-words")
    part = F.shiftright("at", 33)
    sizes = sorted(tuple(r) for r in kept.groupBy(part.alias("part")).count().collect())
    firsts, total = [], 1
    for p, n in sizes:
        firsts.append((p, total - (p << 33)))
        total += n
    shifts = spark.createDataFrame(firsts, "part long, shift long")
    ids = kept.withColumn("part", part.cast("long")).join(shifts, "part").select((F.col("at") + F.col("shift")).alias("id"), "key", "lang", "word", "n")
    return materialize(ids, "word-ids")


def first_cuts(words: DataFrame, groups: int) -> np.ndarray:
    """Ids at which groups of about equally many occurrences begin, the first left out."""
    top = words.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    width = top // RANGES + 1
    sums = sorted(tuple(r) for r in words.groupBy(F.floor(F.col("id") / width).alias("r")).agg(F.sum("n")).collect())
    heavy = sum(n for _, n in sums) / max(1, groups)
    crowded = [r for r, n in sums if n > heavy]
    # Inside ranges that are more than a group, word by word: at most as many ranges as groups.
    single = words.filter(F.floor(F.col("id") / width).isin(crowded)).select("id", "n") if crowded and width > 1 else None
    places = [(r * width, n) for r, n in sums if single is None or r not in set(crowded)]
    places += [] if single is None else [tuple(r) for r in single.collect()]
    cuts, total = [], 0.0
    for first, n in sorted(places):
        if total and total + n > heavy:
            cuts.append(first)
            total = 0.0
        total += n
    return np.array(cuts, np.uint64)


CELLS = "grp long, sub int, n long, pairs binary, thirds binary, counts binary, drawn binary"
CELL_SCHEMA = pa.schema(
    [("grp", pa.int64()), ("sub", pa.int32()), ("n", pa.int64()), ("pairs", pa.binary()), ("thirds", pa.binary()), ("counts", pa.binary()), ("drawn", pa.binary())]
)


def add_up(pairs: np.ndarray, thirds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves in order, equal ones added up. A pair holds two ids, the first one above."""
    order = np.argsort(thirds, kind="stable")
    order = order[np.argsort(pairs[order], kind="stable")]
    pairs, thirds, counts = pairs[order], thirds[order], counts[order]
    runs = run_starts(pairs, thirds)
    return pairs[runs], thirds[runs], np.add.reduceat(counts, runs) if len(runs) else counts


def cell(group: int, sub: int, pairs: np.ndarray, thirds: np.ndarray, counts: np.ndarray, stride: int) -> list:
    """A packed run of sorted leaves; of every ``stride`` of them one is drawn."""
    drawn = slice(stride // 2, None, stride)
    places = np.stack([pairs[drawn], thirds[drawn].astype(np.uint64)], axis=1).ravel()
    packed = pack(np.diff(pairs, prepend=np.uint64(0))), pack(thirds.astype(np.uint32)), pack(counts.astype(np.uint64))
    return [group, sub, len(pairs), *packed, places.tobytes()]


def open_cell(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.cumsum(unpack(r["pairs"], np.uint64), dtype=np.uint64), unpack(r["thirds"], np.uint32), unpack(r["counts"], np.uint64)


def _cells_table(rows: list[list]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(CELL_SCHEMA)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CELL_SCHEMA)], schema=CELL_SCHEMA)


def _leaves(batch: pa.Table, ids: pa.Table, cuts: np.ndarray, stride: int) -> pa.Table:
    """The sorted suffixes of a batch that begin with two frequent words, a cell per group."""
    out = []
    for blob in batch.column("tokens").to_pylist():
        tokens = unpack(blob, np.uint32)
        id_of = np.zeros(int(tokens.max(initial=0)) + 1, np.uint64)
        id_of[ids.column("place").to_numpy()] = ids.column("id").to_numpy()
        one = id_of[tokens]
        two, three = np.append(one[1:], np.uint64(0)), np.append(one[2:], np.zeros(min(2, len(one)), np.uint64))
        use = (one > 0) & (two > 0)
        pairs, thirds, counts = add_up(one[use] << np.uint64(32) | two[use], three[use].astype(np.uint32), np.ones(int(use.sum()), np.uint64))
        bounds = np.searchsorted(np.searchsorted(cuts, pairs >> np.uint64(32), "right"), np.arange(len(cuts) + 2))
        out += [cell(g, 0, pairs[a:z], thirds[a:z], counts[a:z], stride) for g, (a, z) in enumerate(zip(bounds, bounds[1:])) if z > a]
    return _cells_table(out)


def _later_cuts(drawn: pa.Table, stride: int, budget: int) -> pa.Table:
    """Places that cut a group's leaves into parts of about the budget."""
    places = np.frombuffer(b"".join(drawn.column("drawn").to_pylist()), np.uint64).reshape(-1, 2)
    places = places[np.lexsort((places[:, 1], places[:, 0]))][max(1, budget // stride) - 1 :: max(1, budget // stride)][:FAN]
    return pa.table({"grp": drawn.column("grp")[:1], "cuts": pa.array([places.tobytes()], pa.binary())})


def _cut_again(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            pairs, thirds, counts = open_cell(r)
            cuts = np.frombuffer(r["cuts"], np.uint64).reshape(-1, 2)
            ends = []
            for pair, third in cuts.tolist():
                a, z = np.searchsorted(pairs, np.uint64(pair)), np.searchsorted(pairs, np.uint64(pair), "right")
                ends.append(a + int(np.searchsorted(thirds[a:z], third)))
            bounds = [0, *ends, len(pairs)]
            own = [(s, a, z) for s, (a, z) in enumerate(zip(bounds, bounds[1:])) if z > a]
            yield from _cells_table([cell(r["grp"], s + 1, pairs[a:z], thirds[a:z], counts[a:z], 1 << 40) for s, a, z in own]).to_batches()


NODES_DDL = "w1 long, w2 long, w3 long, n long"


def _subtree(cells: pa.Table, min_count: int) -> pa.Table:
    """Phrases of a group with ``min_count`` occurrences; a pair whose leaves may also be in another group comes with any count."""
    parts = [open_cell(r) for r in (cells.slice(k, 1).to_pylist()[0] for k in range(cells.num_rows))]
    pairs, thirds, counts = add_up(*map(np.concatenate, zip(*parts)))
    deep = np.flatnonzero((counts >= min_count) & (thirds > 0))
    nodes = run_starts(pairs)
    totals = np.add.reduceat(counts, nodes)
    keep = totals >= min_count
    if cells.column("sub")[0].as_py():
        keep[[0, -1]] = True
    low = np.uint64(2**32 - 1)
    own = np.concatenate([pairs[nodes][keep], pairs[deep]])
    columns = own >> np.uint64(32), own & low, np.concatenate([np.zeros(int(keep.sum()), np.uint64), thirds[deep]]), np.concatenate([totals[keep], counts[deep]])
    return pa.table({name: pa.array(c.astype(np.int64)) for name, c in zip(("w1", "w2", "w3", "n"), columns)})


def phrase_counts(parsed: DataFrame, words: DataFrame, min_count: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """Phrases of two words (``w1, w2, n``) and of three (``w1, w2, w3, n``) with ``min_count`` occurrences, by word ids."""
    spark = parsed.sparkSession
    least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cuts = first_cuts(words, min(FAN, max(least, total // budget + 1)))
    # No task should have much more than its share either.
    budget = max(1, min(budget, total // least))
    stride = max(1, budget // DRAWN)
    places = parsed.filter("tokens IS NULL").select("batch", "place", "key").join(words.select("key", "id"), "key")
    places = places.select(F.col("batch").alias("of"), "place", "id")
    batches = parsed.filter("tokens IS NOT NULL").select("batch", "tokens")
    leaves = batches.groupBy("batch").cogroup(places.groupBy("of")).applyInArrow(lambda b, i: _leaves(b, i, cuts, stride), CELLS)
    cells = materialize(leaves, "suffix-leaves")
    big = [r.grp for r in cells.groupBy("grp").agg(F.sum("n").alias("n")).filter(F.col("n") > budget).collect()]
    is_big = F.col("grp").isin(big) if big else F.lit(False)
    parts = cells.filter(~is_big)
    if big:
        again = cells.filter(is_big)
        places = again.select("grp", "drawn").groupBy("grp").applyInArrow(lambda t: _later_cuts(t, stride, budget), "grp long, cuts binary")
        parts = parts.unionByName(again.join(materialize(places, "prefix-cuts"), "grp").mapInArrow(_cut_again, CELLS))
    nodes = parts.drop("drawn").groupBy("grp", "sub").applyInArrow(lambda t: _subtree(t, min_count), NODES_DDL)
    nodes = materialize(nodes, "phrase-nodes")
    pairs = nodes.filter("w3 = 0").groupBy("w1", "w2").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    return materialize(pairs, "pairs"), nodes.filter("w3 > 0")


def _score(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits, for counts below 10 to the 15th."""
    a, left, right = (f"CAST({x} AS DECIMAL(15, 0))" for x in (a, left, right))
    return f"CAST((CAST(1000000 AS DECIMAL(7, 0)) * {a} * {a}) DIV ({left} * {right}) AS LONG)"


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    absorb_percent: int = ABSORB_PERCENT,
    batch_bytes: int = BATCH,
    budget: int = BUDGET,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the strongest phrases of two and three words in every language.

    A-Z are lower-cased; ``[.,;:!?\\x0A-\\x0D]`` end a piece, blanks and tabs a word; phrases lie inside a piece. ``a`` counts a
    phrase, overlaps included, ``n`` all words of the language. Of the cuts of a phrase into ``l`` (count of its first words) and
    ``r`` (of the rest) that with the least ``score`` counts, floor(1000000 a a / (l r)), of equals the earliest. Phrases seen ``min_count`` times
    are candidates; a candidate goes if a longer one that holds it has ``absorb_percent`` percent of its count. The first ``top``
    by score, then ``a``, then the phrase in byte order.

    A null text has no words, a null language is ``und``; a ``doc_id`` is not needed. Repeated rows count each, other columns do not
    matter, an empty table gives an empty one.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")) if "lang" in docs.columns else F.lit("und")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"))
    parsed, counts = count_words(texts, batch_bytes, min_count)
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("size"))
    words = numbered(counts, min_count)
    pairs, triples = phrase_counts(parsed, words, min_count, budget)
    inside = triples.select("w1", "w2", "n").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
    inside = inside.groupBy("w1", "w2").agg(F.max("n").alias("longer"))
    free = pairs.join(inside, ["w1", "w2"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < absorb_percent * F.col("n"))
    )
    ends = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("rest"))
    starts = pairs.select("w1", "w2", F.col("n").alias("start"))
    long = triples.join(starts, ["w1", "w2"]).join(ends, ["w2", "w3"]).select("w1", "w2", "w3", "n", "start", "rest")
    none = F.lit(None).cast("long")
    found = free.select("w1", "w2", none.alias("w3"), "n", none.alias("start"), none.alias("rest")).unionByName(long)
    found = found.withColumnRenamed("n", "a")
    for k in (1, 2, 3):
        own = words.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}"), *(["lang"] if k == 1 else []))
        found = found.join(own, f"w{k}", "left" if k == 3 else "inner")
    found = found.withColumn("one", F.expr(_score("a", "n1", "coalesce(rest, n2)")))
    found = found.withColumn("two", F.expr(_score("a", "start", "n3")))
    second = F.col("two") < F.col("one")
    scored = found.select(
        "lang",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(second, F.col("start")).otherwise(F.col("n1")).alias("l"),
        F.when(second, F.col("n3")).otherwise(F.coalesce("rest", "n2")).alias("r"),
        F.when(second, F.col("two")).otherwise(F.col("one")).alias("score"),
    )
    best = top_k(scored, top, "score", ["lang"], [F.desc("a"), "phrase"])
    return best.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("size").alias("n"), "score"
    )
