"""Language model scores: a hashed maximum-entropy model with class-factored softmax.

The probability of a token is that of its class, given the words before it, times its share of the class. Classes
are the most frequent words (one each), the end of a text, unknown words, and the rest by their last bytes; class
probabilities are a softmax over hashed features of the preceding word, pair, and skipped words. Within a class
the features are the words themselves, whose maximum-entropy weights are their (smoothed) counts.

1. Tasks turn runs of documents into batches: distinct words, and a number into them per token.
2. Every batch asks for the counts of its words: hash ranges are summed by one task each and answered. A frequent word
   is one entry per batch, so no word makes a hot task.
3. Training: in each round tasks run stochastic gradient steps over their part of the training tokens, from
   the same weights; the weights are averaged by Spark, piece by piece. The rounds of an epoch together see each
   training token once.
4. Scoring: numpy blocks of tokens, a gather of the weight rows of their features and a softmax.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import TO_LOWER, mix, span_hashes, text_chunks, texts_of, word_bounds
from lexiloom.session import materialize

#: Bytes of text in a batch; a task needs some twenty times as much.
BATCH = 1 << 22
TOP, SUFFIXES = 15, 15
END_CLASS, UNKNOWN_CLASS, CLASSES = TOP, TOP + 1 + SUFFIXES, TOP + SUFFIXES + 2
BITS = 15
FEATURES = 4
ROUNDS = 3
EPOCHS = 1
#: Tokens of a gradient step, and of a scored block.
STEP, BLOCK = 1024, 4096
RATE = 0.5
#: The share of probability that is spread over all classes alike.
FLOOR = 1e-3
PIECES = 16
#: Weight changes that one task adds up.
FAN_IN = 64
CHANGES = "piece int, task long, steps long, change binary"
WORDS_PER_BUCKET = 1_000_000
END_HASH = np.uint64(0x0123456789ABCDEF)
_SALT = np.random.default_rng(13).integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


BATCHES = "batch long, n_words long, docs binary, sizes binary, tokens binary, hashes binary, tops binary, suffixes binary, counts binary"


def _batches(rows: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for chunk, data, offsets in text_chunks(rows, size):
        ids = chunk.column("doc_id").to_numpy()
        data = TO_LOWER[data]
        words, suffixes, docs = [], [], []
        # Hashes in pieces, so that no temporary array is as long as the batch.
        for k in range(0, len(ids), 256):
            z = min(k + 256, len(ids))
            piece, inner = data[offsets[k] : offsets[z]], offsets[k : z + 1] - offsets[k]
            starts, ends, row = word_bounds(piece, inner)
            words.append(span_hashes(piece, starts, ends))
            last = piece[ends - 1].astype(np.uint64) + np.where(ends - starts > 1, piece[np.maximum(ends - 2, 0)], 0).astype(np.uint64) * np.uint64(256)
            suffixes.append((mix(last) % np.uint64(SUFFIXES)).astype(np.uint8))
            docs.append(row + k)
        words, suffixes, docs = map(np.concatenate, (words, suffixes, docs))
        n = np.bincount(docs, minlength=len(ids)) + 1
        # An end after each document's words.
        at = np.arange(len(words)) + docs
        tokens = np.full(len(words) + len(ids), END_HASH)
        tokens[at] = words
        tails = np.zeros(len(tokens), np.uint8)
        tails[at] = suffixes
        held = np.array([is_held_out(x) for x in ids.tolist()], bool)
        distinct, first, where, seen = np.unique(tokens, return_index=True, return_inverse=True, return_counts=True)
        learned = np.bincount(where, np.repeat(~held, n), len(distinct)).astype(np.uint32)
        order = np.argsort(-seen, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        distinct = distinct[order]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 24) + number], pa.int64()),
                pa.array([len(distinct)], pa.int64()),
                *(
                    pa.array([x], pa.binary())
                    for x in (
                        pack(ids), pack(n.astype(np.int64)), pack(place[where]), distinct.tobytes(),
                        (distinct >> np.uint64(32)).astype(np.uint32).tobytes(), tails[first][order].tobytes(), pack(learned[order]),
                    )
                ),
            ],
            names=["batch", "n_words", "docs", "sizes", "tokens", "hashes", "tops", "suffixes", "counts"],
        )
        number += 1


def bucket_of(tops: np.ndarray, buckets: int) -> np.ndarray:
    return ((tops.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _ask(rows: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for r in batch.to_pylist():
            hashes = np.frombuffer(r["hashes"], np.uint64)
            counts, suffixes = unpack(r["counts"], np.uint32), np.frombuffer(r["suffixes"], np.uint8)
            bucket = bucket_of(hashes >> np.uint64(32), buckets)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            own = [(b, order[a:z]) for b, (a, z) in enumerate(zip(ends[:-1], ends[1:])) if z > a]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _ in own], pa.int32()),
                    pa.array([r["batch"]] * len(own), pa.int64()),
                    pa.array([hashes[x].tobytes() for _, x in own], pa.binary()),
                    pa.array([counts[x].tobytes() for _, x in own], pa.binary()),
                    pa.array([suffixes[x].tobytes() for _, x in own], pa.binary()),
                ],
                names=["bucket", "batch", "hashes", "counts", "suffixes"],
            )


ANSWERS = pa.schema(
    [("kind", pa.int8()), ("batch", pa.int64()), ("bucket", pa.int32()), ("word", pa.int64()), ("n", pa.int64()), ("total", pa.int64()), ("data", pa.binary())]
)
ANSWERS_DDL = "kind tinyint, batch long, bucket int, word long, n long, total long, data binary"
REPLY, SUFFIX_SUM, FREQUENT = 0, 1, 2


def _answer(table: pa.Table) -> pa.Table:
    """Sum the counts of a range of hashes: a reply to each batch, sums per suffix, and the frequent words."""
    bucket = table.column("bucket")[0].as_py()
    blobs = table.column("hashes").to_pylist()
    hashes = np.frombuffer(b"".join(blobs), np.uint64)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32)
    suffixes = np.frombuffer(b"".join(table.column("suffixes").to_pylist()), np.uint8)
    distinct, first, where = np.unique(hashes, return_index=True, return_inverse=True)
    totals = np.bincount(where, counts, len(distinct)).astype(np.int64)
    answer, out, at = totals[where].astype("<u8"), [], 0
    for batch, blob in zip(table.column("batch").to_pylist(), blobs):
        size = len(blob) // 8
        out.append((REPLY, batch, bucket, None, None, None, pack(answer[at : at + size])))
        at += size
    known, tail = totals > 0, suffixes[first]
    words = distinct != END_HASH
    for s in range(SUFFIXES):
        own = known & words & (tail == s)
        out.append((SUFFIX_SUM, None, bucket, s, int(own.sum()), int(totals[own].sum()), None))
    own = known & ~words
    out.append((SUFFIX_SUM, None, bucket, SUFFIXES, int(own.sum()), int(totals[own].sum()), None))
    frequent = np.flatnonzero(known & words)
    frequent = frequent[np.lexsort((distinct[frequent], -totals[frequent]))[:TOP]]
    for i in frequent.tolist():
        out.append((FREQUENT, None, bucket, int(distinct[i].view(np.int64)), int(tail[i]), int(totals[i]), None))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ANSWERS)], schema=ANSWERS)


class Counts:
    """Totals of the training tokens, and the size of each class."""

    def __init__(self, sums: dict[int, tuple[int, int]], frequent: list[tuple[int, int, int]]):
        self.tokens = sum(total for _, total in sums.values())
        self.kinds = sum(n for n, _ in sums.values())
        size = np.zeros(CLASSES)
        for s, (n, total) in sums.items():
            size[END_CLASS if s == SUFFIXES else TOP + 1 + s] = n + total
        for k, (_, s, total) in enumerate(frequent):
            size[k] = total + 1
            size[TOP + 1 + s] -= total + 1
        size[UNKNOWN_CLASS] = 1
        self.size = np.maximum(size, 1)
        self.frequent = np.array([h for h, _, _ in frequent], np.int64).view(np.uint64)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + self.kinds + 1))


CODED = "batch long, docs binary, sizes binary, tokens binary, tops binary, totals binary, classes binary"


def _code(batch: pa.Table, replies: pa.Table, counts: Counts, buckets: int) -> pa.Table:
    """A batch with the total count and the class of its words."""
    r = batch.to_pylist()[0]
    tops = np.frombuffer(r["tops"], np.uint32)
    bucket = bucket_of(tops, buckets)
    order = np.argsort(bucket, kind="stable")
    totals = np.zeros(len(tops), np.uint64)
    answers = sorted(zip(replies.column("bucket").to_pylist(), replies.column("data").to_pylist()))
    totals[order] = np.concatenate([unpack(data, np.uint64) for _, data in answers])
    classes = TOP + 1 + np.frombuffer(r["suffixes"], np.uint8)
    frequent = (counts.frequent >> np.uint64(32)).astype(np.uint32)
    for k, top in enumerate(frequent.tolist()):
        # The full hash is gone; a frequent word is the one with its first half and its count.
        classes[(tops == top) & (totals == counts.size[k] - 1)] = k
    classes[tops == np.uint32(END_HASH >> np.uint64(32))] = END_CLASS
    classes[totals == 0] = UNKNOWN_CLASS
    out = [r["batch"], r["docs"], r["sizes"], r["tokens"], r["tops"], pack(totals), classes.astype(np.uint8).tobytes()]
    return pa.Table.from_arrays(
        [pa.array([x], pa.int64() if k == 0 else pa.binary()) for k, x in enumerate(out)],
        names=["batch", "docs", "sizes", "tokens", "tops", "totals", "classes"],
    )


def feature_rows(words: np.ndarray, since: np.ndarray) -> np.ndarray:
    """Weight rows of each token's features: last word, last two, the one before them, and its skip pair.

    ``words`` are word hashes in text order, ``since`` the tokens since the text began.
    """
    before = []
    for k in (1, 2, 3):
        w = np.zeros(len(words), np.uint64)
        w[k:] = words[:-k] if k < len(words) else w[k:]
        w[since < k] = np.uint64(1)
        before.append(w)
    one, two, three = before
    keys = (one + _SALT[0], one * _SALT[1] + two, two + _SALT[2], one * _SALT[3] + three)
    return np.stack([(mix(k * _SALT[4]) >> np.uint64(64 - BITS)).astype(np.int32) for k in keys], axis=1)


def class_probabilities(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Softmax over the classes; the last weight row is the bias."""
    logits = weights[rows[:, 0]]
    for k in range(1, FEATURES):
        logits = logits + weights[rows[:, k]]
    logits += weights[-1]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


class Batch:
    """A coded batch, unpacked."""

    def __init__(self, r: dict):
        self.docs, self.sizes = unpack(r["docs"], np.int64), unpack(r["sizes"], np.int64)
        self.tokens = unpack(r["tokens"], np.uint32)
        self.words = np.frombuffer(r["tops"], np.uint32)
        self.totals, self.classes = unpack(r["totals"], np.uint64), np.frombuffer(r["classes"], np.uint8)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.held = np.array([is_held_out(x) for x in self.docs.tolist()], bool)

    def rows(self, a: int, z: int) -> np.ndarray:
        """Feature rows of the tokens from ``a`` to ``z``."""
        back = max(0, a - 3)
        words = self.words[self.tokens[back:z]].astype(np.uint64) + np.uint64(2)
        place = np.arange(back, z)
        since = place - self.first[np.searchsorted(self.first, place, "right") - 1]
        return feature_rows(words, since)[a - back :]


def _learn(rows: Iterable[pa.RecordBatch], weights: np.ndarray, turn: int, rounds: int, step: int) -> Iterator[pa.RecordBatch]:
    """Gradient steps over the task's share of this round; the resulting weights, in pieces."""
    own, squares, steps = weights.astype(np.float32), np.ones(len(weights), np.float32), 0
    for batch in rows:
        for r in batch.to_pylist():
            b = Batch(r)
            train = ~np.repeat(b.held, b.sizes)
            # Half of the words seen once stand for words not seen at all.
            target = b.classes.copy()
            target[(b.totals == 1) & (b.words & 1 == 1) & (target > END_CLASS)] = UNKNOWN_CLASS
            for a in range(turn % rounds * step, len(b.tokens), rounds * step):
                z = min(a + step, len(b.tokens))
                use = np.flatnonzero(train[a:z])
                if not len(use):
                    continue
                features = b.rows(a, z)[use]
                error = class_probabilities(own, features)
                error[np.arange(len(use)), target[b.tokens[a:z][use]]] -= 1
                flat = features.ravel()
                order = np.argsort(flat, kind="stable")
                starts = np.flatnonzero(np.append(True, flat[order][1:] != flat[order][:-1]))
                grad = np.add.reduceat(error[order // FEATURES], starts, axis=0)
                which = np.append(flat[order][starts], len(own) - 1)
                grad = np.concatenate([grad, error.sum(axis=0, keepdims=True)])
                squares[which] += (grad * grad).sum(axis=1)
                own[which] -= RATE * grad / np.sqrt(squares[which])[:, None]
                steps += len(use)
    if steps:
        change = (own - weights) * np.float32(steps)
        bounds = np.linspace(0, len(own), PIECES + 1).astype(int)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(PIECES), pa.int32()),
                pa.array([TaskContext.get().partitionId()] * PIECES, pa.int64()),
                pa.array([steps] * PIECES, pa.int64()),
                pa.array([pack((change[a:z] / steps).astype(np.float16).ravel()) for a, z in zip(bounds, bounds[1:])], pa.binary()),
            ],
            names=["piece", "task", "steps", "change"],
        )


def _combine(table: pa.Table) -> pa.Table:
    """The mean change of a piece, weighted by steps, and the steps."""
    total, steps = 0.0, table.column("steps").to_numpy()
    for n, blob in zip(steps.tolist(), table.column("change").to_pylist()):
        total = total + unpack(blob, np.float16).astype(np.float64) * n
    mean = (total / max(1, steps.sum())).astype(np.float16)
    return pa.table(
        {
            "piece": pa.array([table.column("piece")[0].as_py()], pa.int32()),
            "task": pa.array([table.column("task")[0].as_py() // FAN_IN], pa.int64()),
            "steps": pa.array([int(steps.sum())], pa.int64()),
            "change": pa.array([pack(mean)], pa.binary()),
        }
    )


def _averaged(changes: DataFrame, tasks: int) -> DataFrame:
    """A row per piece, by a tree of sums of at most ``FAN_IN`` rows."""
    while True:
        group = F.floor(F.col("task") / FAN_IN)
        changes = materialize(changes.groupBy("piece", group).applyInArrow(_combine, CHANGES), "weight-changes")
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            return changes


def train(coded: DataFrame, rounds: int = ROUNDS, epochs: int = EPOCHS, step: int = STEP) -> np.ndarray:
    """Class weights by feature row, from ``rounds`` averaged updates an epoch; the last row is the bias."""
    spark = coded.sparkSession
    weights = np.zeros(((1 << BITS) + 1, CLASSES), np.float32)
    tasks = coded.rdd.getNumPartitions()
    for turn in range(rounds * epochs):
        shared = spark.sparkContext.broadcast(weights)
        changes = coded.mapInArrow(lambda it, shared=shared, turn=turn: _learn(it, shared.value, turn, rounds, step), CHANGES)
        merged = _averaged(changes, tasks).orderBy("piece").collect()
        if merged:
            change = np.concatenate([unpack(r.change, np.float16) for r in merged]).astype(np.float32)
            weights = weights + change.reshape(weights.shape)
    return weights


def _score(rows: Iterable[pa.RecordBatch], counts: Counts, model) -> Iterator[pa.RecordBatch]:
    weights = model.value
    base, share = counts.base, np.log10(counts.size)
    for batch in rows:
        for r in batch.to_pylist():
            b = Batch(r)
            known = b.totals > 0
            word_base = base(b.totals.astype(np.float64))
            word_share = np.log10(b.totals.astype(np.float64) + 1) - share[b.classes]
            logs = np.empty(len(b.tokens))
            for a in range(0, len(b.tokens), BLOCK):
                z = min(a + BLOCK, len(b.tokens))
                own = b.tokens[a:z]
                p = class_probabilities(weights, b.rows(a, z))[np.arange(z - a), b.classes[own]]
                logs[a:z] = np.log10((1 - FLOOR) * p.astype(np.float64) + FLOOR / CLASSES) + word_share[own]
            columns = [
                pa.array(b.docs),
                pa.array(b.held),
                pa.array(b.sizes),
                pa.array(np.add.reduceat(known[b.tokens].astype(np.int64), b.first)),
                pa.array(np.full(len(b.docs), counts.tokens, np.int64)),
                pa.array(np.add.reduceat(word_base[b.tokens], b.first)),
                pa.array(np.add.reduceat(logs, b.first)),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            )


def lm_scores(
    docs: DataFrame, rounds: int = ROUNDS, epochs: int = EPOCHS, step: int = STEP, batch_bytes: int = BATCH
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Tokens are words (runs without ASCII white space, A-Z lower-cased) and one end. The model is
    trained on documents whose crc32 of ``doc_id`` as text is not 2 modulo 7, and scores all. ``base_score`` is the add-one
    unigram log10 probability, ``score`` the model's; both treat all unknown words as one event.

    Null and empty texts are one end. Rows without a ``doc_id`` are left out, repeated rows count and are scored each.
    An empty table gives an empty one, a table without training documents scores of untrained weights. Other columns
    do not matter.
    """
    spark = docs.sparkSession
    batches = materialize(texts_of(docs).mapInArrow(lambda it: _batches(it, batch_bytes), BATCHES), "batches")
    words = batches.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words // WORDS_PER_BUCKET + 1)
    asked = batches.select("batch", "hashes", "counts", "suffixes").mapInArrow(
        lambda it: _ask(it, buckets), "bucket int, batch long, hashes binary, counts binary, suffixes binary"
    )
    answers = materialize(asked.groupBy("bucket").applyInArrow(_answer, ANSWERS_DDL), "word-counts")
    sums = answers.filter(F.col("kind") == SUFFIX_SUM).groupBy("word").agg(F.sum("n"), F.sum("total")).collect()
    top = answers.filter(F.col("kind") == FREQUENT).orderBy(F.desc("total"), "word").limit(TOP).collect()
    counts = Counts({r[0]: (r[1], r[2]) for r in sums}, [(r.word, r.n, r.total) for r in top])
    left = batches.select("batch", "docs", "sizes", "tokens", "tops", "suffixes").groupBy("batch")
    right = answers.filter(F.col("kind") == REPLY).select("batch", "bucket", "data").groupBy("batch")
    coded = materialize(left.cogroup(right).applyInArrow(lambda a, b: _code(a, b, counts, buckets), CODED), "coded")
    model = spark.sparkContext.broadcast(train(coded, rounds, epochs, step))
    ddl = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return coded.mapInArrow(lambda it: _score(it, counts, model), ddl)
