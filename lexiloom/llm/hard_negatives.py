"""Hard negatives by angular triangle filtering: exact integer scores only where bounds overlap a window.

1. Rows are packed into blocks: integer components, norms, and the angles to a few reference directions. Blocks are written once.
2. Anchors go round in groups of bounded size. For an anchor and a row, the triangle inequality over every reference gives an interval
   for the angle between them, and its cosines times both norms an interval for their score, widened by more
   than all rounding errors.
3. Positives: rows of the anchor's label whose upper bound reaches the best scores so far are scored.
   Each task keeps the best few of every anchor, and Spark ranks what tasks kept.
4. Negatives: every positive opens a window of scores below its own. Rows of other labels whose interval overlaps a window, and reaches
   the best in it so far, are scored. Again a task keeps a few rows for each window.

Scores are inner products of integers: numpy's are exact while both norms multiply to less than 2 to the 53rd, and Python's
integers take over beyond. References only decide how much is filtered, never what is found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.llm.maxent import pack, unpack
from lexiloom.session import materialize, work_path

REFERENCES = 16
#: Rows from which the references are made: those with the smallest hash of their id.
SAMPLE = 2_000
#: Rows of a block, bytes of the anchors of one group, and anchors compared with a block at a time.
BLOCK, GROUP_BYTES, STRIP = 4096, 1 << 23, 128
#: More than the error of a stored angle, and of a cosine computed from it.
ANGLE_ERROR, COSINE_ERROR = np.float32(2e-5), 4e-6
EXACT = 2.0**53
LONG = 2**63 - 1

BLOCKS = "n long, ids binary, labels binary, parts binary, angles binary"


def _numbers(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    """Integer components as doubles, a row per vector; what a vector lacks is 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(float) * scale)
    out = np.zeros((len(column), dims))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _norms(parts: np.ndarray) -> np.ndarray:
    return np.sqrt((parts * parts).sum(axis=1))


def angles(parts: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of every row to every reference; a row of zeros, whose scores are all 0, may have any."""
    units = parts / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(units @ references.T, -1, 1)).astype(np.float32)


def choose_references(parts: np.ndarray, n: int = REFERENCES, rounds: int = 5) -> np.ndarray:
    """Unit vectors towards ``n`` clusters of the given rows."""
    norms = _norms(parts)
    units = parts[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return np.eye(1, parts.shape[1])
    chosen = [units[0]]
    nearest = units @ units[0]
    while len(chosen) < min(n, len(units)):
        chosen.append(units[int(nearest.argmin())])
        nearest = np.maximum(nearest, units @ chosen[-1])
    centres = np.array(chosen)
    for _ in range(rounds):
        own = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        size = _norms(sums)
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def _pack(rows: Iterable[pa.RecordBatch], dims: int, scale: float, references: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for k in range(0, batch.num_rows, BLOCK):
            part = batch.slice(k, BLOCK)
            parts = _numbers(part.column("vector"), dims, scale)
            blobs = [part.column(c).to_numpy().astype(np.int64) for c in ("id", "label")]
            blobs += [parts.ravel(), angles(parts, _norms(parts), references).ravel()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.num_rows], pa.int64()), *(pa.array([pack(x)], pa.binary()) for x in blobs)],
                names=["n", "ids", "labels", "parts", "angles"],
            )


class Block:
    """Some rows: ids, labels, components, norms and angles."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, parts: np.ndarray, angle: np.ndarray):
        self.ids, self.labels, self.parts, self.angle, self.norms = ids, labels, parts, angle, _norms(parts)

    @classmethod
    def unpacked(cls, r: dict) -> Block:
        n = r["n"]
        parts, angle = unpack(r["parts"], np.float64).reshape(n, -1), unpack(r["angles"], np.float32).reshape(n, -1)
        return cls(unpack(r["ids"], np.int64), unpack(r["labels"], np.int64), parts, angle)

    def scores(self, rows: np.ndarray, anchors: Block, k: int) -> np.ndarray:
        """Exact inner products of ``rows`` with anchor ``k``."""
        own = self.parts[rows]
        if len(rows) == 0 or self.norms[rows].max() * anchors.norms[k] < EXACT / 2:
            return (own @ anchors.parts[k]).astype(np.int64)
        other = [int(x) for x in anchors.parts[k]]
        exact = [sum(int(x) * y for x, y in zip(row, other)) for row in own.tolist()]
        return np.array([min(max(x, -LONG), LONG) for x in exact], np.int64)


def bounds(rows: Block, anchors: Block, part: slice) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each anchor of ``part`` can have with each row."""
    near = np.zeros((part.stop - part.start, len(rows.ids)), np.float32)
    far = np.full(near.shape, np.float32(np.pi))
    step, total = np.empty_like(near), np.empty_like(near)
    for r in range(rows.angle.shape[1]):
        a, x = anchors.angle[part, r][:, None], rows.angle[:, r][None, :]
        np.subtract(a, x, out=step)
        np.abs(step, out=step)
        np.maximum(near, step, out=near)
        np.add(a, x, out=total)
        np.subtract(np.float32(2 * np.pi), total, out=step)
        np.minimum(total, step, out=total)
        np.minimum(far, total, out=far)
    size = anchors.norms[part][:, None] * rows.norms[None, :]
    slack = size * COSINE_ERROR + 1
    low = np.cos(np.minimum(far + ANGLE_ERROR, np.float32(np.pi))) * size - slack
    return low, np.cos(np.maximum(near - ANGLE_ERROR, 0)) * size + slack


Kept = list[tuple[int, int]]


def _merge(kept: Kept, scores: np.ndarray, ids: np.ndarray, most: int) -> None:
    """Add the best rows to ``kept`` (minus score, id), which holds at most ``most``."""
    if not len(scores):
        return
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        at = np.flatnonzero(scores >= least)
        at = at[np.lexsort((ids[at], -scores[at]))[:most]]
        scores, ids = scores[at], ids[at]
    kept.extend(zip((-scores).tolist(), ids.tolist()))
    kept.sort()
    del kept[most:]


def _strips(blocks: Iterable[pa.RecordBatch], anchors: Block) -> Iterator[tuple[Block, slice, np.ndarray, np.ndarray]]:
    for batch in blocks:
        for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            rows = Block.unpacked(r)
            for a in range(0, len(anchors.ids), STRIP):
                part = slice(a, min(a + STRIP, len(anchors.ids)))
                yield rows, part, *bounds(rows, anchors, part)


def _positives(blocks: Iterable[pa.RecordBatch], shared, most: int) -> Iterator[pa.RecordBatch]:
    anchors: Block = shared.value
    kept: list[Kept] = [[] for _ in anchors.ids]
    for rows, part, _, high in _strips(blocks, anchors):
        for k in range(part.start, part.stop):
            ok = (rows.labels == anchors.labels[k]) & (rows.ids != anchors.ids[k])
            if len(kept[k]) == most:
                ok &= high[k - part.start] >= -kept[k][-1][0]
            own = np.flatnonzero(ok)
            _merge(kept[k], rows.scores(own, anchors, k), rows.ids[own], most)
    out = [(k, -s, i) for k, best in enumerate(kept) for s, i in best]
    yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], names=["k", "score", "id"])


#: A positive's number, and the largest and least score of its negatives.
WindowOf = tuple[int, int, int]


def _negatives(blocks: Iterable[pa.RecordBatch], shared, windows, most: int) -> Iterator[pa.RecordBatch]:
    anchors: Block = shared.value
    of: list[list[WindowOf]] = windows.value
    kept: dict[int, Kept] = {p: [] for own in of for p, _, _ in own}
    for rows, part, low, high in _strips(blocks, anchors):
        for k in range(part.start, part.stop):
            if not of[k]:
                continue
            other, wanted = rows.labels != anchors.labels[k], np.zeros(len(rows.ids), bool)
            for p, top, least in of[k]:
                if len(kept[p]) == most:
                    least = max(least, -kept[p][-1][0])
                wanted |= (high[k - part.start] >= least) & (low[k - part.start] <= top)
            own = np.flatnonzero(wanted & other)
            scores = rows.scores(own, anchors, k)
            for p, top, least in of[k]:
                fits = np.flatnonzero((scores >= least) & (scores <= top))
                _merge(kept[p], scores[fits], rows.ids[own[fits]], most)
    out = [(p, -s, i) for p, best in kept.items() for s, i in best]
    yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], names=["k", "score", "id"])


def _first(rows: DataFrame, most: int) -> DataFrame:
    """The best ``most`` rows of each ``k``, ranked; a task sends at most as many."""
    order = Window.partitionBy("k").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    sample: int = SAMPLE,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component ``x`` becomes ``floor(scale * x)``, a score is the integer inner product with the anchor. Higher scores come
    first, ties by smaller id. An anchor's positives are its first rows of the same label and another id. A
    positive's negatives are the first rows of other labels whose score is at most the positive's and at least ``low_percent``
    percent of it; ``rank`` counts them from 1.

    Rows with a null id, label or vector, or a null or non-finite component take no part. Repeated rows take part
    each; rows of an anchor's own id are none of its positives. A vector shorter than others is filled with zeros. Scores beyond a long
    count as the largest or least long. An empty table, or one without anchors, gives an empty result;
    other columns do not matter.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector.alias("vector"), is_anchor.alias("anchor")
    ).filter(
        "id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND forall(vector, "
        "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    anchors = materialize(
        rows.filter("anchor").select("id", "label", "vector", F.monotonically_increasing_id().alias("n")), "anchors"
    )
    dims, = rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    n_anchors = anchors.count()
    base = work_path(spark, "negatives")
    if not n_anchors:
        return spark.createDataFrame([], OUT)
    dims = max(1, dims)
    own = rows.orderBy(F.xxhash64("id"), "id", "label").limit(sample).select("vector").toArrow()
    references = choose_references(_numbers(own.column("vector"), dims, scale))
    blocks = materialize(
        rows.select("id", "label", "vector").mapInArrow(lambda it: _pack(it, dims, scale, references), BLOCKS), "vector-blocks"
    )
    groups = -(-n_anchors * 8 * (dims + len(references)) // group_bytes)
    group = F.pmod(F.xxhash64("n"), F.lit(groups))
    for g in range(groups):
        taken = anchors.filter(group == g).orderBy("id", "n").toArrow()
        if not taken.num_rows:
            continue
        parts = _numbers(taken.column("vector"), dims, scale)
        table = Block(taken.column("id").to_numpy(), taken.column("label").to_numpy(), parts, angles(parts, _norms(parts), references))
        shared = spark.sparkContext.broadcast(table)
        found = blocks.mapInArrow(lambda it, s=shared: _positives(it, s, positives), "k long, score long, id long")
        best = sorted(tuple(r) for r in _first(found, positives).select("k", "rank", "score", "id").collect())
        windows: list[list[WindowOf]] = [[] for _ in table.ids]
        facts = []
        for k, _, score, other in best:
            if score >= 0:
                windows[k].append((len(facts), score, -(-low_percent * score // 100)))
            facts.append((len(facts), int(table.ids[k]), other, score))
        opened = spark.sparkContext.broadcast(windows)
        found = blocks.mapInArrow(lambda it, s=shared, w=opened: _negatives(it, s, w, negatives), "k long, score long, id long")
        names = spark.createDataFrame(facts, "k long, anchor_id long, positive_id long, positive_score long")
        result = _first(found, negatives).join(names, "k").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        result.write.parquet(f"{base}/group={g}")
        shared.destroy()
        opened.destroy()
    return spark.read.schema(f"{OUT}, group long").parquet(base).drop("group")
