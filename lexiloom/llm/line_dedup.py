"""Lines that many documents share, by range-partitioned hashes.

Every long line becomes a row (hash, document, position). The rows are dealt out by *ranges* of
(hash, document descending), so that a line that a third of all documents hold spreads over
many tasks, and every task streams its sorted rows: the first document of a hash keeps its lines,
later ones lose them once enough documents have been seen. Only the first and the last hash of
a task can go on in another task; for these the tasks give subtotals, at most two each, and
the few rows that are still open are settled by their sums. The result is a compressed keep
bitmap per document; text is neither shuffled nor returned.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import SPACE, TO_LOWER, fresh, text_chunks, texts_of
from lexiloom.session import materialize

KEYS = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("pos", pa.int32())])
MARKS = pa.schema([("kind", pa.int8()), ("key", pa.binary()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("n", pa.int64())])
MARKS_DDL = "kind tinyint, key binary, doc_id long, pos int, n long"
DROP, OPEN, TOTAL = 0, 1, 2


def _line_keys(batches: Iterable[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        ids = rows.column("doc_id").to_numpy()
        breaks = np.flatnonzero(data == 10)
        doc_of_break = np.searchsorted(offsets, breaks, "right") - 1
        # A line begins where its document does or after a break.
        starts = np.concatenate([offsets[:-1], breaks + 1])
        docs = np.concatenate([np.arange(len(ids)), doc_of_break])
        order = np.lexsort((starts, docs))
        starts, docs = starts[order], docs[order]
        last = np.append(docs[1:] != docs[:-1], True)
        ends = np.where(last, offsets[docs + 1], np.append(starts[1:] - 1, 0))
        pos = np.arange(len(docs)) - np.searchsorted(docs, docs)
        long = ends - starts >= min_chars
        starts, ends, docs, pos = starts[long], ends[long], docs[long], pos[long]
        # Strip white space: the first and last byte that is none.
        solid = np.flatnonzero(~SPACE[data])
        if not len(solid):
            continue
        a = np.searchsorted(solid, starts)
        z = np.searchsorted(solid, ends) - 1
        some = z >= a
        a, z, docs, pos = a[some], z[some], docs[some], pos[some]
        starts, ends = solid[a], solid[z] + 1
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        long = points[ends] - points[starts] >= min_chars
        starts, ends, docs, pos = starts[long], ends[long], docs[long], pos[long]
        lower = TO_LOWER[data].tobytes()
        keys = [
            hashlib.blake2b(lower[s:e], digest_size=16).digest()
            for s, e in zip(starts.tolist(), ends.tolist())
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(ids[docs], pa.int64()), pa.array(pos, pa.int32())],
            schema=KEYS,
        )


def _stream(batches: Iterable[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Settle the rows of a task, sorted by key, document descending and position."""

    def out(kind, keys, docs, pos, n):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(docs), kind), pa.int8()),
                pa.array(keys, pa.binary()),
                pa.array(docs, pa.int64()),
                pa.array(pos, pa.int32()),
                pa.array(n, pa.int64()),
            ],
            schema=MARKS,
        )

    def drops(docs, pos):
        return out(DROP, [None] * len(docs), docs, pos, [None] * len(docs))

    def close(edge):
        """The end of the run that is held; at an edge of the task it stays open."""
        docs, pos = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
        if edge:
            yield out(OPEN, [key] * len(docs), docs, pos, [None] * len(docs))
            yield out(TOTAL, [key], [top], [None], [seen])

    key, seen, top, newest, held, first = None, 0, None, None, [], True
    for batch in batches:
        keys = batch.column("key").to_pylist()
        docs, pos = batch.column("doc_id").to_numpy(), batch.column("pos").to_numpy()
        if not len(docs):
            continue
        words = np.frombuffer(b"".join(keys), dtype=">u8").reshape(-1, 2)
        change = np.flatnonzero((words[1:] != words[:-1]).any(axis=1)) + 1
        bounds = [0, *change.tolist(), len(docs)]
        for a, b in zip(bounds, bounds[1:]):
            if keys[a] != key:
                if key is not None:
                    yield from close(first)
                    first = False
                key, seen, top, newest, held = keys[a], 0, docs[a], None, []
            run_docs, run_pos = docs[a:b], pos[a:b]
            new = np.ones(len(run_docs), bool)
            new[1:] = run_docs[1:] != run_docs[:-1]
            new[0] = run_docs[0] != newest
            rank = seen + np.cumsum(new)
            seen, newest = int(rank[-1]), run_docs[-1]
            held.append((run_docs, run_pos))
            if seen >= min_docs:
                d, p = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
                gone = d != top
                if gone.any():
                    yield drops(d[gone], p[gone])
                held = [(d[~gone], p[~gone])]
    if key is not None:
        yield from close(True)


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``doc_id, pos`` of every line that repeats and is not in the largest id that holds it."""
    spark = docs.sparkSession
    keyed = materialize(
        texts_of(docs).mapInArrow(lambda it: _line_keys(it, min_chars), "key binary, doc_id long, pos int"),
        "line-keys",
    )
    ranged = keyed.repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("key"), F.col("doc_id").desc()
    ).sortWithinPartitions(F.col("key"), F.col("doc_id").desc(), F.col("pos"))
    marks = materialize(ranged.mapInArrow(lambda it: _stream(it, min_docs), MARKS_DDL), "line-marks")
    # At most two rows from each task.
    totals = (
        marks.filter(F.col("kind") == TOTAL)
        .groupBy("key")
        .agg(F.sum("n").alias("docs"), F.max("doc_id").alias("top"))
        .filter(F.col("docs") >= min_docs)
    )
    late = (
        marks.filter(F.col("kind") == OPEN)
        .join(totals, "key")
        .filter(F.col("doc_id") < F.col("top"))
    )
    settled = marks.filter(F.col("kind") == DROP)
    return settled.select("doc_id", "pos").unionByName(late.select("doc_id", "pos"))


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs = []
        for gone in batch.column("gone").to_pylist():
            keep = np.ones(max(gone) // 8 * 8 + 8, bool)
            keep[gone] = False
            blobs.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(blobs, pa.binary())], names=["doc_id", "keep"]
        )


def unpack(blob: bytes | None, n_lines: int) -> np.ndarray:
    """Which of ``n_lines`` lines stay; lines beyond the bitmap do."""
    keep = np.ones(n_lines, bool)
    if blob is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(blob), np.uint8)).astype(bool)[:n_lines]
        keep[: len(bits)] = bits
    return keep


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``doc_id, keep`` for the documents that lose lines.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of
    at least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines,
    except in the largest ``doc_id`` that holds them. ``keep`` is a zlib-compressed bitmap, most
    significant bit first, a bit per line and 1 for lines that stay; lines beyond it stay.

    Null and empty texts have one empty line and lose nothing. Rows without a ``doc_id`` are
    left out. Repeated rows of a ``doc_id`` count as one document and share a bitmap. An empty
    table gives an empty table; columns other than ``doc_id`` and ``text`` do not matter.
    """
    gone = dropped_lines(docs, min_chars, min_docs)
    lists = gone.groupBy("doc_id").agg(F.collect_set("pos").alias("gone"))
    return lists.mapInArrow(_pack, "doc_id long, keep binary")


def cut_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the text that their bitmaps keep, all other columns as they are.

    A null text stays null; ``n_chars``, if there, is counted anew for texts that lost lines.
    """
    keep = fresh(docs, "keep_bitmap")
    marked = bitmaps.select(F.col("doc_id").alias(keep + "_id"), F.col("keep").alias(keep)).hint("merge")
    joined = docs.join(marked, F.col("doc_id") == F.col(keep + "_id"), "left").drop(keep + "_id")
    at, n = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:-1]
            texts, blobs = columns[at].to_pylist(), batch.columns[-1].to_pylist()
            counts = columns[n].to_pylist() if n is not None else None
            for i, blob in enumerate(blobs):
                if blob is not None and texts[i] is not None:
                    lines = texts[i].split("\n")
                    texts[i] = "\n".join(x for x, k in zip(lines, unpack(blob, len(lines))) if k)
                    if counts is not None:
                        counts[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if n is not None:
                columns[n] = pa.array(counts, columns[n].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(cut, docs.schema)


def line_digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    # Bitmaps grow with the documents: the same join at every size.
    joined = texts_of(docs).join(bitmaps.hint("merge"), "doc_id", "left").select("doc_id", "text", "keep")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, sums = [], [], []
            for text, blob in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
                n = text.count("\n") + 1
                dropped = 0
                if blob is not None:
                    keep = unpack(blob, n)
                    dropped = n - int(keep.sum())
                    text = "\n".join(x for x, k in zip(text.split("\n"), keep) if k)
                total.append(n)
                gone.append(dropped)
                sums.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sums)],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return joined.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
