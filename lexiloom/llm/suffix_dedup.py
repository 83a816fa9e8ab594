"""Byte strings that repeat across documents, by externally sorted suffixes of the stretches that can hold them.

1. Documents are packed into batches. Every window of ``length`` bytes has an anchor (see ``anchors``); a batch asks, per
   anchor hash, whether another batch has it too.
2. With the answers a batch cuts out the stretches whose anchor is shared. Of equal stretches in a batch, all but those of
   the smallest id are settled at once; the others go, by anchor, to a shard.
3. A shard does the same with the stretches of all batches, writes those that are left end to end and sorts the suffixes by induction with disk-backed
   queues (see ``induced``). Windows that share a prefix of ``length`` are equal; those of a larger id than the run's
   smallest are covered.
4. Covered spans go back to their batch, which unites them per document and hashes what is left.

Frequent strings meet in one shard only as one stretch per batch and distinct surroundings. A shard's text and queues
spill to disk beyond ``memory``; its types, names and the places of its stretches (some 20 bytes per byte of text) do not.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.anchors import stretches
from lexiloom.llm.common import CHUNK, run_starts, span_hashes, text_chunks, texts_of
from lexiloom.llm.induced import MEMORY, suffixes
from lexiloom.llm.maxent import pack, unpack
from lexiloom.session import materialize

LENGTH = 50
BATCH = 1 << 23
#: Anchor hashes in one task's sum, and bytes of text per shard.
ASKED, SHARD = 2_000_000, 1 << 23

BATCHES = "batch long, n_bytes long, docs binary, sizes binary, text binary"


def _batches(rows: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for chunk, data, offsets in text_chunks(rows, size):
        packed = zstandard.ZstdCompressor(level=3).compress(data.tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 24) + number], pa.int64()),
                pa.array([len(data)], pa.int64()),
                pa.array([pack(chunk.column("doc_id").to_numpy())], pa.binary()),
                pa.array([pack(np.diff(offsets))], pa.binary()),
                pa.array([packed], pa.binary()),
            ],
            names=["batch", "n_bytes", "docs", "sizes", "text"],
        )
        number += 1


class Batch:
    """An unpacked batch of documents."""

    def __init__(self, r: dict):
        self.number, self.docs, self.sizes = r["batch"], unpack(r["docs"], np.int64), unpack(r["sizes"], np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["text"]), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])

    def stretches(self, length: int, contents: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, first window, windows, document (its place in the batch) and content hash of every stretch."""
        out, first = [], 0
        while first < len(self.docs):
            last = int(np.searchsorted(self.offsets, self.offsets[first] + CHUNK, "right")) - 1
            last = min(max(last, first + 1), len(self.docs))
            a, z = self.offsets[first], self.offsets[last]
            data, offsets = self.data[a:z], self.offsets[first : last + 1] - a
            anchor, place, n = stretches(data, offsets, length)
            if len(anchor):
                doc = np.searchsorted(offsets, place, "right") - 1 + first
                content = span_hashes(data, place, place + n + length - 1) if contents else anchor
                out.append((anchor, place + a, n, doc, content))
            first = last
        if not out:
            return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64)
        return tuple(map(np.concatenate, zip(*out)))

    def representatives(self, length: int):
        """Stretches in anchor order, and which of them is of the smallest id with that content."""
        anchor, place, n, doc, content = self.stretches(length)
        ids = self.docs[doc]
        order = np.lexsort((ids, content, anchor))
        anchor, place, n, doc, content, ids = (x[order] for x in (anchor, place, n, doc, content, ids))
        runs = run_starts(anchor, content)
        least = np.repeat(ids[runs], np.diff(np.append(runs, len(ids)))) if len(ids) else ids
        return anchor, place, n, doc, ids == least


def _buckets(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return (((anchor >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _distinct(anchor: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of every anchor, and whether more than one document of the batch has it."""
    runs = run_starts(anchor)
    if not len(runs):
        return runs, np.zeros(0, bool)
    return runs, np.maximum.reduceat(ids, runs) != np.minimum.reduceat(ids, runs)


def _ask(rows: Iterable[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for part in rows:
        for r in part.to_pylist():
            anchor = np.sort(Batch(r).stretches(length, contents=False)[0])
            anchor = anchor[run_starts(anchor)]
            bounds = np.searchsorted(_buckets(anchor, buckets), np.arange(buckets + 1))
            own = [(b, anchor[a:z]) for b, (a, z) in enumerate(zip(bounds[:-1], bounds[1:])) if z > a]
            # 48 bits of the sorted hashes, as differences.
            blobs = [pack(np.diff(x >> np.uint64(16), prepend=np.uint64(0))) for _, x in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in own], pa.int32()), pa.array([r["batch"]] * len(own), pa.int64()), pa.array(blobs, pa.binary())],
                names=["bucket", "batch", "anchors"],
            )


def _answer(table: pa.Table) -> pa.Table:
    """For every batch a bit per anchor: whether another batch has it."""
    parts = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in table.column("anchors").to_pylist()]
    every = np.concatenate(parts)
    order = np.argsort(every)
    twice = np.append(False, every[order][1:] == every[order][:-1])
    twice[:-1] |= twice[1:]
    shared, at, blobs = np.empty(len(every), bool), 0, []
    shared[order] = twice
    for part in parts:
        blobs.append(np.packbits(shared[at : at + len(part)]).tobytes())
        at += len(part)
    return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "shared": pa.array(blobs, pa.binary())})


CUT = "shard int, batch long, anchors binary, docs binary, places binary, windows binary, text binary"


def _cut(batch: pa.Table, answers: pa.Table, length: int, buckets: int, shards: int) -> pa.Table:
    """Shared stretches of a batch by shard (shard -1: spans that are settled here)."""
    b = Batch(batch.to_pylist()[0])
    anchor, place, n, doc, least = b.representatives(length)
    runs, several = _distinct(anchor, b.docs[doc])
    bits = {k: x for k, x in zip(answers.column("bucket").to_pylist(), answers.column("shared").to_pylist())}
    bucket = _buckets(anchor[runs], buckets)
    shared = np.zeros(len(runs), bool)
    # Hashes that agree in 48 bits are one entry of the question.
    bounds = np.searchsorted(bucket, np.arange(buckets + 1))
    for k, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if z > a:
            shared[a:z] = np.unpackbits(np.frombuffer(bits[k], np.uint8))[: z - a]
    wanted = np.repeat(shared | several, np.diff(np.append(runs, len(anchor))))
    out = []

    settled = np.flatnonzero(wanted & ~least)
    if len(settled):
        out.append((-1, b.number, None, pack(doc[settled]), pack(place[settled]), pack(n[settled]), b""))
    sent = np.flatnonzero(wanted & least)
    shard = _buckets(anchor[sent] << np.uint64(20), shards)
    sent = sent[np.argsort(shard, kind="stable")]
    shard = np.sort(shard)
    bounds = np.searchsorted(shard, np.arange(shards + 1))
    for k, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if z > a:
            own = sent[a:z]
            size = n[own] + length - 1
            at = np.repeat(place[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
            # Ids, as documents of all batches meet. Anchors ascend.
            anchors = pack(np.diff((anchor[own] >> np.uint64(8)).astype(np.uint32), prepend=np.uint32(0)))
            out.append((k, b.number, anchors, pack(np.stack([doc[own], b.docs[doc[own]]], axis=1).ravel()), pack(place[own]), pack(n[own]), zstandard.ZstdCompressor(level=1).compress(b.data[at].tobytes())))
    columns = list(zip(*out)) or [[]] * 7
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "batch", "anchors", "docs", "places", "windows", "text"]
    )


SPANS = "batch long, docs binary, starts binary, ends binary"


def spans_row(batch: int, docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
    return batch, pack(docs.astype(np.int64)), pack(starts.astype(np.int64)), pack(ends.astype(np.int64))


def _spans_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64() if k == 0 else pa.binary()) for k, c in enumerate(columns)], names=["batch", "docs", "starts", "ends"]
    )


class Shard:
    """Stretches of one shard, and where they come from; those that must be sorted end to end in a file."""

    def __init__(self, length: int, memory: int):
        self.length, self.memory = length, memory
        self.text, self.scratch = tempfile.TemporaryFile(), tempfile.TemporaryFile()
        self.parts: list[tuple] = []
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, r: dict) -> None:
        docs = unpack(r["docs"], np.int64).reshape(-1, 2)
        place, n = unpack(r["places"], np.int64), unpack(r["windows"], np.int64)
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["text"]), np.uint8)
        ends = np.cumsum(n + self.length - 1)
        content = span_hashes(raw, ends - n - self.length + 1, ends)
        anchor = np.cumsum(unpack(r["anchors"], np.uint32), dtype=np.uint32)
        self.parts.append((r["batch"], docs[:, 0].astype(np.int32), docs[:, 1], place, n.astype(np.int32), anchor, content, r["text"]))

    def settled(self) -> Iterator[tuple]:
        """Spans of stretches that are whole in a smaller id; writes those that are left to be sorted.

        Of an anchor's equal stretches those of the smallest id stand for all. Where an anchor then has one content
        only, nothing covers it. So the sort gets what is alike in part, however many copies there are.
        """
        anchor, content, ids = (np.concatenate([part[k] for part in self.parts]) for k in (5, 6, 2))
        order = np.lexsort((ids, content, anchor))
        runs = run_starts(anchor[order], content[order])
        sizes = np.diff(np.append(runs, len(order)))
        least = np.empty(len(order), np.int64)
        least[order] = np.repeat(ids[order][runs], sizes)
        groups = run_starts(anchor[order][runs])
        contents = np.diff(np.append(groups, len(runs)))
        several = np.empty(len(order), bool)
        several[order] = np.repeat(np.repeat(contents > 1, contents), sizes)
        at = 0
        for batch, doc, own, place, n, _, _, text in self.parts:
            here = slice(at, at + len(own))
            at += len(own)
            gone = np.flatnonzero(own > least[here])
            if len(gone):
                yield spans_row(batch, doc[gone], place[gone], place[gone] + n[gone] + self.length - 1)
            use = np.flatnonzero((own == least[here]) & several[here])
            if len(use):
                self._write(batch, doc, own, place, n, text, use)
        self.parts = []

    def _write(self, batch: int, doc, ids, place, n, text: bytes, use: np.ndarray) -> None:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8)
        size = n[use].astype(np.int64) + self.length - 1
        ends = np.cumsum(n.astype(np.int64) + self.length - 1)[use]
        which = np.repeat(np.arange(len(use)), size)
        step = np.arange(size.sum())
        # A 1 after every stretch; bytes are 2 and up.
        spaced = np.ones(len(step) + len(use), np.uint16)
        spaced[step + which] = raw[step + np.repeat(ends - np.cumsum(size), size)].astype(np.uint16) + 2
        self.text.write(spaced.tobytes())
        self.rows.append((batch, doc[use], ids[use], place[use], n[use], self.size + np.cumsum(size + 1) - size - 1))
        self.size += len(spaced)

    def covered(self) -> Iterator[tuple]:
        """Spans of windows whose string a smaller id has, a row per batch."""
        yield from self.settled()
        if not self.rows:
            return
        self.text.write(np.zeros(1, np.uint16).tobytes())
        self.text.flush()
        small = 2 * (self.size + 1) <= self.memory
        if small:
            self.text.seek(0)
            text = np.frombuffer(self.text.read(), np.uint16)
        else:
            text = np.memmap(self.text, np.uint16, "r")
        begin = np.concatenate([r[5] for r in self.rows])
        windows = np.concatenate([r[4] for r in self.rows])
        ids = np.concatenate([r[2] for r in self.rows])
        hit = np.zeros(self.size, bool)
        carried: list[np.ndarray] = []

        def settle(at: np.ndarray, run: np.ndarray) -> None:
            """Mark the windows at ``at``, sorted into runs of equal strings, that are not of the run's least id."""
            of = np.searchsorted(begin, at, "right") - 1
            real = at - begin[of] < windows[of]
            at, run, own = at[real], run[real], ids[of[real]]
            if len(at):
                starts = run_starts(run)
                least = np.repeat(np.minimum.reduceat(own, starts), np.diff(np.append(starts, len(at))))
                hit[at[own > least]] = True

        for at, shared in suffixes(text, self.length, self.memory, self.scratch):
            new = np.flatnonzero(shared < self.length)
            if not len(new):
                carried.append(at)
                continue
            carried.append(at[: new[0]])
            head = np.concatenate(carried)
            settle(head, np.zeros(len(head), np.int64))
            body = at[new[0] : new[-1]]
            settle(body, np.cumsum(shared[new[0] : new[-1]] < self.length))
            carried = [at[new[-1] :]]
        if carried:
            head = np.concatenate(carried)
            settle(head, np.zeros(len(head), np.int64))
        for batch, doc, _, place, n, start in self.rows:
            at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own = np.flatnonzero(hit[at])
            if not len(own):
                continue
            stretch = np.repeat(np.arange(len(n)), n)[own]
            first = place[stretch] + at[own] - start[stretch]
            new = np.flatnonzero(np.append(True, (stretch[1:] != stretch[:-1]) | (first[1:] != first[:-1] + 1)))
            last = np.append(new[1:], len(own)) - 1
            yield spans_row(batch, doc[stretch[new]], first[new], first[last] + self.length)

    def close(self) -> None:
        self.text.close()
        self.scratch.close()


def _sort(rows: Iterable[pa.RecordBatch], length: int, memory: int) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of one shard after another; rows come sorted by shard."""
    shard, number = None, None
    for part in rows:
        for r in part.to_pylist():
            if r["shard"] != number:
                if shard:
                    yield _spans_batch(list(shard.covered()))
                    shard.close()
                shard, number = Shard(length, memory), r["shard"]
            shard.add(r)
    if shard:
        yield _spans_batch(list(shard.covered()))
        shard.close()


def _settled(rows: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for part in rows:
        out = []
        for r in part.to_pylist():
            place = unpack(r["places"], np.int64)
            out.append(spans_row(r["batch"], unpack(r["docs"], np.int64), place, place + unpack(r["windows"], np.int64) + length - 1))
        yield _spans_batch(out)


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def united(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of the maximal runs that spans cover; spans do not cross documents."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    doc, reach = np.searchsorted(offsets, starts, "right") - 1, np.maximum.accumulate(ends)
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], starts[first], reach[np.append(first[1:], len(starts)) - 1] if len(first) else reach


def _remove(batch: pa.Table, spans: pa.Table) -> pa.Table:
    """The remaining bytes of every document of a batch."""
    b = Batch(batch.to_pylist()[0])
    none = [np.zeros(0, np.int64)]
    starts, ends = (np.concatenate(none + [unpack(x, np.int64) for x in spans.column(c).to_pylist()]) for c in ("starts", "ends"))
    doc, starts, ends = united(starts, ends, b.offsets)
    bounds = np.searchsorted(doc, np.arange(len(b.docs) + 1))
    raw, kept = memoryview(b.data), []
    for a, z, low, high in zip(b.offsets[:-1].tolist(), b.offsets[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
        edges = [a, *np.stack([starts[low:high], ends[low:high]], axis=1).ravel().tolist(), z]
        kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])))
    return pa.table(
        {
            "doc_id": pa.array(b.docs),
            "n_bytes": pa.array(b.sizes),
            "n_removed": pa.array(np.bincount(doc, ends - starts, len(b.docs)).astype(np.int64)),
            "n_spans": pa.array(np.diff(bounds), pa.int64()),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, batch_bytes: int = BATCH, memory: int = MEMORY, shard_bytes: int = SHARD
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: documents without bytes that a smaller ``doc_id`` holds too.

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id. Strings
    are judged on the input; matches do not cross documents. ``n_spans`` counts maximal removed runs, ``kept`` are the
    remaining bytes of the UTF-8 text.

    Null and empty texts have no bytes. Rows without a ``doc_id`` are left out. Repeated rows of an id are one document:
    they do not cover each other, and each loses what smaller ids hold. Empty tables give empty tables, other columns do
    not matter. ``length`` must exceed ``anchors.GRAM``.
    """
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batches = materialize(texts_of(docs).mapInArrow(lambda it: _batches(it, batch_bytes), BATCHES), "batches")
    total = batches.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    # About one anchor in 15 bytes.
    buckets = max(least, total // 15 // ASKED + 1)
    shards = max(2 * least, total // shard_bytes + 1)
    asked = batches.mapInArrow(lambda it: _ask(it, length, buckets), "bucket int, batch long, anchors binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer, "batch long, bucket int, shared binary").groupBy("batch")
    cut = batches.groupBy("batch").cogroup(answers).applyInArrow(lambda a, b: _cut(a, b, length, buckets, shards), CUT)
    cut = materialize(cut, "stretches")
    sorted_ = (
        cut.filter("shard >= 0").repartition(least, "shard").sortWithinPartitions("shard")
        .mapInArrow(lambda it: _sort(it, length, memory), SPANS)
    )
    spans = cut.filter("shard = -1").mapInArrow(lambda it: _settled(it, length), SPANS).unionByName(sorted_)
    return batches.groupBy("batch").cogroup(spans.groupBy("batch")).applyInArrow(_remove, OUT)


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` with the production parameters."""
    kept = remove_repeats(docs)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
