"""Byte-level BPE in padded numpy matrices.

The distinct pieces of a run of texts that are not in the worker's cache are laid out by length
in padded matrices of token ids. Every round merges, in each row, the leftmost pair of least
rank, closes the gap, and looks up the two pairs that changed in an open-addressed hash table;
rows without a pair left are done and leave the matrix. Pieces beyond the widest matrix (a
"word" of hundreds of bytes) are merged through a heap, in the same order.

Encoding and decoding are maps over rows: nothing is shuffled, and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import release, text_chunks, texts_of

RANKS = "byte_bpe_multi_50k.tiktoken"
WIDTHS = (4, 8, 16, 32, 64, 128, 256)
CELLS = 1 << 19
CACHED = 200_000
NONE = np.int32(2**31 - 1)


class PairTable:
    """Rank of the token that two adjacent tokens form, in an open-addressed hash table."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        keys = np.array([(a << 32) | b for a, b in pairs], np.uint64)
        ranks = np.array(list(pairs.values()), np.int32)
        self.bits = max(8, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << self.bits, NONE)
        self.probes = 0
        slots = self._slots(keys)
        while len(keys):
            self.probes += 1
            free = self.keys[slots] == np.uint64(2**64 - 1)
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.ranks[slots[placed]] = ranks[placed]
            keys, ranks, slots = keys[~placed], ranks[~placed], self._next(slots[~placed])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, slots: np.ndarray) -> np.ndarray:
        return (slots + 1) & ((1 << self.bits) - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where they form no token or one side is padding (-1)."""
        keys = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32)
        keys[(left < 0) | (right < 0)] = np.uint64(2**64 - 2)
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        while len(open_):
            slots[open_] = self._next(slots[open_])
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2**64 - 1))]
        return out


class Bpe:
    """A vocabulary of ranks, with what encoding and decoding need."""

    def __init__(self, ranks_file: bytes, pattern: str):
        self.ranks = {
            base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file.splitlines()) if token
        }
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # White space as the pattern's own engine has it: the Unicode property, nothing else.
        self.split = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
        ).findall
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.pairs = PairTable(pairs)
        self.pair_ranks = pairs
        self.cache: dict[str, bytes] = {}

    def _rounds(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of at most ``width`` bytes."""
        n = len(pieces)
        padded = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        sizes = np.array([len(p) for p in pieces])
        columns = np.arange(width)
        ids = np.where(columns < sizes[:, None], self.bytes[padded], -1).astype(np.int32)
        ranks = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        at, out = np.arange(n), [b""] * n
        while True:
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(at)), best]
            done = rank == NONE
            if done.any():
                for row, i, size in zip(ids[done], at[done].tolist(), sizes[done].tolist()):
                    out[i] = row[:size].astype("<u4").tobytes()
                go = ~done
                ids, ranks, at, sizes, best, rank = ids[go], ranks[go], at[go], sizes[go], best[go], rank[go]
            if not len(at):
                return out
            rows = np.arange(len(at))
            # Close the gap right of the merged pair.
            after = columns[1:-1] > best[:, None]
            ids[rows, best] = rank
            ids[:, 1:-1] = np.where(after | (columns[1:-1] == best[:, None] + 1), ids[:, 2:], ids[:, 1:-1])
            ids[:, -1] = -1
            ranks[:, :-1] = np.where(columns[: width - 2] >= best[:, None], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            sizes = sizes - 1
            right = np.minimum(best + 1, width - 1)
            ranks[rows, np.minimum(best, width - 2)] = np.where(
                best + 1 < width, self.pairs.find(ids[rows, best], ids[rows, right]), NONE
            )
            some = best > 0
            ranks[rows[some], best[some] - 1] = self.pairs.find(ids[rows[some], best[some] - 1], ids[rows[some], best[some]])

    def _heap(self, piece: bytes) -> bytes:
        """Ids of one long piece: leftmost pair of least rank first, in n log n steps."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        get = self.pair_ranks.get
        heap = [(r, i) for i in range(len(ids) - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (r := get((rank, ids[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := get((ids[before[i]], rank))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Little-endian 32-bit ids of each piece."""
        out, by_width = {}, {w: [] for w in WIDTHS}
        for piece in pieces:
            raw = piece.encode()
            if (rank := self.ranks.get(raw)) is not None:
                out[piece] = rank.to_bytes(4, "little")
            elif len(raw) > WIDTHS[-1]:
                out[piece] = self._heap(raw)
            else:
                by_width[next(w for w in WIDTHS if len(raw) <= w)].append((piece, raw))
        for width, own in by_width.items():
            step = CELLS // width
            for k in range(0, len(own), step):
                part = own[k : k + step]
                out.update(zip((p for p, _ in part), self._rounds([raw for _, raw in part], width)))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(text) for text in texts]
        new = set().union(*split) - self.cache.keys()
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            new = set().union(*split)
        self.cache.update(self.encode_pieces(new))
        get = self.cache.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _bpe(ranks_file: bytes, pattern: str) -> Bpe:
    return Bpe(ranks_file, pattern)


def ranks_file(path: str | None = None) -> bytes:
    """A rank file's content, read by the driver and sent with the tasks (about a megabyte)."""
    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        return file.read()


def encode(docs: DataFrame, ranks: bytes | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document; ``ids`` are little-endian unsigned 32-bit integers.

    A null text counts as empty and gives no tokens. Rows without a ``doc_id`` are left out,
    repeated rows are encoded each, other columns are ignored, an empty table gives an empty one. A
    text of any length is encoded whole; strings of special tokens are ordinary text.
    """
    ranks = ranks or ranks_file()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(ranks, pattern)
        for rows, _, _ in text_chunks(batches):
            ids = bpe.encode(rows.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: bytes | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``encoded`` (``doc_id, n_tokens, ids``) with the bytes that the ids stand for, as ``decoded``.

    Null ids decode to nothing; an id outside the vocabulary is an error.
    """
    ranks = ranks or ranks_file()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(ranks, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                decoded = [bpe.decode(x or b"") for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())], names=[*part.schema.names, "decoded"]
                )

    columns = encoded.select("doc_id", "n_tokens", "ids")
    return columns.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(docs: DataFrame, ranks: bytes | None = None) -> DataFrame:
    """Round trip of every document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Texts are encoded and decoded in one worker, so that a task holds the vocabulary once.
    """
    ranks, pattern = ranks or ranks_file(), public_tokenizers.PATTERN

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(ranks, pattern)
        for rows, _, _ in text_chunks(batches):
            ids = bpe.encode(rows.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        bpe.cache.clear()
        release()

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
