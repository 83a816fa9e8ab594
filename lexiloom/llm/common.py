"""What the operators share: columns, written stages, and words as numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACE = np.zeros(256, bool)
SPACE[list(SPACES)] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_BYTES = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

CHUNK = 1 << 20


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, in any letter case."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` of the rows that have an id; a null text counts as empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).filter("doc_id IS NOT NULL")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the offsets of its rows."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give back memory that is free in this process: workers outlive their tasks, and wait beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def text_chunks(
    batches: Iterable[pa.RecordBatch], size: int = CHUNK
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``size`` bytes of text: rows, bytes, offsets."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            a, b = offsets[first], offsets[last]
            yield batch.slice(first, last - first), data[a:b], offsets[first : last + 1] - a
            first = last
    batch = data = offsets = None
    release()


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (a run without ASCII white space, inside a row)."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, 2 * len(_powers[0]))
        for k, base in ((0, _BASE), (1, _INVERSE)):
            steps = np.full(n, base)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte string ``data[start:end]``."""
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Index of the first row of every run of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def binary_column(blobs: list[bytes]) -> pa.Array:
    return pa.array(blobs, pa.binary())
