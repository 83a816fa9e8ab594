"""Benchmark passages in documents, up to an edit distance over words.

Items are cut into pieces of at most ``PIECE`` words, evenly. By the pigeonhole principle, of a match with ``d``
edits one of ``m`` pieces has at most ``d // m``, so a walk need not stay in step any longer than a piece, however
long the item is. Windows as long as a piece are embedded by random walks (Chakraborty, Goldenberg and Koucky): a step
writes the word the walk stands on and moves on or not by a random bit that depends on the step and
the word. Strings within a small edit distance get embeddings of small Hamming distance, so tables
keyed by a few sampled steps find them; walks and samples are repeated until the target recall
is reached. A walk takes two steps a word on average, and as many are sampled. What the tables find is confirmed by the exact edit distance.

Only windows that share a run of words with the piece at the fitting place are embedded. By the pigeonhole
principle no match is lost: with ``d`` edits, a piece of ``n`` words keeps an unchanged run of at
least ``(n - d) / (d + 1)`` words.

Documents are read once per block of items and not shuffled. Items are the stated queries; a block's index
is bounded by ``BLOCK_ITEMS`` and ``BLOCK_BYTES`` and sent to the tasks. An item has no greatest length.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import SPACES, TO_LOWER, mix, run_starts, span_hashes, text_chunks, texts_of, word_bounds
from lexiloom.session import materialize

BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
#: Words of a piece at most, and words of an item up to which its bit vectors are kept.
PIECE, KEPT = 24, 2048
#: Items of fewer words must be found word for word.
EXACT_BELOW = 5
SAMPLED = 3
STEPS = 2
WALKS = 9
WINDOWS = 4096
# A-Z in lower case, ASCII punctuation as white space.
PLAIN = TO_LOWER.copy()
PLAIN[[b for b in range(33, 127) if not chr(b).isalnum()]] = SPACES[0]
_RANDOM = np.random.default_rng(77)
_PLACE = _RANDOM.integers(0, 2**63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SAMPLE = _RANDOM.integers(0, 2**63, SAMPLED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
END = np.uint64(0)


def hamming_share(percent: int) -> float:
    """Share of the steps in which embeddings of pieces with the allowed edits differ, measured on random words.

    It grows by a point for each point of edits beyond 25.
    """
    return min(0.95, 0.6 + 0.01 * max(0, 75 - percent))


def tables_for(recall: float, hamming_share: float, sampled: int = SAMPLED) -> int:
    """Tables that find a pair, whose embeddings differ in that share, with that probability."""
    hit = (1 - hamming_share) ** sampled
    return math.ceil(math.log(1 - recall) / math.log(1 - hit))


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows, and the first word of each row (with the end)."""
    data = PLAIN[data]
    starts, ends, rows = word_bounds(data, offsets)
    return span_hashes(data, starts, ends) | np.uint64(1), np.searchsorted(rows, np.arange(len(offsets)))


def _bits(places: list[int], n: int) -> int:
    """A number with those of its ``n`` bits set."""
    if len(places) < 8:
        return sum(1 << k for k in places)
    bits = np.zeros(n, np.uint8)
    bits[places] = 1
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def allowed_edits(n: int, percent: int) -> int:
    """Edits of an item of ``n`` words; one of fewer than ``EXACT_BELOW`` words must occur as it is."""
    return n * (100 - percent) // 100 if n >= EXACT_BELOW else 0


class Items:
    """A block of items: seeds, and the sampled steps of the embeddings of their pieces."""

    def __init__(self, ids: list[int], texts: list[str], percent: int, recall: float):
        column = pa.array(texts, pa.large_string())
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[: len(texts) + 1]
        words, first = plain_words(data, offsets)
        keep = [i for i in range(len(ids)) if first[i + 1] > first[i]]
        self.ids = [ids[i] for i in keep]
        self.words = [words[first[i] : first[i + 1]] for i in keep]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.edits = np.array([allowed_edits(int(n), percent) for n in self.size], np.int64)
        self.masks: dict[int, dict[int, int]] = {}
        count = -(-self.size // PIECE)
        self.item = np.repeat(np.arange(len(keep)), count)
        nth = np.arange(len(self.item)) - np.repeat(np.cumsum(count) - count, count)
        self.offset = nth * self.size[self.item] // count[self.item]
        self.length = (nth + 1) * self.size[self.item] // count[self.item] - self.offset
        pieces = [self.words[i][o : o + n] for i, o, n in zip(self.item.tolist(), self.offset.tolist(), self.length.tolist())]
        seeds = {}
        for i, (own, edits) in enumerate(zip(pieces, (self.edits // count)[self.item].tolist())):
            run = min(3, -(-(len(own) - edits) // (edits + 1)))
            hashes, at, piece = seeds.setdefault(run, ([], [], []))
            n = len(own) - run + 1
            hashes.append(self.runs(own, run))
            at.append(np.arange(n))
            piece.append(np.full(n, i))
        self.seeds = {}
        for run, columns in seeds.items():
            hashes, at, piece = map(np.concatenate, columns)
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            seen = np.zeros(1 << 22, bool)
            seen[hashes >> np.uint64(42)] = True
            self.seeds[run] = hashes, at[order], piece[order], seen
        per_walk = -(-tables_for(recall, hamming_share(percent)) // WALKS)
        self.samples = np.random.default_rng(99).random((WALKS, per_walk, SAMPLED))
        self.keys = [np.zeros((len(pieces), per_walk), np.uint64) for _ in range(WALKS)]
        for k in range(0, len(pieces), WINDOWS):
            size = self.length[k : k + WINDOWS]
            flat = np.concatenate([*pieces[k : k + WINDOWS], [END]])
            starts = np.cumsum(size) - size
            for r in range(WALKS):
                self.keys[r][k : k + WINDOWS] = self.walk(r, flat, starts, starts + size, size)

    @staticmethod
    def runs(words: np.ndarray, run: int) -> np.ndarray:
        out = np.zeros(max(0, len(words) - run + 1), np.uint64)
        for k in range(run):
            out += words[k : k + len(out)] * _PLACE[k]
        return mix(out)

    def walk(self, r: int, words: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Keys of the sampled steps of walk ``r`` over windows of ``words``: window x table; ``END`` for those beyond the end."""
        steps = STEPS * int(size.max())
        out = np.zeros((len(starts), steps), np.uint64)
        at = starts.copy()
        beyond = len(words) - 1
        for step in range(steps):
            if step % 64 == 0:
                bits = mix(words ^ mix(np.full(1, r << 32 | step // 64, np.uint64) + _PLACE[3]))
            here = np.where(at < stops, at, beyond)
            word = words[here]
            out[:, step] = word
            at += ((bits[here] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
        columns = (self.samples[r][None] * (STEPS * size)[:, None, None]).astype(np.int64)
        sampled = out[np.arange(len(starts))[:, None, None], columns]
        keys = mix((sampled * _SAMPLE).sum(axis=2, dtype=np.uint64)) | np.uint64(1)
        return np.where((sampled == END).any(axis=2), END, keys)

    def windows(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece, first word and row of every window that holds a seed at its place."""
        found = [np.zeros((3, 0), np.int64)]
        for run, (hashes, at, piece, seen) in self.seeds.items():
            own = self.runs(words, run)
            place = np.flatnonzero(seen[own >> np.uint64(42)])
            low = np.searchsorted(hashes, own[place], "left")
            count = np.searchsorted(hashes, own[place], "right") - low
            place, low, count = place[count > 0], low[count > 0], count[count > 0]
            # No run over the end of a row.
            inside = np.searchsorted(first, place, "right") == np.searchsorted(first, place + run - 1, "right")
            place, low, count = place[inside], low[inside], count[inside]
            which = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            row = np.searchsorted(first, place, "right") - 1
            found.append(np.stack([piece[which], np.repeat(place, count) - at[which], np.repeat(row, count)]))
        found = np.concatenate(found, axis=1)
        piece, start, row = found[:, np.lexsort(found)]
        one = run_starts(piece, start, row)
        return piece[one], start[one], row[one]

    def candidates(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece, first word and row of the windows that a table finds."""
        piece, start, rows = self.windows(words, first)
        flat = np.append(words, END)
        out = []
        for k in range(0, len(piece), WINDOWS):
            i, s = piece[k : k + WINDOWS], start[k : k + WINDOWS]
            n = self.length[i]
            row = rows[k : k + WINDOWS]
            low, high = first[row], first[row + 1]
            begin, stop = np.clip(s, low, high), np.clip(s + n, low, high)
            hit = np.zeros(len(i), bool)
            rest = np.arange(len(i))
            for r in range(WALKS):
                # Words of these windows only, so that bits are computed for them alone.
                base, top = int(begin[rest].min()), int(stop[rest].max())
                part = np.append(flat[base:top], END)
                keys = self.walk(r, part, begin[rest] - base, stop[rest] - base, n[rest])
                # Two walks past their ends do not agree.
                same = ((keys == self.keys[r][i[rest]]) & (keys != END)).any(axis=1)
                hit[rest[same]] = True
                rest = rest[~same]
                if not len(rest):
                    break
            out.append((i[hit], s[hit], row[hit]))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(map(np.concatenate, zip(*out)))

    def distance(self, item: int, words: list[int]) -> int:
        """Least edit distance of the item to any run of ``words``, by bit vectors."""
        own, n = self.words[item], len(self.words[item])
        masks = self.masks.get(item)
        if masks is None:
            masks, needed = {}, None if n <= KEPT else set(words)
            for k, word in enumerate(own.tolist()):
                if needed is None or word in needed:
                    masks.setdefault(word, []).append(k)
            masks = {word: _bits(places, n) for word, places in masks.items()}
            if needed is None:
                self.masks[item] = masks
        full, top = (1 << n) - 1, 1 << (n - 1)
        plus, minus, score, best = full, 0, n, n
        for word in words:
            eq = masks.get(word, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (~(xh | plus) & full)
            down = plus & xh
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up, down = (up << 1) & full, (down << 1) & full
            plus, minus = down | (~(xv | up) & full), up & xv
            best = min(best, score)
        return best

    def matches(self, words: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], int]:
        """Least edits for every (row, item) that matches."""
        out: dict[tuple[int, int], int] = {}
        piece, start, row = self.candidates(words, first)
        item = self.item[piece]
        begin, d = start - self.offset[piece], self.edits[item]
        a, z = np.maximum(first[row], begin - d), np.minimum(first[row + 1], begin + self.size[item] + d)
        order = np.lexsort((a, item, row))
        # Stretches of a row that overlap are compared with their item at once.
        reach, at = -1, None
        stretches = []
        for k in order.tolist():
            if at == (row[k], item[k]) and a[k] <= reach:
                reach = max(reach, int(z[k]))
                stretches[-1][3] = reach
            else:
                at, reach = (row[k], item[k]), int(z[k])
                stretches.append([int(row[k]), int(item[k]), int(a[k]), reach])
        for r, i, low, high in stretches:
            d = int(self.edits[i])
            if out.get((r, i), d + 1) == 0:
                continue
            got = self.distance(i, words[low:high].tolist())
            if got <= d:
                out[r, i] = min(got, out.get((r, i), got))
        return out


def _match(batches: Iterable[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        words, first = plain_words(data, offsets)
        found = items.matches(words, first) if items.ids and len(words) else {}
        ids = rows.column("doc_id").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[r] for r, _ in found], pa.int64()),
                pa.array([items.ids[i] for _, i in found], pa.int64()),
                pa.array(list(found.values()), pa.int32()),
            ],
            names=["doc_id", "item_id", "edits"],
        )


def matches(docs: DataFrame, items: DataFrame, percent: int = 80, recall: float = 0.99, block: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id, item_id, edits``: the items of which a document holds a close variant.

    Words are runs without white space and ASCII punctuation, A-Z lower-cased. An item of ``n`` words
    matches a document that has a run of words within ``n * (100 - percent) // 100`` word insertions,
    deletions and replacements of it; items of fewer than five words match word for word. ``recall`` is what the tables aim at for pairs of pieces
    with as many edits as are allowed (see ``hamming_share``).

    Null and empty texts, on either side, match nothing, nor do items without a word
    or without ``item_id``. Repeated documents or items repeat their matches (once per ``doc_id`` and
    ``item_id``). Empty tables give no rows; other columns do not matter. More than ``block`` items, or
    ``BLOCK_BYTES`` of their text, are taken in blocks, with one pass over the documents each. Items may have any length.
    """
    texts = texts_of(docs)
    queries = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    n, size = queries.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block), -(-size // BLOCK_BYTES))
    out = []
    for k in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        own = own.distinct().orderBy("item_id", "text").collect()
        index = Items([r[0] for r in own], [r[1] for r in own], percent, recall)
        found = texts.mapInArrow(lambda it, index=index: _match(it, index), "doc_id long, item_id long, edits int")
        # One index at a time: its matches are written before the next one is built.
        out.append(materialize(found, f"block-matches-{k}") if blocks > 1 else found)
    return reduce(DataFrame.unionByName, out).groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def contamination(docs: DataFrame, items: DataFrame, percent: int = 80, recall: float = 0.99) -> DataFrame:
    """``doc_id, contaminated, n_items, item_ids`` of every document; ids ascend, none is an empty list."""
    found = materialize(matches(docs, items, percent, recall), "benchmark-matches")
    lists = found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    out = texts_of(docs).select("doc_id").join(lists, "doc_id", "left")
    ids = F.coalesce("item_ids", F.array().cast("array<long>"))
    return out.select("doc_id", (F.size(ids) > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"))


def clean(docs: DataFrame, items: DataFrame, percent: int = 80, recall: float = 0.99) -> DataFrame:
    """``docs`` without the contaminated ones; rows without a ``doc_id`` stay."""
    found = materialize(matches(docs, items, percent, recall).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti")
