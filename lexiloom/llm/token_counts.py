"""Token counts by a library's byte-level BPE, with huge documents encoded in overlapping chunks.

1. Documents of up to a chunk are cut at stable places (see 3), before each word. The library encodes every distinct segment
   once, a batch at a time, and the counts of a document's segments add up.
2. Longer ones are cut into chunks that run ``overlap`` characters into the next one. Chunks are rows of their own, dealt
   out evenly, so a huge document spreads over the cluster. Each is encoded with offsets.
3. Neighbours are spliced at the first *stable* place that is a token boundary in both encodings of their overlap. Stable
   places are those that the tokenizer's pattern ends a piece at whatever comes before and after (``stable_places``):
   the left encoding is right up to there, and the right one from there on. The tokens of the left chunk behind the
   place and those of the right chunk before it are taken off the sum of all chunks.
4. Where an overlap has no such place, it is widened by the whole next chunk: the two become one chunk and are encoded
   again, with all chunks of the document. At worst a document without any stable place is encoded as a whole.

Nothing but chunks of long documents is shuffled or written.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.llm.common import text_chunks, texts_of
from lexiloom.session import materialize

FILE = "byte_bpe_50k.json"
#: Characters of a chunk, and how far it runs into the next one.
CHUNK, OVERLAP = 1 << 15, 1 << 10
LIMIT = 512
#: Segments whose counts a worker keeps.
CACHED = 400_000

#: Characters that are letters or digits in every version of Unicode, and such that are neither and end a word.
WORD = "A-Za-z0-9À-ÖØ-öø-ʯͰ-ͳΑ-ΡΣ-ώА-яӐ-ӹא-תء-غက-ဪぁ-ゖァ-ヺ一-龥가-힣"
AFTER = " \t\n.,;:!?、。，！？"
SPACES = " \t\n"


def tokenizer_file(path: str | None = None) -> str:
    """A tokenizer's definition, read by the driver and sent with the tasks (a few megabytes)."""
    with open(path or public_tokenizers.path(FILE), encoding="utf-8") as file:
        return file.read()


class Counter:
    """A tokenizer, and the places at which its encodings may be spliced."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        before = parts.get("pre_tokenizer") or {}
        if parts.get("normalizer") or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or before.get("add_prefix_space"):
            raise ValueError("stable places are known for byte-level BPE with its usual pattern only")
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = "".join(x["content"] for x in parts.get("added_tokens", []))
        if any(x.get("lstrip") or x.get("rstrip") for x in parts.get("added_tokens", [])):
            raise ValueError("added tokens that take white space with them are not supported")
        ends, spaces = ("".join(c for c in chars if c not in special) for chars in (AFTER, SPACES))
        self.segments = re.compile(f"(?<=[!-~{WORD}])(?=[{re.escape(spaces)}])").split
        self.cache: dict[str, int] = {}
        self.places = regex.compile(f"(?<=[{WORD}])[{regex.escape(ends)}]|(?<=[!-~])[{regex.escape(spaces)}]").finditer

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, as the sum over its segments between stable places."""
        split = [self.segments(text) for text in texts]
        new = list(set().union(*split) - self.cache.keys())
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            new = list(set().union(*split))
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.cache.update(zip(new, map(len, found)))
        get = self.cache.__getitem__
        return [sum(map(get, segments)) for segments in split]

    def stable_places(self, text: str, first: int, last: int) -> list[int]:
        """Places between ``first`` and ``last`` at which every encoding of any longer text has a boundary.

        A piece of the pattern is a run of letters, of digits, of other signs, or of white space, and may begin with a
        blank or be the end of a contraction. So it ends between a letter or digit and a character that is neither, and
        between a visible sign and white space, and the pattern looks ahead over white space only. Places whose
        character is part of an added token are left out, because that is cut out before the pattern is applied.
        """
        return [m.start() for m in self.places(text, first, last)]

    def chunk(self, text: str, head: int, tail: int) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]]]:
        """Tokens, and (place, tokens before it) of common places in the first ``head`` and last ``tail`` characters.

        Places count from where the overlap starts.
        """
        offsets = self.tokenizer.encode(text, add_special_tokens=False).offsets
        before = {a: k for k, (a, _) in reversed(list(enumerate(offsets)))}
        start = len(text) - tail
        return (
            len(offsets),
            [(p, before[p]) for p in self.stable_places(text, 0, min(head, len(text))) if p in before],
            [(p - start, before[p]) for p in (self.stable_places(text, start + 1, len(text)) if tail else ()) if p in before],
        )


@lru_cache(maxsize=2)
def _counter(definition: str) -> Counter:
    return Counter(definition)


def _short(rows: Iterable[pa.RecordBatch], definition: str) -> Iterator[pa.RecordBatch]:
    for part, _, offsets in text_chunks(rows):
        counts = _counter(definition).counts(part.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(offsets[1:] - offsets[:-1], pa.int64()), pa.array(counts, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )
    # Workers outlive their tasks.
    _counter(definition).cache.clear()


CHUNKS = pa.schema([("uid", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()), ("tail", pa.int32()), ("text", pa.string())])
CHUNKS_DDL = "uid long, part int, last boolean, tail int, text string"


def _cut(rows: Iterable[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for k in range(batch.num_rows):
            uid, text = batch.column("uid")[k].as_py(), batch.column("text")[k].as_py()
            # The last chunk is longer than an overlap.
            n = max(1, -(-(len(text) - overlap) // chunk))
            for first in range(0, n, 32):
                own = range(first, min(first + 32, n))
                ends = [len(text) if i == n - 1 else (i + 1) * chunk + overlap for i in own]
                columns = [[uid] * len(own), own, [i == n - 1 for i in own], [0 if i == n - 1 else overlap for i in own]]
                columns.append([text[i * chunk : z] for i, z in zip(own, ends)])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CHUNKS)], schema=CHUNKS)


SEAM = pa.list_(pa.struct([("place", pa.int32()), ("before", pa.int64())]))
CODED = pa.schema([("uid", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()), ("n", pa.int64()), ("head", SEAM), ("tail", SEAM)])
CODED_DDL = (
    "uid long, part int, last boolean, n long, head array<struct<place: int, before: long>>, "
    "tail array<struct<place: int, before: long>>"
)


def _encode(rows: Iterable[pa.RecordBatch], definition: str, overlap: int) -> Iterator[pa.RecordBatch]:
    counter = _counter(definition)
    for part in rows:
        for r in (part.slice(k, 1).to_pylist()[0] for k in range(part.num_rows)):
            n, head, tail = counter.chunk(r["text"], overlap if r["part"] else 0, r["tail"])
            values = [r["uid"], r["part"], r["last"], n, *([{"place": p, "before": b} for p, b in x] for x in (head, tail))]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, CODED)], schema=CODED)


def splices(coded: DataFrame) -> DataFrame:
    """``uid, part, surplus``: the seams before each part that have a common stable place, and the tokens too many there."""
    left = coded.filter("NOT last").select("uid", (F.col("part") + 1).alias("part"), "n", F.inline("tail"))
    left = left.select("uid", "part", "place", (F.col("n") - F.col("before")).alias("behind"))
    right = coded.filter("part > 0").select("uid", "part", F.inline("head"))
    found = left.join(right, ["uid", "part", "place"]).groupBy("uid", "part")
    return found.agg(F.min_by(F.col("behind") + F.col("before"), "place").alias("surplus"))


def widened(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """Chunks of the documents with a seam that is not ``found``, with the chunks on both sides of it made one."""
    ok = found.select("uid", "part", F.lit(1).alias("ok"))
    seams = chunks.select("uid", "part").join(ok, ["uid", "part"], "left").withColumn("ok", F.coalesce("ok", F.lit(0)))
    failed = seams.filter("part > 0 AND ok = 0").select("uid").distinct()
    # Numbers only; a document is one row of at most 2 GB, so it has a few ten thousand parts at most.
    so_far = Window.partitionBy("uid").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    groups = seams.join(failed, "uid").select("uid", "part", F.sum("ok").over(so_far).cast("int").alias("group"))
    rows = chunks.join(groups, ["uid", "part"]).groupBy("uid", "group").agg(
        F.array_sort(F.collect_list(F.struct("part", "last", "tail", "text"))).alias("parts")
    )
    end = F.element_at("parts", -1)
    # All but the last give up their overlaps.
    own = F.transform(
        F.col("parts"),
        lambda x: F.when(x["part"] == end["part"], x["text"]).otherwise(x["text"].substr(F.lit(1), F.length(x["text"]) - x["tail"])),
    )
    return rows.select(
        "uid", F.col("group").alias("part"), end["last"].alias("last"), end["tail"].alias("tail"), F.concat_ws("", own).alias("text")
    )


def _long(long: DataFrame, definition: str, chunk: int, overlap: int) -> DataFrame:
    """``uid, n_tokens`` of the rows of ``long`` (``uid, text``)."""
    spark = long.sparkSession
    chunks = materialize(long.mapInArrow(lambda it: _cut(it, chunk, overlap), CHUNKS_DDL), "token-chunks")
    # Dealt out by chunk, so the chunks of one document go to many tasks.
    dealt = chunks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "uid", "part")
    done = None
    while True:
        coded = materialize(dealt.mapInArrow(lambda it: _encode(it, definition, overlap), CODED_DDL), "chunk-tokens")
        found = materialize(splices(coded), "splices")
        again = materialize(widened(chunks, found), "wider-chunks")
        more = not again.isEmpty()
        tokens = coded.select("uid", "n").unionByName(found.select("uid", (-F.col("surplus")).alias("n")))
        if more:
            tokens = tokens.join(again.select("uid").distinct(), "uid", "left_anti")
        tokens = tokens.groupBy("uid").agg(F.sum("n").alias("n_tokens"))
        done = tokens if done is None else done.unionByName(tokens)
        if not more:
            return done
        chunks = dealt = again


def token_counts(
    docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    Tokens are those of the library for the definition ``tokenizer`` (a byte-level BPE as JSON text; see ``tokenizer_file``),
    without begin, end or added special tokens, truncation or padding; a special token's string inside a text is that
    token, as is the library's default. ``over_limit`` means more than ``limit`` tokens. Texts are counted whole.

    A null text counts as empty: no bytes, no tokens. Rows without a ``doc_id`` are left out, repeated rows are
    counted each, other columns do not matter, an empty table gives an empty one.
    """
    if not 1 < overlap <= chunk:
        raise ValueError("an overlap has at least two characters and at most a chunk")
    definition = tokenizer or tokenizer_file()
    texts = texts_of(docs)
    is_long = F.length("text") > chunk + overlap
    short = texts.filter(~is_long).mapInArrow(lambda it: _short(it, definition), "doc_id long, n_bytes long, n_tokens long")
    # Written, so that a row keeps its number.
    long = materialize(texts.filter(is_long).withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    counted = _long(long.select("uid", "text"), definition, chunk, overlap)
    sizes = long.select("uid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    rows = short.unionByName(sizes.join(counted, "uid").select("doc_id", "n_bytes", "n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
