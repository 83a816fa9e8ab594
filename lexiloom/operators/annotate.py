"""Running annotators the caller brings over sentences."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The analyses a task may ask for.
ANALYSES = ("POS", "CONSTITUENCY", "DEPENDENCY")

#: Sentences of short documents that are annotated together.
SENTENCES = 4096

# What an annotator yields for every sentence it finds in a piece of text:
#   POS           a list of (word, tag)
#   DEPENDENCY    a list of (relation, governor, dependent), in the parser's order
#   CONSTITUENCY  a bracketed tree
Annotator = Callable[[str], Iterable[Any]]


@dataclass(frozen=True)
class Batched:
    """A factory of annotators that take many sentences at once and give as many results, in order.

    Sentences of similar length come together, at most ``size`` of them.
    """

    factory: Callable[[], Callable[[list[str]], Sequence[Iterable[Any]]]]
    size: int = 64


AnnotatorFactory = Callable[[], Annotator] | Batched

TOKENS = "array<struct<word:string,tag:string>>"
EDGES = "array<struct<pos:int,rel:string,gov:string,dep:string>>"
_TOKENS = pa.list_(pa.struct([("word", pa.string()), ("tag", pa.string())]))
_EDGES = pa.list_(
    pa.struct(
        [("pos", pa.int32()), ("rel", pa.string()), ("gov", pa.string()), ("dep", pa.string())]
    )
)


def _check(values: Iterable[Any]) -> None:
    for value in values:
        if not isinstance(value, str):
            raise TypeError(f"expected a string, got {type(value).__name__}")


def _cells(analysis: str, found: Any) -> tuple[Any, Any, Any]:
    """The columns of one annotation; anything but strings of the right arity is an error."""
    if analysis == "POS":
        tokens = [(word, tag) for word, tag in found]
        _check(chain.from_iterable(tokens))
        return list(zip(*tokens)) or [(), ()], None, None
    if analysis == "DEPENDENCY":
        edges = [(rel, gov, dep) for rel, gov, dep in found]
        _check(chain.from_iterable(edges))
        return None, list(zip(*edges)) or [(), (), ()], None
    _check([found])
    return None, None, found


def _list_array(cells: Sequence[Any], kind: pa.ListType, numbered: bool = False) -> pa.Array:
    """A list of structs per cell, which has a sequence per field; ``numbered`` adds the place in the list as the first field."""
    sizes = np.array([0 if cell is None else len(cell[0]) for cell in cells], np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    fields = list(kind.value_type)
    columns = [pa.array(np.arange(offsets[-1], dtype=np.int32) - np.repeat(offsets[:-1], sizes))] if numbered else []
    for k in range(len(fields) - len(columns)):
        columns.append(pa.array([text for cell in cells if cell is not None for text in cell[k]], pa.string()))
    none = pa.array([cell is None for cell in cells], pa.bool_())
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.StructArray.from_arrays(columns, fields=fields), type=kind, mask=none
    )


class _Built:
    """Annotators of one partition: every factory is called once, even if it fails."""

    def __init__(self, factories: Mapping[str, AnnotatorFactory]):
        self.factories = factories
        self.done: dict[str, Annotator | Exception] = {}

    def __getitem__(self, analysis: str) -> Callable:
        if analysis not in self.done:
            try:
                factory = self.factories[analysis]
                self.done[analysis] = (factory.factory if isinstance(factory, Batched) else factory)()
            except Exception as error:  # noqa: BLE001 - remembered for every sentence
                self.done[analysis] = error.with_traceback(None)
        found = self.done[analysis]
        if isinstance(found, Exception):
            raise found
        return found


def _failed(error: Exception) -> tuple:
    """The row of a failed sentence.

    An exception may be remembered and raised again for the next sentence, by a factory that failed or by an annotator. Each time
    Python adds frames to its traceback, and these hold batches, so the traceback is dropped.
    """
    error.__traceback__ = None
    return (0, None, None, None, f"{type(error).__name__}: {error}")


def _one(annotator: Annotator, analysis: str, sentence: str) -> list[tuple]:
    """Rows of a sentence: part, cells, error."""
    try:
        return [(part, *_cells(analysis, found), None) for part, found in enumerate(annotator(sentence))]
    except Exception as error:  # noqa: BLE001 - any failure skips this sentence only
        return [_failed(error)]


def _many(annotator: Callable, analysis: str, texts: list[str]) -> list[list[tuple]]:
    """Rows of each sentence. A batch that fails is halved until the sentence at fault is alone."""
    try:
        results = list(annotator(texts))
        if len(results) != len(texts):
            raise ValueError(f"{len(results)} results for {len(texts)} sentences")
    except Exception as error:  # noqa: BLE001 - any failure skips the sentences at fault only
        if len(texts) == 1:
            return [[_failed(error)]]
        half = len(texts) // 2
        return _many(annotator, analysis, texts[:half]) + _many(annotator, analysis, texts[half:])
    return [_one(lambda _, found=found: found, analysis, text) for text, found in zip(texts, results)]


def _all(built: _Built, annotators: Mapping[str, AnnotatorFactory], analyses: list[str], texts: list[str]) -> list[list[tuple]]:
    """Rows of each sentence, in order; those of one analysis are annotated together if it takes batches."""
    out: list[list[tuple]] = [[] for _ in texts]
    together: dict[str, list[int]] = {}
    for i, analysis in enumerate(analyses):
        if isinstance(annotators.get(analysis), Batched) and texts[i] is not None:
            together.setdefault(analysis, []).append(i)
        else:
            out[i] = _one(lambda text, analysis=analysis: built[analysis](text), analysis, texts[i])
    for analysis, places in together.items():
        places.sort(key=lambda i: len(texts[i]))
        size = annotators[analysis].size
        for k in range(0, len(places), size):
            some = places[k : k + size]
            try:
                annotator = built[analysis]
            except Exception as error:  # noqa: BLE001 - a failing factory fails its sentences
                found = [[_failed(error)]] * len(some)
            else:
                found = _many(annotator, analysis, [texts[i] for i in some])
            for i, rows in zip(some, found):
                out[i] = rows
    return out


def rebalance(df: DataFrame, partitions: int) -> DataFrame:
    """``df`` dealt evenly to ``partitions``, which Spark splits at its advisory size: a task's share does not grow with the input."""
    return df.hint("rebalance", partitions)


def annotate(
    sentences: DataFrame,
    annotators: Mapping[str, AnnotatorFactory],
    partitions: int | None = None,
) -> DataFrame:
    """Add ``part_no, tokens, edges, tree, error`` to rows with ``analysis, sentence``.

    ``annotators`` maps an analysis to a factory that builds the annotator, once per
    partition; a ``Batched`` one takes many sentences at once. A sentence whose annotator fails, or gives anything but the strings asked
    for, gives one row with ``error`` and the partition goes on; an unknown analysis and
    a failing factory are such failures. ``partitions`` spreads the
    sentences evenly before the expensive part (``rebalance``). Rows travel as Arrow batches.
    """
    if partitions:
        sentences = rebalance(sentences, partitions)
    schema = T.StructType(
        sentences.schema.fields
        + T.StructType.fromDDL(
            f"part_no int, tokens {TOKENS}, edges {EDGES}, tree string, error string"
        ).fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = _Built(annotators)
        for batch in batches:
            columns = batch.column("analysis").to_pylist(), batch.column("sentence").to_pylist()
            found = _all(built, annotators, *columns)
            source = [i for i, new in enumerate(found) for _ in new]
            rows = [row for new in found for row in new]
            kept = batch.take(pa.array(source, pa.int64()))
            part, tokens, edges, tree, error = zip(*rows) if rows else ((),) * 5
            added = [
                pa.array(part, pa.int32()),
                _list_array(tokens, _TOKENS),
                _list_array(edges, _EDGES, numbered=True),
                pa.array(tree, pa.string()),
                pa.array(error, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *added], names=[field.name for field in schema.fields]
            )

    return sentences.mapInArrow(run, schema)


def annotate_documents(documents: DataFrame, annotators: Mapping[str, AnnotatorFactory]) -> DataFrame:
    """Put ``annotated`` in the place of ``sentences`` (an array of ``sent_no, sentence``) in rows with ``analysis``.

    It holds what ``annotate`` gives for these sentences, in order, as an array of ``sent_no, part_no, tokens, edges, tree, error``, so the lines
    of a document need not be brought together again. A document is annotated whole, which is meant for short ones; of
    short ones, some ``SENTENCES`` sentences at a time.
    """
    rest = [field for field in documents.schema.fields if field.name != "sentences"]
    entry = f"struct<sent_no:int,part_no:int,tokens:{TOKENS},edges:{EDGES},tree:string,error:string>"
    schema = T.StructType(rest + T.StructType.fromDDL(f"annotated array<{entry}>").fields)
    names = ["sent_no", "part_no", "tokens", "edges", "tree", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = _Built(annotators)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("sentences")), 0).to_numpy()
            groups = np.cumsum(sizes) // SENTENCES
            starts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(sizes)]
            for start, end in zip(starts, starts[1:]):
                part, own = batch.slice(start, end - start), sizes[start:end]
                flat = part.column("sentences").flatten()
                analyses = np.repeat(np.array(part.column("analysis").to_pylist(), object), own).tolist()
                found = _all(built, annotators, analyses, flat.field("sentence").to_pylist())
                counts = np.array([len(new) for new in found], np.int64)
                rows = [row for new in found for row in new]
                part_no, tokens, edges, tree, error = zip(*rows) if rows else ((),) * 5
                entries = pa.StructArray.from_arrays(
                    [
                        flat.field("sent_no").take(pa.array(np.repeat(np.arange(len(found)), counts))),
                        pa.array(part_no, pa.int32()),
                        _list_array(tokens, _TOKENS),
                        _list_array(edges, _EDGES, numbered=True),
                        pa.array(tree, pa.string()),
                        pa.array(error, pa.string()),
                    ],
                    names=names,
                )
                ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(own)])]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
                kept = [part.column(field.name) for field in rest]
                yield pa.RecordBatch.from_arrays([*kept, lists], names=[field.name for field in schema.fields])

    return documents.mapInArrow(run, schema)
