"""Sentences of documents, and the text lines of annotated sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import strip_control

# How sentences end, and how long one may be.
SENTENCE_END = r"[.!?]+[ \t\n\x0b\f\r]*"
MIN_LENGTH, MAX_LENGTH = 5, 400


def sentences(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence: ``sent_no`` (place in the text) and ``sentence`` for ``text``.

    Pieces shorter than 5 or longer than 400 characters are left out. The filter runs
    above ``posexplode``, which Spark does not push below the generator, so a piece is
    trimmed once.
    """
    pieces = F.transform(F.split(text, SENTENCE_END), strip_control)
    keys = [F.col(name) for name in docs.columns if name != text]
    rows = docs.select(*keys, F.posexplode(pieces).alias("sent_no", "sentence"))
    return rows.filter(F.length("sentence").between(MIN_LENGTH, MAX_LENGTH))


def sentence_list(text: str = "text") -> Column:
    """The sentences of a text, as ``sentences`` gives them, in an array of ``sent_no, sentence``."""
    pieces = F.transform(
        F.split(text, SENTENCE_END), lambda piece, i: F.struct(i.alias("sent_no"), strip_control(piece).alias("sentence"))
    )
    return F.filter(pieces, lambda p: F.length(p["sentence"]).between(MIN_LENGTH, MAX_LENGTH))


def pos_line(tokens: Column) -> Column:
    """``word/TAG `` for every token, a blank after the last one too."""
    return F.array_join(
        F.transform(tokens, lambda t: F.concat(t["word"], F.lit("/"), t["tag"], F.lit(" "))), ""
    )


def dependency_line(edges: Column) -> Column:
    """``rel(gov, dep)`` on a line of its own for every edge, in edge order."""

    def line(edge: Column) -> Column:
        rel, gov, dep = (F.coalesce(edge[name], F.lit("null")) for name in ("rel", "gov", "dep"))
        return F.concat(rel, F.lit("("), gov, F.lit(", "), dep, F.lit(")\n"))

    return F.array_join(F.transform(F.array_sort(edges), line), "")


def pos_lines(annotated: DataFrame) -> DataFrame:
    return annotated.withColumn("line", pos_line(F.col("tokens")))


def dependency_lines(annotated: DataFrame) -> DataFrame:
    return annotated.withColumn("line", dependency_line(F.col("edges")))


def constituency_lines(annotated: DataFrame) -> DataFrame:
    return annotated.withColumn("line", F.col("tree"))


def annotation_lines(annotated: DataFrame) -> DataFrame:
    """The line of whichever annotation a row has; skipped sentences have none."""
    return annotated.withColumn("line", _any_line(F.col("tokens"), F.col("edges"), F.col("tree")))


def _any_line(tokens: Column, edges: Column, tree: Column) -> Column:
    return (
        F.when(tokens.isNotNull(), pos_line(tokens))
        .when(edges.isNotNull(), dependency_line(edges))
        .when(tree.isNotNull(), tree)
    )


def document_output(annotated: Column) -> Column:
    """The lines of a document whose annotations are one array, joined in order."""
    lines = F.transform(annotated, lambda a: _any_line(a["tokens"], a["edges"], a["tree"]))
    return F.array_join(F.transform(F.filter(lines, lambda x: x.isNotNull()), lambda x: F.concat(x, F.lit("\n"))), "")


def document_lines(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, output, n_lines, n_skipped``: the lines of a document, joined in order.

    A group holds the lines of one document, which came from the text of one row.
    """
    entry = F.when(F.col("line").isNotNull(), F.struct("sent_no", "part_no", "line"))
    grouped = lines.groupBy(*keys).agg(
        F.array_sort(F.collect_list(entry)).alias("parts"),
        F.count("error").alias("n_skipped"),
    )
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["line"], F.lit("\n"))), "")
    return grouped.select(
        *keys, text.alias("output"), F.size("parts").alias("n_lines"), "n_skipped"
    )
