"""N-gram records from running text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document_words(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Running text as word arrays: ``keep`` columns and ``words``."""
    words = F.filter(F.split(text, "[ \t\n\r]+"), lambda w: w != "")
    return docs.select(*keep, words.alias("words"))


def document_unigrams(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep, ngram, count``: one record for every word of every document."""
    words = document_words(docs, keep, text)
    return words.select(*keep, F.explode("words").alias("ngram"), F.lit(1).alias("count"))


def word_pairs(words: str) -> Column:
    """An array of ``(w1, w2)`` for every two words that follow each other."""
    size = F.greatest(F.size(words) - 1, F.lit(0))
    return F.arrays_zip(F.slice(words, 1, size).alias("w1"), F.slice(words, 2, size).alias("w2"))


def document_bigrams(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep, w1, w2, count``: one record for every two words that follow each other."""
    words = document_words(docs, keep, text)
    return words.select(*keep, F.inline(word_pairs("words")), F.lit(1).alias("count"))
