"""N-gram records: parsing, cleaning, counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.stopwords import (
    StopWords,
    in_stop_lists,
    is_stopword,
    remove_stopwords,
)
from lexiloom.functions.text import (
    clean_token,
    decade,
    is_word,
    parse_int,
    split_fields,
    split_words,
    strip_control,
)
from lexiloom.operators.once import compute_once
from lexiloom.sources.documents import document_words, word_pairs


def parse_ngrams(lines: DataFrame, n: int) -> DataFrame:
    """Lines ``ngram TAB year TAB count[ TAB pages ...]`` -> ``ngram, year, count, pages``.

    Pairs (``n=2``) need four fields and exactly two words, given as ``w1, w2``; single
    words (``n=1``) are trimmed first and need three fields. Anything else is dropped,
    and so are years or counts that are no 32-bit whole numbers.
    """
    line = F.col("value") if n == 2 else strip_control(F.col("value"))
    fields = compute_once(lines.select("value"), f=split_fields(line)).drop("value")
    numbers = compute_once(
        fields.filter(F.size("f") >= (4 if n == 2 else 3)),
        year=parse_int(F.col("f")[1]),
        count=parse_int(F.col("f")[2]),
    ).filter(F.col("year").isNotNull() & F.col("count").isNotNull())
    columns = [
        F.col("f")[0].alias("ngram"),
        "year",
        F.col("count").cast("bigint").alias("count"),
        parse_int(F.get("f", F.lit(3)), "bigint").alias("pages"),
    ]
    if n == 1:
        return numbers.select(*columns)
    words = compute_once(numbers, w=split_words(F.col("f")[0])).filter(F.size("w") == 2)
    return words.select(*columns, F.col("w")[0].alias("w1"), F.col("w")[1].alias("w2"))


def _is_valid(token: Column, stop: StopWords) -> Column:
    return is_word(token) & ~in_stop_lists(token, stop)


def valid_bigrams(df: DataFrame, stop: StopWords | DataFrame) -> DataFrame:
    """Clean ``w1, w2`` and drop pairs with an empty, all-digit or stop word.

    Words are cleaned once, not once for every condition of the filter. ``stop`` may be a
    table ``word, folded`` of any size.
    """
    cleaned = compute_once(df, w1=clean_token(F.col("w1")), w2=clean_token(F.col("w2")))
    if isinstance(stop, DataFrame):
        words = cleaned.filter(is_word(F.col("w1")) & is_word(F.col("w2")))
        return remove_stopwords(remove_stopwords(words, "w1", stop), "w2", stop)
    return cleaned.filter(_is_valid(F.col("w1"), stop) & _is_valid(F.col("w2"), stop))


def valid_document_bigrams(
    docs: DataFrame, keep: list[str], stop: StopWords, text: str = "text"
) -> DataFrame:
    """The valid pairs of running text, same rows as ``valid_bigrams(document_bigrams(..))``.

    Words are cleaned and checked before they are paired, so once and not twice each.
    """
    tokens = F.transform("words", clean_token)
    valid = F.transform(tokens, lambda w: F.when(_is_valid(w, stop), w))
    words = document_words(docs, keep, text).select(*keep, valid.alias("words"))
    pairs = words.select(*keep, F.inline(word_pairs("words")), F.lit(1).alias("count"))
    return pairs.filter("w1 IS NOT NULL AND w2 IS NOT NULL")


def valid_unigrams(df: DataFrame, stop: StopWords | DataFrame) -> DataFrame:
    """Drop stop words only: single words are not cleaned and numbers stay."""
    if isinstance(stop, DataFrame):
        return remove_stopwords(df, "ngram", stop)
    return df.filter(~is_stopword(F.col("ngram"), stop))


def with_decade(df: DataFrame) -> DataFrame:
    return df.withColumn("decade", decade(F.col("year")))


def bigram_counts(df: DataFrame, period: str = "decade") -> DataFrame:
    """``period, w1, w2, c12`` from valid pairs."""
    return df.groupBy(period, "w1", "w2").agg(F.sum("count").alias("c12"))


def unigram_counts(df: DataFrame, period: str = "decade") -> DataFrame:
    """``period, word, c`` from valid single words."""
    return df.groupBy(period, F.col("ngram").alias("word")).agg(F.sum("count").alias("c"))


def period_totals(counts: DataFrame, period: str = "decade") -> DataFrame:
    """``period, n``: the corpus size, from the word counts rather than from the raw rows."""
    return counts.groupBy(period).agg(F.sum("c").alias("n"))


def unigram_counts_with_totals(df: DataFrame, period: str = "decade") -> DataFrame:
    """Word counts and period totals in one pass; total rows have a null word."""
    word = F.col("ngram").alias("word")
    return (
        df.select(period, word, "count")
        .groupingSets([[period, "word"], [period]], period, "word")
        .agg(F.sum("count").alias("c"), F.grouping("word").cast("int").alias("is_total"))
    )
