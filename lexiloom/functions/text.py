"""Text expressions. Everything here is a plain Column, so it stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a cleaned token may keep, and what counts as white space or control.
NON_WORD = r"[^\p{InHebrew}a-zA-Z\p{Nd}]+"
DIGITS_OR_EMPTY = r"^[0-9]*\z"
INTEGER = r"^[+-]?[0-9]+\z"
WHITESPACE = " \t\n\x0b\f\r"
CONTROL = "".join(map(chr, range(0x21)))


def clean_token(word: Column) -> Column:
    """Keep Latin letters, the Hebrew block and decimal digits of any script."""
    return F.regexp_replace(word, NON_WORD, "")


def strip_control(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends (``trim`` strips blanks only).

    Few texts have one there, and looking costs less than stripping: what begins with one, or is empty, is less than ``!``.
    """
    outer = (text < "!") | (F.substring(text, -1, 1) < "!")
    return F.when(outer, F.btrim(text, F.lit(CONTROL))).otherwise(text)


def split_words(text: Column) -> Column:
    """Split on white-space runs; trailing white space makes no empty word, leading does."""
    return F.split(F.rtrim(text, F.lit(WHITESPACE)), r"[ \t\n\x0b\f\r]+")


def split_fields(line: Column) -> Column:
    """Tab-separated fields without the empty ones at the end."""
    return F.split(F.rtrim(line, F.lit("\t")), "\t")


def parse_int(text: Column, dtype: str = "int") -> Column:
    """A whole number with an optional sign and nothing around it, else null."""
    return F.when(text.rlike(INTEGER), text.try_cast(dtype))


def is_word(token: Column) -> Column:
    """Neither empty nor only ASCII digits; digits of other scripts do not make a number."""
    return ~token.rlike(DIGITS_OR_EMPTY)


def decade(year: Column) -> Column:
    """``1994`` -> ``1990s``; rounds towards zero, so ``-5`` -> ``0s``."""
    return F.concat((year - year % 10).cast("string"), F.lit("s"))
