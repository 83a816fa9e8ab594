"""Association scores as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.text import parse_int


def _term(observed: Column, expected: Column) -> Column:
    return F.when(observed == 0, F.lit(0.0)).otherwise(
        observed * F.ln(F.try_divide(observed, expected))
    )


def llr(c12: Column, c1: Column, c2: Column, n: Column) -> Column:
    """Log-likelihood ratio of the 2x2 table of a word pair.

    ``c12`` may exceed ``c1`` or ``c2``, because pairs are counted on cleaned words and
    single words are not: the cells are clamped at zero. Margins are sums of the clamped
    cells while the expected cells divide by the given ``n``. A zero margin scores 0.
    """
    c12, c1, c2, n = (c.cast("double") for c in (c12, c1, c2, n))
    zero = F.lit(0.0)
    only1 = F.greatest(zero, c1 - c12)
    only2 = F.greatest(zero, c2 - c12)
    neither = F.greatest(zero, n - c1 - c2 + c12)
    with1, without1 = c12 + only1, only2 + neither
    with2, without2 = c12 + only2, only1 + neither
    score = F.lit(2.0) * (
        _term(c12, F.try_divide(with1 * with2, n))
        + _term(only1, F.try_divide(with1 * without2, n))
        + _term(only2, F.try_divide(without1 * with2, n))
        + _term(neither, F.try_divide(without1 * without2, n))
    )
    empty = (with1 == 0) | (without1 == 0) | (with2 == 0) | (without2 == 0)
    return F.when(empty, zero).otherwise(score)


def mutual_information(n_psw: Column, n_ps: Column, n_sw: Column, n_s: Column) -> Column:
    """``ln(n(p,s,w) n(*,s,*) / (n(p,s,*) n(*,s,w)))``, with doubles against overflow."""
    n_psw, n_ps, n_sw, n_s = (c.cast("double") for c in (n_psw, n_ps, n_sw, n_s))
    return F.ln(F.try_divide(n_psw * n_s, n_ps * n_sw))


def finite(value: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def safe_long(text: Column) -> Column:
    """A 64-bit whole number, or -1 when the text is none."""
    return F.coalesce(parse_int(text, "bigint"), F.lit(-1).cast("bigint"))
