import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions import (
    HEBREW,
    StopWords,
    clean_token,
    decade,
    finite,
    is_stopword,
    llr,
    parse_int,
    register_functions,
    safe_long,
    strip_control,
)
from lexiloom.functions.stopwords import read_stopwords, remove_stopwords


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("out")).head().out


def plain_llr(c12, c1, c2, n):
    cells = [[c12, max(0, c1 - c12)], [max(0, c2 - c12), max(0, n - c1 - c2 + c12)]]
    across = [sum(r) for r in cells]
    down = [sum(c) for c in zip(*cells)]
    if 0 in across + down:
        return 0.0
    total = 0.0
    for i in (0, 1):
        for j in (0, 1):
            if cells[i][j]:
                total += cells[i][j] * math.log(cells[i][j] / (across[i] * down[j] / n))
    return 2 * total


@pytest.mark.parametrize(
    "year,text", [(1994, "1990s"), (1990, "1990s"), (5, "0s"), (-5, "0s"), (-15, "-10s")]
)
def test_decade_rounds_towards_zero(spark, year, text):
    assert one(spark, decade(F.col("y")), y=year) == text


@pytest.mark.parametrize(
    "raw,token",
    [("Rob-in", "Robin"), ('"Hood"', "Hood"), ("בית״", "בית״"), ("a1-١٢", "a1١٢"), ("—", "")],
)
def test_clean_token(spark, raw, token):
    assert one(spark, clean_token(F.col("w")), w=raw) == token


@pytest.mark.parametrize(
    "text,value",
    [("12", 12), ("+5", 5), ("-5", -5), (" 12", None), ("1.5", None), ("", None),
     ("3000000000", None), ("12\n", None), ("x", None)],
)
def test_parse_int(spark, text, value):
    assert one(spark, parse_int(F.col("t")), t=text) == value


def test_safe_long(spark):
    assert one(spark, safe_long(F.col("t")), t="3000000000") == 3_000_000_000
    assert one(spark, safe_long(F.col("t")), t="many") == -1


def test_strip_control_keeps_wide_blanks(spark):
    assert one(spark, strip_control(F.col("t")), t="\x00\t a b \r\n") == "a b"


@pytest.mark.parametrize(
    "word,hit",
    [("the", True), ("THE", True), (" The\t", True), ("של", True), (".", True), ("", False),
     ("  ", False), ("robin", False)],
)
def test_both_stop_lists_always_apply(spark, stop, word, hit):
    assert one(spark, is_stopword(F.col("w"), stop), w=word) is hit


def test_null_is_no_stopword(spark, stop):
    assert one(spark, is_stopword(F.lit(None).cast("string"), stop)) is False


def test_default_stop_lists(spark):
    default = StopWords.default()
    assert "the" in default.folded and default.exact == HEBREW
    assert len(HEBREW) == len(set(HEBREW)) == 150


def test_stop_table_agrees_with_literals(spark, stop, rows):
    words = spark.createDataFrame([("the",), ("Of",), ("hood",), ("של",), ("x",)], "w string")
    listed = [(w, True) for w in stop.folded] + [(w, False) for w in stop.exact]
    table = spark.createDataFrame(listed, "word string, folded boolean")
    assert rows(remove_stopwords(words, "w", table)) == rows(
        words.filter(~is_stopword(F.col("w"), stop))
    )


def test_read_stopwords(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\n\n of \nשל\n", encoding="utf-8")
    assert read_stopwords(spark, str(tmp_path / "stop.txt")) == ["the", "of", "של"]


@pytest.mark.parametrize(
    "counts,score",
    [((20, 5000, 2000, 10000), 3033.7057832024366), ((30, 20, 25, 1000), 240.1673403249937),
     ((10, 10, 10, 10), 0.0)],
)
def test_llr_known_values(spark, counts, score):
    names = dict(zip(("a", "b", "c", "d"), counts))
    assert one(spark, llr(*map(F.col, names)), **names) == pytest.approx(score, rel=1e-12)


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.tuples(*(st.integers(1, 5000) for _ in range(3)), st.integers(1, 10**6)),
        min_size=1,
        max_size=50,
    )
)
def test_llr_against_plain_python(spark, table):
    df = spark.createDataFrame(table, "a long, b long, c long, n long")
    scored = df.select(
        "*",
        llr(F.col("a"), F.col("b"), F.col("c"), F.col("n")).alias("s"),
        llr(F.col("a"), F.col("c"), F.col("b"), F.col("n")).alias("t"),
    )
    for row in scored.collect():
        expected = plain_llr(row.a, row.b, row.c, row.n)
        assert row.s == pytest.approx(expected, rel=1e-9, abs=1e-6)
        assert row.s == pytest.approx(row.t, rel=1e-9, abs=1e-6)


def test_finite(spark):
    values = [(1.0,), (float("nan"),), (float("inf"),), (-float("inf"),), (None,)]
    df = spark.createDataFrame(values, "x double")
    assert [r.x for r in df.filter(finite(F.col("x"))).collect()] == [1.0]


def test_sql_functions(spark, stop):
    register_functions(spark, stop)
    row = spark.sql(
        "SELECT llr(20, 5000, 2000, 10000) AS s, decade(-5) AS d, clean_token('Rob-in') AS w, "
        "is_stopword(' THE') AS a, is_stopword('robin') AS b, is_stopword('\"') AS c, "
        "is_stopword(NULL) AS n, llr(10, 10, 10, 10) AS z"
    ).head()
    assert row.s == pytest.approx(3033.7057832024366, rel=1e-12)
    assert (row.d, row.w, row.a, row.b, row.c, row.n, row.z) == (
        "0s", "Robin", True, False, True, False, 0.0,
    )


@pytest.mark.parametrize(
    "text, stripped",
    [("", ""), ("\x1f", ""), ("!", "!"), (" !", "!"), ("a\x00", "a"), ("\x7fa\u00a0", "\x7fa\u00a0"), ("é ", "é"), ("\n\U0001f600", "\U0001f600"), (None, None)],
)
def test_strip_control_looks_at_both_ends(spark, text, stripped):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(strip_control(F.col("t"))).first()[0] == stripped


def test_strip_control_strips_only_where_there_is_something(spark):
    """Stripping is the costly branch: a plain word does not take it."""
    shown = spark.range(1).selectExpr("string(id) AS t").select(strip_control(F.col("t"))).columns[0]
    assert shown.startswith("CASE WHEN") and shown.count("trim(") == 1
