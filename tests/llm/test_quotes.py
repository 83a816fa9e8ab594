"""Quoted passages, their originals, and threads."""

import pytest

from lexiloom.llm import quotes as Q

FIRST = "Shall we meet on Monday?\n\nI can bring the slides."
SECOND = "On Friday A wrote:\n> Shall we meet\n> on Monday?\nYes, at noon."
SECOND_REAL = "A wrote:\n> Shall we meet on Monday?\nYes, at noon."
THIRD = "> > Shall we meet on   MONDAY?\n> Yes, at noon.\n\nFine.\n>not said by anyone"
MESSAGES = [
    (1, 0, "user", FIRST),
    (1, 1, "assistant", SECOND_REAL),
    (1, 2, "user", THIRD),
    (1, 3, "user", "I can bring the slides."),
    (1, 4, "user", "> I can bring the slides.\nThanks"),
    (2, 0, "user", "> Fine.\nquoting another conversation"),
    (2, 1, "user", None),
    (2, 2, "user", ""),
    (None, 0, "user", "> Fine."),
    (3, None, "user", "no turn"),
]


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(*m, 0, "z") for m in MESSAGES]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, block int, parent string")


def test_reply_order(messages):
    got = {(r.conv_id, r.turn): (r.parent, r.root, r.depth, r.quotes, r.text) for r in Q.reply_order(messages).collect()}
    assert len(got) == len(MESSAGES)
    assert got[1, 0] == (None, 0, 0, 0, FIRST)
    assert got[1, 1] == (0, 0, 1, 1, "Yes, at noon.")
    assert got[1, 2] == (1, 0, 2, 2, "Fine.")
    assert got[1, 3] == (None, 3, 0, 0, "I can bring the slides.")
    assert got[1, 4] == (0, 0, 1, 1, "Thanks")
    assert got[2, 0] == (None, 0, 0, 0, "quoting another conversation")
    assert got[2, 1] == (None, 1, 0, 0, "") and got[2, 2] == (None, 2, 0, 0, "")
    assert got[None, 0] == (None, None, 0, 0, "")


def test_levels_and_passages(spark):
    frame = spark.createDataFrame([(1, 1, "u", "a\n>> b\n> > b2\n> c\n>\n> d\ne")], "conv_id long, turn int, role string, text string")
    got = [(r.level, r.passage) for r in Q.passages(Q.parse(frame)).orderBy("block").collect()]
    assert got == [(0, "a"), (2, "b\nb2"), (1, "c"), (1, "d"), (0, "e")]


def test_wrapped_quotes_match(spark):
    frame = spark.createDataFrame([(1, 0, "u", "Shall we meet\non Monday?"), (1, 1, "u", SECOND)], "conv_id long, turn int, role string, text string")
    got = {r.turn: (r.parent, r.text) for r in Q.reply_order(frame).collect()}
    assert got == {0: (None, "Shall we meet\non Monday?"), 1: (0, "Yes, at noon.")}


def test_long_chain_and_hot_passage(spark):
    rows = [(1, 0, "u", "m0")] + [(1, k, "u", f"> m{k - 1}\nm{k}") for k in range(1, 40)]
    rows += [(2, 0, "u", "same")] + [(2, k, "u", "> same\nsame") for k in range(1, 60)]
    got = Q.reply_order(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert {(r.turn, r.depth) for r in got if r.conv_id == 1} == {(k, k) for k in range(40)}
    assert all(r.parent == 0 and r.depth == 1 for r in got if r.conv_id == 2 and r.turn)


def test_native_and_empty(spark, messages):
    assert Q.reply_order(messages.limit(0)).count() == 0
    plan = Q.passages(Q.parse(messages))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    repeated = messages.unionByName(messages)
    assert Q.reply_order(repeated).count() == 2 * len(MESSAGES)


def test_against_sql(spark):
    import duckdb
    import pandas as pd
    from lexiloom.llm.queries import QUOTES_SQL

    texts = [FIRST, SECOND_REAL, THIRD, "> Fine.\n>\n> Yes, at noon.\nok\n\nok", "ok\nB wrote :\n>ok\n \n>> ok", ">\n> >  \nx", "Yes, at noon.", "> x\n\n> Fine.\n> x"]
    rows = [(c, t, "u", texts[(5 * c + t * (c + 1)) % len(texts)]) for c in range(9) for t in range(12)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=frame.columns))
    result = con.sql(QUOTES_SQL)
    out = Q.reply_order(frame).select(*result.columns)
    assert sorted(map(repr, result.fetchall())) == sorted(repr(tuple(r)) for r in out.collect())


def test_the_whole_table_with_quotes_against_sql(spark):
    """Every message of the given table quotes the two before it, the nearer one more deeply."""
    import duckdb
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from lexiloom.llm.queries import QUOTES_SQL

    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    order = Window.partitionBy("conv_id").orderBy("turn")
    quote = lambda k, mark: F.concat(F.lit(mark), F.regexp_replace(F.lag("text", k).over(order), "\n", "\n" + mark), F.lit("\n\n"))
    text = F.concat(F.coalesce(quote(2, ">> "), F.lit("")), F.coalesce(quote(1, "> "), F.lit("")), F.col("text"))
    quoted = table.withColumn("text", text)
    con = duckdb.connect()
    con.register("conversations", quoted.toPandas())
    result = con.sql(QUOTES_SQL)
    out = Q.reply_order(quoted).select(*result.columns).collect()
    assert sorted(map(repr, result.fetchall())) == sorted(repr(tuple(r)) for r in out)
    assert sum(r.quotes for r in out) > len(out) / 2 and max(r.depth for r in out) > 2 and sum(r.parent is not None for r in out) > len(out) / 2
