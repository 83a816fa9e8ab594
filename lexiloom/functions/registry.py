"""The scalar functions as temporary SQL functions: inlined expressions, no Python at run time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.stats import llr
from lexiloom.functions.stopwords import StopWords, is_stopword
from lexiloom.functions.text import clean_token, decade


def define(spark: SparkSession, name: str, column: Callable[..., Column], returns: str, **parameters: str) -> None:
    """Make a SQL function of a column expression over parameters of the given types."""
    columns = (F.lit(None).cast(kind).alias(x) for x, kind in parameters.items())
    plan = spark.range(0).select(*columns).select(column(*map(F.col, parameters)))._jdf.queryExecution().analyzed()
    body = plan.expressions().head().child().sql()
    signature = ", ".join(f"{x} {kind}" for x, kind in parameters.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS {returns} RETURN {body}")


def register_functions(spark: SparkSession, stop: StopWords | None = None) -> None:
    """Register ``llr``, ``decade``, ``clean_token`` and ``is_stopword`` for SQL users: the column functions, as SQL."""
    stop = stop or StopWords.default()
    define(spark, "decade", decade, "STRING", y="int")
    define(spark, "clean_token", clean_token, "STRING", w="string")
    define(spark, "llr", llr, "DOUBLE", c12="double", c1="double", c2="double", n="double")
    define(spark, "is_stopword", lambda w: is_stopword(w, stop), "BOOLEAN", w="string")
