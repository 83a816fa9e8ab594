"""What the Spark side and the SQL side of a check share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.stopwords import HEBREW, StopWords
from lexiloom.session import spread

# The stop list of the checks: small, so that both sides can state it.
ENGLISH = (
    "a an and are as at be by for from has he in is it its of on or that the this to was "
    "were which will with"
).split()
STOP = StopWords.of(ENGLISH, HEBREW)

#: Lines of a compressed file.
FILE_LINES = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_year() -> Column:
    """The tables have no year for a text, so one is taken from the document number."""
    return (1900 + F.col("doc_id") % 100).cast("int")


def dated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", document_year().alias("year"), "lang", "text")


def filled(form: str, names: str) -> Column:
    """``form`` with the columns that it names in braces, joined without a formatter, which takes most of the time of a line."""
    parts = [part for part in re.split(rf"({{(?:{'|'.join(names.split())})}})", form) if part]
    return F.concat(*(F.col(part[1:-1]).cast("string") if part[0] == "{" else F.lit(part) for part in parts))


def write_lines(lines: DataFrame, path: str, *folders: str) -> None:
    """Built lines as compressed text: as plain text they are several times as long as the table they are built from.

    A compressed file is read by one task, so none has more than ``FILE_LINES``.
    """
    writer = lines.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES)
    (writer.partitionBy(*folders) if folders else writer).text(path)


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def sql_clean(word: str) -> str:
    return rf"regexp_replace({word}, '[^\x{{0590}}-\x{{05FF}}a-zA-Z\p{{Nd}}]+', '', 'g')"


def sql_is_stop(word: str) -> str:
    return f"(lower({word}) IN ({sql_list(ENGLISH)}) OR {word} IN ({sql_list(HEBREW)}))"


def sql_valid(word: str) -> str:
    return f"{word} <> '' AND NOT regexp_full_match({word}, '[0-9]+') AND NOT {sql_is_stop(word)}"


SQL_DECADE = "(year // 10 * 10) || 's'"


def sql_words(table_name: str = "documents", keys: str = "doc_id, lang") -> str:
    """CTE ``docs``: the keys, a year and the word list."""
    year = "1900 + doc_id % 100" if "doc_id" in keys else "0"
    return rf"""docs AS (
      SELECT {keys}, {year} AS year,
             list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda w: w <> '') AS t
      FROM {table_name})"""


SQL_RAW = """raw_uni AS (SELECT doc_id, lang, year, unnest(t) AS word FROM docs),
    raw_bi AS (SELECT doc_id, lang, year, unnest(t[1:len(t) - 1]) AS r1, unnest(t[2:]) AS r2
               FROM docs WHERE len(t) > 1)"""

SQL_BI = f"""bi AS (SELECT * FROM (
      SELECT doc_id, lang, year, {SQL_DECADE} AS decade, {sql_clean('r1')} AS w1, {sql_clean('r2')} AS w2
      FROM raw_bi) WHERE {sql_valid('w1')} AND {sql_valid('w2')})"""

SQL_UNI = f"""uni AS (SELECT doc_id, lang, year, {SQL_DECADE} AS decade, word
      FROM raw_uni WHERE NOT {sql_is_stop('word')})"""


def sql_llr(c12: str = "c12", c1: str = "c1", c2: str = "c2", n: str = "n") -> str:
    a, b = f"{c12}::DOUBLE", f"greatest(0e0, {c1}::DOUBLE - {c12})"
    c, d = f"greatest(0e0, {c2}::DOUBLE - {c12})", f"greatest(0e0, {n}::DOUBLE - {c1} - {c2} + {c12})"

    def term(o: str, r: str, k: str) -> str:
        return f"CASE WHEN {o} = 0 THEN 0e0 ELSE {o} * ln({o} / (({r}) * ({k}) / {n}::DOUBLE)) END"

    r1, r2, k1, k2 = f"{a} + {b}", f"{c} + {d}", f"{a} + {c}", f"{b} + {d}"
    return f"""CASE WHEN {r1} = 0 OR {r2} = 0 OR {k1} = 0 OR {k2} = 0 THEN 0e0 ELSE
      2e0 * ({term(a, r1, k1)} + {term(b, r1, k2)} + {term(c, r2, k1)} + {term(d, r2, k2)}) END"""
