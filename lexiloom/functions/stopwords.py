"""Stop lists. Lists are parameters; only the short Hebrew one is stated here."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.text import strip_control

# The Hebrew stop list (150 entries, compared exactly).
HEBREW = tuple(
    """
    ״ ׳ של רב פי עם עליו עליהם על עד מן מכל מי מהם מה מ למה לכל לי לו
    להיות לה לא כן כמה כלי כל כי יש ימים יותר יד י זה ז ועל ומי ולא וכן
    וכל והיא והוא ואם ו הרבה הנה היו היה היא הזה הוא דבר ד ג בני בכל בו
    בה בא את אשר אם אלה אל אך איש אין אחת אחר אחד אז אותו ־ ^ ? ;
    : 1 . - * " ! שלשה בעל פני ) גדול שם עלי עולם מקום לעולם לנו להם
    ישראל יודע זאת השמים הזאת הדברים הדבר הבית האמת דברי במקום בהם אמרו אינם
    אחרי אותם אדם ( חלק שני שכל שאר ש ר פעמים נעשה ן ממנו מלא מזה ם לפי
    ל כמו כבר כ זו ומה ולכל ובין ואין הן היתה הא ה בל בין בזה ב אף אי
    אותה או אבל א
    """.split()
)

@dataclass(frozen=True)
class StopWords:
    """``folded`` words match in any case (give them lower-cased), ``exact`` ones as they are."""

    folded: tuple[str, ...] = ()
    exact: tuple[str, ...] = HEBREW

    @classmethod
    def of(cls, folded: Iterable[str] = (), exact: Iterable[str] = HEBREW) -> StopWords:
        return cls(tuple(w.lower() for w in folded), tuple(exact))

    @classmethod
    def default(cls) -> StopWords:
        """Spark ML's own English list and the Hebrew list. Needs a running session."""
        from pyspark.ml.feature import StopWordsRemover

        return cls.of(StopWordsRemover.loadDefaultStopWords("english"))


def read_stopwords(spark: SparkSession, path: str) -> list[str]:
    """A stop list file, one word per line, as literals. For long lists see ``stop_table``."""
    rows = spark.read.text(path).filter("value <> ''").collect()
    return [strip for row in rows if (strip := row.value.strip())]


def stop_table(spark: SparkSession, path: str, folded: bool = True) -> DataFrame:
    """A stop list file of any length as ``word, folded``, for ``remove_stopwords``.

    The jobs take such a table, or the union of several, in place of ``StopWords``.
    """
    word = strip_control(F.col("value"))
    words = spark.read.text(path).select(word.alias("word")).filter("word <> ''").distinct()
    return words.withColumn("folded", F.lit(folded))


def in_stop_lists(word: Column, stop: StopWords) -> Column:
    """Both lists always apply, whatever the language. ``word`` has no blanks around it."""
    folded = [listed for listed in stop.folded if listed]
    exact = [listed for listed in stop.exact if listed]
    hit = F.lit(False)
    if folded:
        hit = hit | F.lower(word).isin(*folded)
    if exact:
        hit = hit | word.isin(*exact)
    return hit


def is_stopword(word: Column, stop: StopWords) -> Column:
    """Test of a raw word; null and blank words are no stop words."""
    return F.coalesce(in_stop_lists(strip_control(word), stop), F.lit(False))


def remove_stopwords(df: DataFrame, column: str, stop: DataFrame) -> DataFrame:
    """Anti join with a stop table ``(word, folded boolean)`` for lists too long for literals.

    No broadcast hint: Spark broadcasts the list if it is small and shuffles if it is not.
    """
    word = strip_control(F.col(column))
    folded = stop.filter("folded").select(F.lower("word").alias("_folded"))
    exact = stop.filter("not folded").select(F.col("word").alias("_exact"))
    return df.join(folded, F.lower(word) == F.col("_folded"), "left_anti").join(
        exact, word == F.col("_exact"), "left_anti"
    )
