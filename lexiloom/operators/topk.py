"""Ranking inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Parts whose best rows meet in the last step of a ranking.
PARTS = 256
#: Ranks are 32-bit.
MAX_RANK = 2**31 - 1


def top_k(df: DataFrame, k: int, by: str, keys: list[str], ties: list[str | Column], parts: int = PARTS) -> DataFrame:
    """The ``k`` largest ``by`` of every group, with ``ties`` making a total order.

    A tree of three levels. The rank filter becomes a partial limit before each shuffle, so a task ships at most
    ``k`` rows of a group whatever the size of the group. Tasks are dealt into ``parts``, which rank what their tasks ship, and
    the last step gets at most ``k * parts`` rows of a group, however many tasks there are. (For a ``k`` beyond 1000 Spark
    leaves the limits out that come before a shuffle; the parts still bound the last step. Where ``k * parts`` is
    beyond the largest rank they bound nothing, and are left out with their shuffle. No rank is beyond ``MAX_RANK``, so
    such a ``k`` filters nothing, and who does not ask for the rank spares the whole ranking.)
    """
    best = [F.desc(by), *ties]
    some = df
    if k * parts <= MAX_RANK:
        dealt = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(parts)))
        place = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*best))
        some = dealt.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place", "_part")
    order = Window.partitionBy(*keys).orderBy(*best)
    ranked = some.withColumn("rank", F.row_number().over(order))
    return ranked if k >= MAX_RANK else ranked.filter(F.col("rank") <= k)
