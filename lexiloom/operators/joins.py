"""Joins with a table that is expected to be small, on keys that may be few and hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000
SALTS = 64
#: Rows of a table that Spark may still broadcast by its size; it does up to some 10 MB.
SORTED_ROWS = 1_000_000
#: Rows of a shuffle partition that are hashed at once, some 120 MB of short words.
HASH_ROWS = 1 << 19


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Count ``df``, a written or otherwise cheap table, up to the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup(df: DataFrame, small: int = SORTED_ROWS, hash_rows: int = HASH_ROWS) -> DataFrame:
    """``df``, a written table with one row per key, as the hashed side of a join with far more rows, which then are not sorted.

    Keys that are all different fill the shuffle partitions evenly, so a count tells what a hash table must hold. A table of at most ``small``
    rows is left to Spark, which may broadcast it, and so is one with more than ``hash_rows`` a partition: sorting can spill, hashing can not.
    """
    conf = df.sparkSession.conf
    partitions = int(conf.get("spark.sql.shuffle.partitions"))
    if conf.get("spark.sql.adaptive.enabled") == "true":
        partitions = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or partitions)
    return df.hint("shuffle_hash") if small < df.count() <= hash_rows * partitions else df


def salted_join(
    df: DataFrame, small: DataFrame, keys: list[str], spread_by: list[str], salts: int = SALTS
) -> DataFrame:
    """Inner equi-join that spreads every key of ``df`` over ``salts`` partitions.

    ``small`` is repeated once per salt; ``spread_by`` are columns of ``df`` that differ
    between the rows of a key.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def join_small(
    df: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread_by: list[str],
    max_rows: int | None = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Inner join with ``small``, broadcast if a count shows that it is within the bound.

    Beyond the bound, or without one (``max_rows=None``: nothing is counted and the plan
    stays lazy), the join is salted. Either way a hot key spreads over the cluster.
    """
    if max_rows is not None and fits_broadcast(small, max_rows):
        return df.join(F.broadcast(small), keys)
    return salted_join(df, small, keys, spread_by)
