"""A table that grows by one entry per micro-batch, kept in few files.

Entry ``n`` is block ``n`` of level 0. ``FAN`` finished blocks of a level are merged into one block of the next, so what was
written before any batch lies in at most ``FAN - 1`` blocks of each level: 20 blocks after 500 batches, 30 after 4,000.
Which blocks those are follows from the number of the batch alone. A batch that is repeated after a failure
finds the same blocks, as only what earlier batches have finished is ever merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexiloom.session import folder_names, is_complete, remove_folder

FAN = 8

Merge = Callable[[DataFrame], DataFrame]


def block_path(root: str, level: int, block: int) -> str:
    return f"{root}/level={level}/block={block}"


def cover(number: int, fan: int = FAN) -> list[tuple[int, int]]:
    """Level and block of what holds the entries before ``number``, oldest first."""
    blocks, level, end = [], 0, number
    while end:
        blocks += [(level, block) for block in range(end - 1, end - end % fan - 1, -1)]
        level, end = level + 1, end // fan
    return blocks[::-1]


def append(entry: DataFrame, root: str, number: int, partition_by: list[str] | None = None) -> None:
    """Write the entry of batch ``number``, in place of what a failed try of it has left."""
    entry.write.mode("overwrite").partitionBy(*partition_by or []).parquet(block_path(root, 0, number))


def compact(
    spark: SparkSession,
    root: str,
    number: int,
    schema: str,
    merge: Merge,
    partition_by: list[str] | None = None,
    fan: int = FAN,
) -> None:
    """Before batch ``number``: merge the blocks that are full now. Their parts go when they are read no more."""
    full, level, end = [], 1, number
    while end and end % fan == 0:
        end //= fan
        full.append((level, end - 1))
        level += 1
    # A repeated batch may find a level done and the ones below it gone.
    done = max((level for level, block in full if is_complete(spark, block_path(root, level, block))), default=0)
    for level, block in full:
        parts = [(level - 1, part) for part in range(block * fan, (block + 1) * fan)]
        if level > done:
            rows = merge(read_blocks(spark, root, parts, schema))
            rows.write.mode("overwrite").partitionBy(*partition_by or []).parquet(block_path(root, level, block))
        for part in parts:
            remove_folder(spark, block_path(root, *part))


def read_blocks(spark: SparkSession, root: str, blocks: list[tuple[int, int]], schema: str) -> DataFrame:
    """Rows of the given blocks, with ``level`` and ``block``."""
    if not blocks:
        return spark.createDataFrame([], f"{schema}, level int, block long")
    paths = [block_path(root, *block) for block in blocks]
    return spark.read.schema(f"{schema}, level int, block long").option("basePath", root).parquet(*paths)


def read_before(spark: SparkSession, root: str, number: int, schema: str, fan: int = FAN) -> DataFrame:
    """What batches before ``number`` have written, as of the start of batch ``number``."""
    return read_blocks(spark, root, cover(number, fan), schema).drop("level", "block")


def finished_blocks(spark: SparkSession, root: str, fan: int = FAN) -> list[tuple[int, int]]:
    """The fewest complete blocks that hold all entries, for readers beside the stream."""
    found = {}
    for name in folder_names(spark, root):
        level = int(name.removeprefix("level="))
        blocks = (int(x.removeprefix("block=")) for x in folder_names(spark, f"{root}/{name}"))
        found[level] = {b for b in blocks if is_complete(spark, block_path(root, level, b))}
    chosen, done = [], 0
    for level in sorted(found, reverse=True):
        size = fan**level
        for block in sorted(found[level]):
            if block * size >= done:
                chosen.append((level, block))
                done = (block + 1) * size
    return chosen
