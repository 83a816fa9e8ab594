"""Task manifests: text files whose lines ask for one analysis of one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.session import materialize


def placed_lines(lines: DataFrame, app_id: Column | None = None) -> DataFrame:
    """``app_id, file, block, arrived, value`` of lines that are read from text files, in batch or as a stream.

    ``block`` is where the split begins that a line was read in.
    """
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_modification_time").alias("arrived"),
    )
    app = F.col("file") if app_id is None else app_id
    return placed.select(app.alias("app_id"), "file", "block", "arrived", "value")


def number_lines(
    placed: DataFrame, unit: str = "app_id", work_dir: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``placed`` lines with ``line_no``, counted from 0 inside every ``unit`` (the app, or the file), and their splits.

    An app of several files counts through them in name order. Large files are
    read in many splits: the lines are written once with their split and their place in
    it, the splits are counted, and a line's number is the lines of all earlier splits
    plus its place. Only the split counts are ordered, never the lines.
    """
    stored = materialize(placed.withColumn("seq", F.monotonically_increasing_id()), "lines", work_dir)
    earlier = (
        Window.partitionBy(unit)
        .orderBy("file", "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = stored.groupBy("app_id", "file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    splits = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    splits = materialize(splits, "splits", work_dir)
    line_no = (F.col("before") + F.col("seq") - F.col("first")).cast("long")
    rows = stored.join(splits.drop("app_id", "n"), ["file", "block"]).withColumn("line_no", line_no)
    return rows.drop("block", "seq", "first", "before"), splits


def read_manifest(
    spark: SparkSession,
    paths: str | list[str],
    app_id: Column | None = None,
    work_dir: str | None = None,
) -> DataFrame:
    """Numbered manifest lines; one file is one app unless ``app_id`` says otherwise."""
    numbered, _ = number_lines(placed_lines(spark.read.text(paths), app_id), "app_id", work_dir)
    return numbered.select("app_id", "line_no", "value")


def write_annotations(
    lines: DataFrame, path: str, folders: list[str], document: list[str], order: list[str], together: str | None = None
) -> None:
    """Annotated lines as Parquet, in a folder per value of ``folders``.

    The lines of a document stay together, in ``order``; a large folder spreads over as
    many files as the documents hash to. An existing output is an error.

    ``together`` names a boolean column that is true where all lines of the document are in one partition already: those are
    not shuffled, and a folder has a file per partition of them. Give it as a literal for every branch of a union
    (``annotated_lines``), so that no line is computed twice. It is not written.
    """
    keys = [*folders, *document]
    if together is None:
        placed = lines.repartition(*keys)
    else:
        whole = F.coalesce(F.col(together), F.lit(False))
        placed = lines.filter(whole).unionByName(lines.filter(~whole).repartition(*keys)).drop(together)
    placed = placed.sortWithinPartitions(*keys, *order)
    placed.write.partitionBy(*folders).parquet(path, compression="zstd")
