"""The task flow as streams: manifests arrive as files, results leave as files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from lexiloom.operators.annotate import AnnotatorFactory
from lexiloom.operators.tasks import TASK, parse_tasks
from lexiloom.plans.text_analysis import run_tasks
from lexiloom.session import folder_names, is_complete, materialize, read_note, remove_folder, write_note
from lexiloom.sources.manifests import number_lines, placed_lines
from lexiloom.sources.pages import PageStore
from lexiloom.streaming import ledger

TASK_SCHEMA = "app_id string, line_no long, analysis string, url string, error string, arrived timestamp"
RESULT_SCHEMA = (
    "app_id string, line_no long, analysis string, url string, output string, error string, "
    "ok boolean"
)
#: Accepted tasks of an app as runs of line numbers, in folders by a hash of the app.
RUNS = "app_id string, first long, last long, app_bucket int"
APP_BUCKETS = 64
COUNTS = "app_id string, n_tasks long"
#: Line numbers that are brought together to make runs of them.
CHUNK = 1 << 16
MAX_AGE = "36500d"


def stream_lines(
    spark: SparkSession,
    path: str,
    app_id: Column | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """``app_id, file, block, arrived, value`` of the lines of every manifest that arrives in ``path``.

    Every file is taken, however old it is. A file is one message of any size: it is read in splits, and its lines get
    their numbers in the batch (``batch_tasks``). Manifests that are delivered again come again, and are recognised by
    their tasks (``start_results``).
    """
    # Without it, Spark ignores files a week older than the newest.
    reader = spark.readStream.format("text").option("maxFileAge", MAX_AGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return placed_lines(reader.load(path), app_id)


def batch_tasks(lines: DataFrame, work_dir: str | None = None) -> DataFrame:
    """The parsed tasks of a batch of ``lines``, each once, and when they ``arrived``.

    Lines are numbered from 0 in every file. If files of one app bring the same line number, the one that arrived
    first counts, of equals the first by name.
    """
    numbered, splits = number_lines(lines, "file", work_dir)
    if not splits.groupBy("app_id").agg(F.count_distinct("file").alias("n")).filter("n > 1").isEmpty():
        order = Window.partitionBy(*TASK).orderBy("arrived", "file")
        numbered = numbered.withColumn("turn", F.row_number().over(order)).filter("turn = 1").drop("turn")
    return parse_tasks(numbered.drop("file")).select(*TASK, "analysis", "url", "error", "arrived")


def claim_output(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Tie an output to the checkpoint of its stream.

    Batches are folders by number, so another checkpoint, which begins again at 0, would overwrite results. That is an
    error, as is a checkpoint that has run with another output.
    """
    mine, its = read_note(spark, f"{checkpoint}/owner"), read_note(spark, f"{out}/owner")
    if its is None and "offsets" in folder_names(spark, checkpoint):
        raise ValueError(f"{checkpoint} belongs to another output than {out}")
    if its is not None and mine != its:
        raise ValueError(f"{out} belongs to another checkpoint than {checkpoint}")
    if mine is None:
        mine = uuid.uuid4().hex
        write_note(spark, f"{checkpoint}/owner", mine)
    if its is None:
        write_note(spark, f"{out}/owner", mine)


def _start(
    lines: DataFrame, write: Callable[[DataFrame, int], None], out: str, checkpoint: str, available_now: bool
) -> StreamingQuery:
    claim_output(lines.sparkSession, out, checkpoint)
    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_tasks(lines: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the tasks of every micro-batch of ``stream_lines`` to a folder of its own below ``out``."""

    def write(batch: DataFrame, number: int) -> None:
        stages = f"{out}/stages/batch={number}"
        batch_tasks(batch, stages).write.mode("overwrite").parquet(f"{out}/tasks/batch={number}")
        remove_folder(lines.sparkSession, stages)

    return _start(lines, write, out, checkpoint, available_now)


def read_tasks(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(TASK_SCHEMA).parquet(f"{out}/tasks/batch=*")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("app_id"), F.lit(APP_BUCKETS)).cast("int")


def _chunk(line: str) -> Column:
    return F.floor(F.col(line) / CHUNK)


def task_runs(tasks: DataFrame) -> DataFrame:
    """``RUNS`` of distinct tasks: maximal runs of line numbers inside a chunk of them, so no app is a hot key."""
    place = F.row_number().over(Window.partitionBy("app_id", "chunk").orderBy("line_no"))
    rows = tasks.select(*TASK, _chunk("line_no").alias("chunk")).withColumn("run", F.col("line_no") - place)
    runs = rows.groupBy("app_id", "chunk", "run").agg(F.min("line_no").alias("first"), F.max("line_no").alias("last"))
    return runs.select("app_id", "first", "last", _bucket().alias("app_bucket")).repartition("app_bucket")


def join_runs(runs: DataFrame) -> DataFrame:
    """Disjoint runs with neighbours made one: an app that has come whole is a single run."""
    order = Window.partitionBy("app_id", "app_bucket").orderBy("first")
    new = F.coalesce((F.lag("last").over(order) + 1 < F.col("first")).cast("int"), F.lit(1))
    numbered = runs.withColumn("new", new).withColumn("run", F.sum("new").over(order))
    joined = numbered.groupBy("app_id", "app_bucket", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return joined.select("app_id", "first", "last", "app_bucket").repartition("app_bucket")


def new_tasks(tasks: DataFrame, accepted: str, number: int) -> DataFrame:
    """``tasks`` without those that a batch before ``number`` has accepted.

    Accepted tasks are runs of lines in a few blocks, whatever the number of batches (see ``ledger``); of these only the
    folders of the batch's apps are read.
    """
    if not number:
        return tasks
    buckets = [r[0] for r in tasks.select(_bucket().alias("b")).distinct().collect()]
    seen = ledger.read_before(tasks.sparkSession, accepted, number, RUNS).filter(F.col("app_bucket").isin(buckets))
    return outside_runs(tasks, seen)


def outside_runs(tasks: DataFrame, runs: DataFrame) -> DataFrame:
    """``tasks`` that lie in none of the ``runs``."""
    chunks = runs.select(
        F.col("app_id").alias("app"), "first", "last", F.explode(F.sequence(_chunk("first"), _chunk("last"))).alias("chunk")
    )
    same = (F.col("app_id") == F.col("app")) & (_chunk("line_no") == F.col("chunk"))
    return tasks.join(chunks, same & F.col("line_no").between(F.col("first"), F.col("last")), "left_anti")


def merge_deliveries(deliveries: Sequence[DataFrame], work_dir: str | None = None) -> DataFrame:
    """One result per task from tables of results that hold a task at most once each; the first one that has it counts.

    What earlier deliveries hold is written as runs of lines, a few rows that Spark broadcasts to the next one, so no output
    is moved. For very scattered tasks there are many runs, and Spark shuffles. Give tables that are cheap to read twice.
    """
    merged, *later = deliveries
    for delivery in later:
        runs = materialize(task_runs(merged), "delivered-runs", work_dir)
        merged = merged.unionByName(outside_runs(delivery, runs))
    return merged


def start_results(
    lines: DataFrame,
    pages: DataFrame | PageStore,
    annotators: Mapping[str, AnnotatorFactory],
    out: str,
    checkpoint: str,
    work_dir: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Run the tasks of every micro-batch of ``stream_lines`` and write their results below ``out``.

    A batch owns a folder named by its number and overwrites it when it is repeated
    after a failure, and leaves out tasks that an earlier batch has accepted, so every
    task has its result exactly once, however often and however late its manifest is
    delivered. The work of a batch does not grow with the number of batches before it, and with a ``PageStore`` not
    with the pages of other URLs. ``available_now`` ends the query when all waiting manifests are done.
    """
    spark = lines.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        accepted, waiting = f"{out}/accepted", f"{out}/tasks/batch={number}"
        stages = f"{work_dir or out}/stages/batch={number}"
        ledger.compact(spark, accepted, number, RUNS, join_runs, ["app_bucket"])
        # Written first, because the tasks are read more than once below.
        new_tasks(batch_tasks(batch, stages), accepted, number).write.mode("overwrite").parquet(waiting)
        tasks = spark.read.schema(TASK_SCHEMA).parquet(waiting)
        ledger.append(task_runs(tasks), accepted, number, ["app_bucket"])
        results = run_tasks(tasks, pages, annotators, work_dir=stages)
        results.write.mode("overwrite").parquet(f"{out}/results/batch={number}")
        remove_folder(spark, stages)

    return _start(lines, write, out, checkpoint, available_now)


def read_results(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(RESULT_SCHEMA).parquet(f"{out}/results/batch=*")


def app_states(spark: SparkSession, out: str) -> DataFrame:
    """``app_id, submitted, finished, outstanding, done`` from what ``start_results`` wrote.

    The runs of accepted tasks are added up; there are a few blocks of them, so the cost does not grow with the
    number of batches, nor are tasks or results read. A task that is accepted has its result when its batch is through; only the last
    batch may still be at work.
    """
    blocks = ledger.finished_blocks(spark, f"{out}/accepted")
    runs = ledger.read_blocks(spark, f"{out}/accepted", blocks, RUNS)
    working = F.lit(False)
    if blocks and blocks[-1][0] == 0 and not is_complete(spark, f"{out}/results/batch={blocks[-1][1]}"):
        working = (F.col("level") == 0) & (F.col("block") == blocks[-1][1])
    size = F.col("last") - F.col("first") + 1
    states = runs.groupBy("app_id").agg(
        F.sum(size).alias("submitted"), F.sum(F.when(working, 0).otherwise(size)).alias("finished")
    )
    outstanding = F.col("submitted") - F.col("finished")
    return states.select("*", outstanding.alias("outstanding"), (outstanding == 0).alias("done"))


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("app_id").agg(F.sum("n_tasks").alias("n_tasks"))


def start_progress(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    mode: str = "update",
    available_now: bool = True,
) -> StreamingQuery:
    """Running number of delivered tasks per app, one folder per micro-batch below ``out``.

    ``update`` writes the apps that changed, ``complete`` all of them. Counts of earlier batches lie in a few blocks
    (see ``ledger``), so the stream keeps no state for an app, finished or not.
    """
    if mode not in ("update", "complete"):
        raise ValueError(f"unknown mode: {mode}")
    spark, root = lines.sparkSession, f"{out}/counts"

    def write(batch: DataFrame, number: int) -> None:
        ledger.compact(spark, root, number, COUNTS, _sums)
        ledger.append(batch.groupBy("app_id").agg(F.count(F.lit(1)).alias("n_tasks")), root, number)
        new = ledger.read_blocks(spark, root, [(0, number)], COUNTS).select("app_id", "n_tasks")
        before = ledger.read_before(spark, root, number, COUNTS).select("app_id", "n_tasks")
        if mode == "update":
            before = before.join(new.select("app_id"), "app_id", "left_semi")
        _sums(before.unionByName(new)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _start(lines, write, out, checkpoint, available_now)


def latest_progress(spark: SparkSession, out: str) -> DataFrame:
    """``app_id, n_tasks`` of all batches so far, from the few blocks of their counts."""
    root = f"{out}/counts"
    blocks = ledger.finished_blocks(spark, root)
    return _sums(ledger.read_blocks(spark, root, blocks, COUNTS))
