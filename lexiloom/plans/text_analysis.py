"""From a task manifest and a table of documents to results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.operators.annotate import AnnotatorFactory, annotate, annotate_documents, rebalance
from lexiloom.operators.sentences import annotation_lines, document_lines, document_output, sentence_list, sentences
from lexiloom.operators.tasks import (
    asked_documents,
    parse_tasks,
    requested_documents,
    requested_pages,
    task_results,
)
from lexiloom.session import materialize
from lexiloom.sources.manifests import read_manifest
from lexiloom.sources.pages import PageStore

#: Code points of a text whose sentences are spread over many tasks.
LONG_TEXT = 1 << 16


def annotated_lines(
    tasks: DataFrame,
    pages: DataFrame,
    annotators: Mapping[str, AnnotatorFactory],
    partitions: int | None = None,
) -> DataFrame:
    """Annotation lines of every (analysis, document) that some valid task asks for.

    ``pages`` has one row per URL. Documents are spread before they are repeated for every analysis, with their sentences in one
    row, so all lines of a document are in one partition: ``together`` is true. Sentences of a text of more than ``LONG_TEXT``
    code points are spread one by one, and their lines are not together.
    """
    docs = requested_documents(tasks, pages)
    long = F.length("text") > LONG_TEXT
    short = docs.filter(~long).select("url", "analyses", sentence_list("text").alias("sentences"))
    found = sentences(docs.filter(long))
    if partitions:
        short, found = rebalance(short, partitions), rebalance(found, partitions)
    whole = short.select(F.explode("analyses").alias("analysis"), "url", "sentences").select("analysis", "url", F.inline("sentences"))
    spread = found.select(F.explode("analyses").alias("analysis"), "url", "sent_no", "sentence")
    parts = [annotation_lines(annotate(rows, annotators)).withColumn("together", F.lit(rows is whole)) for rows in (whole, spread)]
    return parts[0].unionByName(parts[1])


def document_outputs(
    asked: DataFrame,
    pages: DataFrame,
    annotators: Mapping[str, AnnotatorFactory],
    partitions: int | None = None,
) -> DataFrame:
    """``analysis, url, app_id, line_no, output`` for all of ``asked`` (see ``asked_documents``) that ``pages`` holds.

    The sentences of a document stay in its row, so no line is shuffled. Those of a text of more than ``LONG_TEXT`` code points
    become rows of their own, are annotated by many tasks and brought together.
    """
    wants = asked.groupBy("url").agg(F.collect_list(F.struct("analysis", "app_id", "line_no")).alias("wants"))
    long = F.length("text") > LONG_TEXT
    short_docs = pages.filter(~long).join(wants, "url").select("url", "wants", sentence_list("text").alias("sentences"))
    if partitions:
        short_docs = rebalance(short_docs, partitions)
    short_docs = short_docs.select("url", F.inline("wants"), "sentences")
    short = annotate_documents(short_docs, annotators).select(*asked.columns, document_output(F.col("annotated")).alias("output"))
    docs = pages.filter(long).join(wants, "url").select("url", "text", F.inline("wants"))
    lines = annotation_lines(annotate(sentences(docs.select("analysis", "url", "text")), annotators, partitions))
    joined = document_lines(lines, ["analysis", "url"]).select("analysis", "url", "output")
    return short.unionByName(docs.select(*asked.columns).join(joined, ["analysis", "url"], "left"))


def run_tasks(
    tasks: DataFrame,
    pages: DataFrame | PageStore,
    annotators: Mapping[str, AnnotatorFactory],
    partitions: int | None = None,
    work_dir: str | None = None,
) -> DataFrame:
    """One result per task. Failures become errors of their task; the job goes on.

    A document is annotated once per analysis even if a third of all tasks ask for it;
    its output is written, and then joined to those tasks. ``pages`` is read once, cut to
    what the tasks ask for and written; URLs may repeat. Of a ``PageStore`` only the
    folders of the tasks' URLs are read.
    """
    if isinstance(pages, PageStore):
        pages = pages.holding(tasks.filter("error IS NULL").select("url"))
    pages = requested_pages(tasks, pages, work_dir, written=True)
    outputs = materialize(document_outputs(asked_documents(tasks), pages, annotators, partitions), "outputs", work_dir)
    return task_results(tasks, pages, outputs)


def text_analysis_job(
    spark: SparkSession,
    manifests: str | list[str],
    pages: DataFrame | PageStore,
    annotators: Mapping[str, AnnotatorFactory],
    out: str,
    partitions: int | None = None,
    work_dir: str | None = None,
) -> DataFrame:
    """Run every line of the manifests and keep the results in ``out``, which must be new."""
    lines = read_manifest(spark, manifests, work_dir=work_dir)
    tasks = materialize(parse_tasks(lines), "tasks", work_dir)
    results = run_tasks(tasks, pages, annotators, partitions, work_dir)
    results.write.parquet(out)
    return spark.read.schema(results.schema).parquet(out)
