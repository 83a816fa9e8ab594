"""Task rows: parsing, joining with documents, results, summaries, progress."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import strip_control
from lexiloom.operators.annotate import ANALYSES
from lexiloom.operators.joins import MAX_BROADCAST_ROWS, fits_broadcast
from lexiloom.session import materialize, work_path

TASK = ["app_id", "line_no"]

#: Rows of a file whose wanted places travel together, and how many such chunks are broadcast at once (4 million places).
CHUNK_ROWS = 4096
MAX_CHUNKS = 1024


def parse_tasks(lines: DataFrame) -> DataFrame:
    """``app_id, line_no, analysis, url, error`` from ``app_id, line_no, value``.

    A line is an analysis and a URL with white space between. Bad lines stay, with an
    error; a line without URL gets the URL ``ERROR``. Equal lines are separate tasks.
    Other columns pass through.
    """
    parts = F.split(strip_control(F.col("value")), r"[ \t\n\x0b\f\r]+", 2)
    rest = [name for name in lines.columns if name not in (*TASK, "value")]
    rows = lines.select(*TASK, *rest, parts.alias("p")).select(
        *TASK,
        *rest,
        F.col("p")[0].alias("analysis"),
        F.coalesce(F.get("p", F.lit(1)), F.lit("ERROR")).alias("url"),
        (F.size("p") == 2).alias("complete"),
    )
    error = F.when(~F.col("complete"), F.lit("expected an analysis and a url")).when(
        ~F.col("analysis").isin(*ANALYSES),
        F.concat(F.lit("unknown analysis: "), F.col("analysis")),
    )
    return rows.select(*TASK, "analysis", "url", error.alias("error"), *rest)


def requested_pages(
    tasks: DataFrame,
    pages: DataFrame,
    work_dir: str | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    written: bool = False,
) -> DataFrame:
    """``url, text`` of the pages that valid tasks ask for, one row per URL; on request a written table.

    Pages are cut to the wanted URLs before any text is shuffled: by a broadcast if a count shows that the
    URLs fit one, else by their places in the files (``late_pages``). Of several pages
    with one URL the least text counts; a page without text is no document.
    """
    wanted = tasks.filter(F.col("error").isNull()).select("url").distinct()
    if fits_broadcast(wanted, max_rows):
        found = pages.select("url", "text").join(F.broadcast(wanted), "url", "left_semi")
    elif has_places(pages):
        return late_pages(wanted, pages, work_dir, max_rows, written)
    else:
        found = pages.select("url", "text").join(wanted, "url", "left_semi")
    found = found.filter("text IS NOT NULL").groupBy("url").agg(F.min("text").alias("text"))
    return materialize(found, "requested-pages", work_dir) if written else found


def has_places(df: DataFrame) -> bool:
    """Whether the rows of ``df`` come from one table of files that knows the number of a row (also below projections and filters)."""
    hidden = df._jdf.queryExecution().analyzed().metadataOutput()
    found = [hidden.apply(i) for i in range(hidden.size()) if hidden.apply(i).name() == "_metadata"]
    return len(found) == 1 and "row_index" in list(found[0].dataType().fieldNames())


def late_pages(
    wanted: DataFrame, pages: DataFrame, work_dir: str | None, max_rows: int, written: bool = False
) -> DataFrame:
    """``url, text`` of ``pages``, a table read from files, whose ``url`` is ``wanted``: places first, texts last.

    Only URLs and places (file and row) are shuffled to find the wanted rows. Their places are then gathered into one row for
    every ``CHUNK_ROWS`` rows of a file, and blocks of files with at most ``max_rows`` of these (at most ``MAX_CHUNKS``) are fetched one after
    another by a broadcast join, so every block reads its own files only, a file is read once unless it has more rows than that, and
    no text moves. Only texts of URLs that occur more than once are compared, by URL. A text is written once as it is fetched;
    with ``written``, what is left of the compared ones too.
    """
    spark = pages.sparkSession
    places = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    chunk, key = F.expr(f"row div {CHUNK_ROWS}"), F.xxhash64("row", "url")
    found = pages.select("url", *places).join(wanted, "url", "left_semi")
    found = materialize(found, "wanted-places", work_dir)
    # Their own scan, so that rows of a URL with very many pages can be split.
    repeated = found.groupBy("url").count().filter("count > 1").select("url", F.lit(True).alias("repeated"))
    marked = found.join(repeated, "url", "left").withColumns({"chunk": chunk, "key": key})
    chunks = marked.groupBy("file", "chunk").agg(
        F.collect_list(F.pmod("row", F.lit(CHUNK_ROWS)).cast("int")).alias("rows"),
        F.collect_list("key").alias("keys"),
        F.collect_list(F.when(F.col("repeated"), F.col("key"))).alias("repeated_keys"),
    )
    chunks = materialize(chunks, "marked-places", work_dir)
    out = work_path(spark, "wanted-pages", work_dir)
    # A row may give several URLs, so a chunk can have more places than rows.
    weight = F.sum(F.ceil(F.size("keys") / CHUNK_ROWS)).alias("weight")
    sizes = sorted(tuple(r) for r in chunks.groupBy("file").agg(weight).collect())
    wants = F.expr("array_contains(keys, key) AND array_contains(rows, place)")
    for block, (files, parts, part) in enumerate(file_blocks(sizes, min(max_rows, MAX_CHUNKS))):
        own = chunks.filter(F.col("file").isin(files) & (F.pmod("chunk", F.lit(parts)) == part))
        scan = pages.select("url", "text", *places).filter(F.col("file").isin(files) & F.col("text").isNotNull())
        scan = scan.withColumns({"chunk": chunk, "key": key, "place": F.pmod("row", F.lit(CHUNK_ROWS)).cast("int")})
        rows = scan.join(F.broadcast(own), ["file", "chunk"]).filter(wants)
        again = F.expr("array_contains(repeated_keys, key)").alias("repeated")
        rows.select("url", "text", again).write.parquet(f"{out}/block={block}")
    schema = "url string, text string, repeated boolean, block int"
    fetched = spark.read.schema(schema).parquet(out) if sizes else spark.createDataFrame([], schema)
    single = fetched.filter("NOT repeated").select("url", "text")
    several = fetched.filter("repeated").groupBy("url").agg(F.min("text").alias("text"))
    return single.unionByName(materialize(several, "repeated-pages", work_dir) if written else several)


def file_blocks(sizes: list[tuple[str, int]], max_rows: int) -> Iterator[tuple[list[str], int, int]]:
    """Files, parts and number of the part: runs of files with at most ``max_rows``; a larger file in parts by row."""
    files, total = [], 0
    for file, n in sizes:
        parts = -(-n // max_rows)
        if files and total + n > max_rows:
            yield files, 1, 0
            files, total = [], 0
        if parts > 1:
            yield from (([file], parts, part) for part in range(parts))
        else:
            files, total = [*files, file], total + n
    if files:
        yield files, 1, 0


def resolve_documents(tasks: DataFrame, pages: DataFrame) -> DataFrame:
    """Add ``text`` by URL; a valid task without document gets an error.

    A left join without hint: Spark splits the partitions of a URL that very many tasks
    ask for.
    """
    found = tasks.join(requested_pages(tasks, pages), "url", "left")
    missing = F.when(
        F.col("text").isNull(), F.concat(F.lit("document not available: "), F.col("url"))
    )
    return found.select(
        *TASK, "analysis", "url", F.coalesce("error", missing).alias("error"), "text"
    )


def requested_documents(tasks: DataFrame, pages: DataFrame) -> DataFrame:
    """``url, text, analyses``: a document once, with the few analyses valid tasks ask for.

    ``pages`` has one row per URL, as ``requested_pages`` gives it.
    """
    wanted = tasks.filter(F.col("error").isNull()).groupBy("url")
    analyses = wanted.agg(F.collect_set("analysis").alias("analyses"))
    return analyses.join(pages.select("url", "text"), "url").select("url", "text", "analyses")


def asked_documents(tasks: DataFrame) -> DataFrame:
    """``analysis, url, app_id, line_no`` for everything that valid tasks ask for: the task, if it is the only one, else nulls."""
    asked = tasks.filter(F.col("error").isNull()).groupBy("analysis", "url")
    only = F.count(F.lit(1)) == 1
    return asked.agg(*(F.when(only, F.min(name)).alias(name) for name in TASK))


def task_results(tasks: DataFrame, pages: DataFrame, outputs: DataFrame) -> DataFrame:
    """``app_id, line_no, analysis, url, output, error, ok`` for every task, failed or not.

    ``outputs`` has ``analysis, url, app_id, line_no, output``, one row for all of ``asked_documents`` that ``pages`` holds; ``pages`` are the
    requested ones, one row per URL. An output that one task alone asked for lies beside that task, and only the others are joined to theirs.
    A document without any line of annotation is a failure of the task.
    """
    alone = outputs.filter("line_no IS NOT NULL")
    known = pages.select("url", F.lit(True).alias("known"))
    shared = outputs.filter("line_no IS NULL").select("analysis", "url", "output")
    direct = alone.select(*TASK, "analysis", "url", "output", F.lit(None).cast("string").alias("error"), F.lit(True).alias("known"))
    served = alone.select(F.col("app_id").alias("app"), F.col("line_no").alias("line"))
    rows = tasks.join(served, F.col("app_id").eqNullSafe(F.col("app")) & (F.col("line_no") == F.col("line")), "left_anti")
    rows = rows.join(shared, ["analysis", "url"], "left")
    rows = rows.join(known, "url", "left").select(*direct.columns).unionByName(direct)
    error = F.coalesce(
        F.col("error"),
        F.when(F.col("known").isNull(), F.concat(F.lit("document not available: "), F.col("url"))),
        F.when(F.coalesce(F.col("output"), F.lit("")) == "", F.lit("empty annotation")),
    )
    return rows.select(
        *TASK,
        "analysis",
        "url",
        F.when(error.isNull(), F.col("output")).alias("output"),
        error.alias("error"),
        error.isNull().alias("ok"),
    )


def dedupe_results(results: DataFrame) -> DataFrame:
    """One result per task, however often it was delivered."""
    return results.dropDuplicates(TASK)


def task_summary(results: DataFrame) -> DataFrame:
    """``app_id, line_no, analysis, url, result, is_error``: output, or else the error."""
    return results.select(
        *TASK,
        "analysis",
        "url",
        F.coalesce("error", "output").alias("result"),
        F.col("error").isNotNull().alias("is_error"),
    )


def app_progress(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """``app_id, submitted, finished, outstanding, done``; repeated results count once."""
    finished = results.select(*TASK).distinct().withColumn("hit", F.lit(1))
    rows = tasks.select(*TASK).join(finished, TASK, "left")
    counts = rows.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("submitted"), F.count("hit").alias("finished")
    )
    outstanding = F.col("submitted") - F.col("finished")
    return counts.select(
        "*", outstanding.alias("outstanding"), (outstanding == 0).alias("done")
    )
