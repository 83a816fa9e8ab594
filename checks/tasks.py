"""Manifests, tasks, sentences, annotation, results, streams."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import common as c
from lexiloom.operators.annotate import Batched, annotate
from lexiloom.operators.sentences import (
    annotation_lines,
    constituency_lines,
    dependency_lines,
    document_lines,
    pos_lines,
    sentences,
)
from lexiloom.operators.tasks import (
    app_progress,
    dedupe_results,
    parse_tasks,
    requested_pages,
    resolve_documents,
    task_summary,
)
from lexiloom.plans.text_analysis import annotated_lines, run_tasks
from lexiloom.session import materialize, spread, work_path
from lexiloom.sources.manifests import read_manifest, write_annotations
from lexiloom.sources.pages import write_pages
from lexiloom.streaming.tasks import (
    app_states,
    latest_progress,
    merge_deliveries,
    read_results,
    read_tasks,
    start_progress,
    start_results,
    start_tasks,
    stream_lines,
)

# --- annotators: stand-ins that plain SQL can repeat ----------------------------------------


def _words(sentence: str) -> list[str]:
    words = sentence.split()
    if len(words) % 7 == 0:
        raise ValueError("a sentence of such length")
    return words


def pos_annotator():
    return lambda sentence: [[(w, str(len(w))) for w in _words(sentence)]]


def dependency_annotator():
    def run(sentence: str):
        words = _words(sentence)
        return [[("next", a, b) for a, b in zip(words, words[1:])]]

    return run


def constituency_annotator():
    return lambda sentence: ["(S " + " ".join(f"({w})" for w in _words(sentence)) + ")"]


ANNOTATORS = {
    "POS": pos_annotator,
    "DEPENDENCY": dependency_annotator,
    "CONSTITUENCY": constituency_annotator,
}


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """``url, text``: the document table as crawled pages."""
    docs = spread(c.table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select(F.concat(F.lit("doc://"), "doc_id").alias("url"), "text")


# --- manifests: an app per language, so that one app has most of the lines --------------------


def task_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Four task lines per document; the fourth is broken in some way, or asks for document 0."""
    docs = c.table(spark, sf, "documents").select("lang", "source", "doc_id")
    url = F.concat(F.lit("doc://"), "doc_id")
    last = F.get(
        F.array(
            F.lit(""),
            F.lit("POS"),
            F.concat(F.lit("pos\t"), url),
            F.lit("ERROR ERROR"),
            F.concat(F.lit("POS\t"), url, F.lit("/missing")),
            F.lit(" POS doc://0 "),
        ),
        (F.col("doc_id") % 6).cast("int"),
    )
    lines = F.array(
        F.concat(F.lit("POS\t"), url),
        F.concat(F.lit("CONSTITUENCY    "), url),
        F.concat(F.lit("DEPENDENCY\t"), url),
        last,
    )
    return docs.select("lang", "source", "doc_id", F.posexplode(lines).alias("k", "value"))


def write_manifests(spark: SparkSession, sf: str) -> str:
    """Sorted files in a folder per language: an app is a folder."""
    rows = task_lines(spark, sf)
    path = work_path(spark, "manifests")
    ordered = rows.orderBy("lang", "doc_id", "k").select("lang", "value")
    ordered.write.partitionBy("lang").text(path)
    return path


def write_messages(spark: SparkSession, sf: str) -> str:
    """For the streams, a file per document source: a file is a message and an app."""
    rows = task_lines(spark, sf)
    path = work_path(spark, "messages")
    placed = rows.repartition("source").sortWithinPartitions("source", "doc_id", "k")
    placed.select("source", "value").write.partitionBy("source").text(path)
    return path


def folder(name: str) -> Column:
    return F.regexp_extract(F.col("file"), name + "=([^/]+)/", 1)


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return read_manifest(spark, write_manifests(spark, sf), folder("lang"))


def tasks(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(parse_tasks(manifest(spark, sf)), "tasks")


def results(spark: SparkSession, sf: str) -> DataFrame:
    return run_tasks(tasks(spark, sf), documents(spark, sf), ANNOTATORS)


def manifest_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = manifest(spark, sf)
    return rows.select("app_id", "line_no", "value")


def task_validation(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf)


def task_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Every web page asked for once by its address and once by one that is not there."""
    pages = c.table(spark, sf, "pages").select("page_id", "url", F.col("html").alias("text"))
    lines = pages.select(
        F.lit("web").alias("app_id"),
        F.inline(
            F.array(
                F.struct(
                    (F.col("page_id") * 2).cast("long").alias("line_no"),
                    F.concat(F.lit("POS\t"), "url").alias("value"),
                ),
                F.struct(
                    (F.col("page_id") * 2 + 1).cast("long").alias("line_no"),
                    F.concat(F.lit("POS\t"), "url", F.lit("$gone")).alias("value"),
                ),
            )
        ),
    )
    found = resolve_documents(parse_tasks(lines), pages)
    return found.withColumn("text", F.md5("text"))


def task_results(spark: SparkSession, sf: str) -> DataFrame:
    return results(spark, sf).withColumn("output", F.md5("output"))


def task_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    """Results delivered twice, one summary row per task."""
    delivered = results(spark, sf)
    return task_summary(merge_deliveries([delivered, delivered]))


def dedupe_results_query(spark: SparkSession, sf: str) -> DataFrame:
    """Results repeated once for every character of their analysis."""
    delivered = resolve_documents(tasks(spark, sf), documents(spark, sf)).drop("text")
    repeated = delivered.withColumn("again", F.explode(F.split("analysis", ""))).drop("again")
    return dedupe_results(repeated)


def app_progress_query(spark: SparkSession, sf: str) -> DataFrame:
    """Only tasks without error have a result yet, and each has it twice."""
    all_tasks = tasks(spark, sf)
    finished = all_tasks.filter("error IS NULL")
    return app_progress(all_tasks, finished.unionByName(finished))


# --- sentences and lines -----------------------------------------------------------------------


def sentences_query(spark: SparkSession, sf: str) -> DataFrame:
    return sentences(documents(spark, sf))


def _annotated(spark: SparkSession, sf: str, analysis: str) -> DataFrame:
    found = sentences(documents(spark, sf)).withColumn("analysis", F.lit(analysis))
    return annotate(found, ANNOTATORS)


def pos_lines_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = pos_lines(_annotated(spark, sf, "POS"))
    return rows.select("url", "sent_no", "part_no", "line", "error")


def dependency_lines_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = dependency_lines(_annotated(spark, sf, "DEPENDENCY"))
    return rows.select("url", "sent_no", "part_no", "line", "error")


def constituency_lines_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = constituency_lines(_annotated(spark, sf, "CONSTITUENCY"))
    return rows.select("url", "sent_no", "part_no", "line", "error")


def document_lines_query(spark: SparkSession, sf: str) -> DataFrame:
    return document_lines(pos_lines(_annotated(spark, sf, "POS")), ["url"])


def annotation_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written per analysis and read back, all three analyses in one run."""
    lines = annotated_lines(tasks(spark, sf), documents(spark, sf), ANNOTATORS, 8)
    path = work_path(spark, "annotations")
    kept = lines.filter("line IS NOT NULL").select("analysis", "url", "sent_no", "part_no", "line", "together")
    write_annotations(kept, path, ["analysis"], ["url"], ["sent_no", "part_no"], "together")
    back = spark.read.parquet(path)
    return back.groupBy("analysis", "url").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars")
    )


# --- streams -----------------------------------------------------------------------------------


def stream_tasks_query(spark: SparkSession, sf: str) -> DataFrame:
    stream = stream_lines(spark, write_messages(spark, sf), folder("source"), files_per_trigger=8)
    out, state = work_path(spark, "stream-tasks"), work_path(spark, "stream-state")
    start_tasks(stream, out, state).awaitTermination()
    return read_tasks(spark, out).drop("arrived")


def stream_results_query(spark: SparkSession, sf: str) -> DataFrame:
    stream = stream_lines(spark, write_messages(spark, sf), folder("source"), files_per_trigger=8)
    out = work_path(spark, "stream-results")
    state = work_path(spark, "stream-state")
    start_results(stream, documents(spark, sf), ANNOTATORS, out, state).awaitTermination()
    return read_results(spark, out).withColumn("output", F.md5("output"))


def stream_results_store(spark: SparkSession, sf: str) -> DataFrame:
    """The stream over pages laid out by URL."""
    stream = stream_lines(spark, write_messages(spark, sf), folder("source"), files_per_trigger=8)
    out, state = work_path(spark, "stream-results"), work_path(spark, "stream-state")
    store = write_pages(documents(spark, sf), work_path(spark, "page-store"))
    start_results(stream, store, ANNOTATORS, out, state).awaitTermination()
    return read_results(spark, out).withColumn("output", F.md5("output"))


def requested_pages_by_place(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of the pages that tasks ask for, fetched by file and row; every tenth page comes a second time, longer."""
    docs = c.table(spark, sf, "documents").select(F.concat(F.lit("doc://"), "doc_id").alias("url"), "text", "doc_id")
    path = work_path(spark, "pages")
    again = docs.filter("doc_id % 10 = 0").withColumn("text", F.concat("text", F.lit(" More of it.")))
    docs.unionByName(again).drop("doc_id").write.parquet(path)
    wanted = tasks(spark, sf).filter("line_no % 3 = 1")
    found = requested_pages(wanted, spark.read.parquet(path), max_rows=200)
    return found.select("url", F.md5("text").alias("text"))


def _stream_progress(spark: SparkSession, sf: str, mode: str, files: int = 8) -> DataFrame:
    stream = stream_lines(spark, write_messages(spark, sf), folder("source"), files_per_trigger=files)
    out = work_path(spark, "stream-progress")
    state = work_path(spark, "stream-state")
    start_progress(stream, out, state, mode).awaitTermination()
    return latest_progress(spark, out)


def stream_redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the manifests, then all of them with time stamps of long ago.

    An app is a source, so the second delivery of a manifest brings the same tasks again.
    """
    out, state = work_path(spark, "stream-results"), work_path(spark, "stream-state")
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = task_lines(spark, sf).withColumn("n", F.pmod(F.xxhash64("source"), F.lit(3)))
    inbox = work_path(spark, "inbox")
    for turn, part in enumerate((rows.filter("n < 2"), rows)):
        placed = part.repartition("source").sortWithinPartitions("source", "doc_id", "k")
        placed.select("source", "value").write.mode("append").partitionBy("source").text(inbox)
        if turn:
            root = files.Path(inbox)
            system = root.getFileSystem(conf)
            found = system.listFiles(root, True)
            while found.hasNext():
                system.setTimes(found.next().getPath(), 86_400_000, -1)
        stream = stream_lines(spark, inbox, folder("source"), files_per_trigger=8)
        start_results(stream, documents(spark, sf), ANNOTATORS, out, state).awaitTermination()
    return read_results(spark, out).withColumn("output", F.md5("output"))


def stream_completion(spark: SparkSession, sf: str) -> DataFrame:
    """States of the apps after a stream has run."""
    stream = stream_lines(spark, write_messages(spark, sf), folder("source"), files_per_trigger=8)
    out, state = work_path(spark, "stream-results"), work_path(spark, "stream-state")
    start_results(stream, documents(spark, sf), ANNOTATORS, out, state).awaitTermination()
    return app_states(spark, out)


def task_results_repeated_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every page three times: the least text of a URL counts, pages without text do not."""
    pages = documents(spark, sf)
    longer = pages.withColumn("text", F.concat("text", F.lit(" More of it.")))
    none = pages.withColumn("text", F.lit(None).cast("string"))
    found = run_tasks(tasks(spark, sf), longer.unionByName(pages).unionByName(none), ANNOTATORS)
    return found.withColumn("output", F.md5("output"))


def _faulty_pos():
    """Tags that are no strings, none at all, pairs of the wrong length, or two parts."""

    def run(sentence: str):
        words = sentence.split()
        kind = len(words) % 5
        if kind == 0:
            return [[(w, len(w)) for w in words]]
        if kind == 1:
            return [[(w, None) for w in words]]
        if kind == 2:
            return [[(w,) for w in words]]
        if kind == 3:
            return None
        half = len(words) // 2
        return [[(w, "A") for w in words[:half]], [(w, "B") for w in words[half:]]]

    return run


def _faulty_factory():
    raise OSError("no model")


def annotation_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Annotators that misbehave: every sentence has its rows, failed ones an error."""
    found = sentences(documents(spark, sf))
    analyses = F.explode(F.array(*map(F.lit, ("POS", "DEPENDENCY", "CONSTITUENCY"))))
    faulty = {"POS": _faulty_pos, "DEPENDENCY": _faulty_factory, "CONSTITUENCY": lambda: lambda s: [s, 7]}
    rows = annotation_lines(annotate(found.withColumn("analysis", analyses), faulty))
    return rows.select(
        "url", "sent_no", "analysis", "part_no", "line", F.col("error").isNotNull().alias("failed")
    )


def _faulty_batches(factory):
    """The same annotator for batches; one sentence that it cannot take fails the whole batch."""

    def build():
        one = factory()

        def run(sentences: list[str]):
            found = [one(sentence) for sentence in sentences]
            if None in found:
                raise ValueError("a sentence in this batch")
            return found

        return run

    return build


def annotation_faults_batched(spark: SparkSession, sf: str) -> DataFrame:
    """The same faults by annotators that take batches: no sentence suffers from another one."""
    found = sentences(documents(spark, sf))
    analyses = F.explode(F.array(*map(F.lit, ("POS", "DEPENDENCY", "CONSTITUENCY"))))
    faulty = {
        "POS": Batched(_faulty_batches(_faulty_pos), 16),
        "DEPENDENCY": Batched(_faulty_factory),
        "CONSTITUENCY": Batched(_faulty_batches(lambda: lambda s: [s, 7])),
    }
    rows = annotation_lines(annotate(found.withColumn("analysis", analyses), faulty))
    return rows.select(
        "url", "sent_no", "analysis", "part_no", "line", F.col("error").isNotNull().alias("failed")
    )


QUERIES = {
    "stream_redelivery": stream_redelivery,
    "stream_completion": stream_completion,
    "task_results_repeated_pages": task_results_repeated_pages,
    "annotation_faults": annotation_faults,
    "annotation_faults_batched": annotation_faults_batched,
    "manifest_parse": manifest_parse,
    "task_validation": task_validation,
    "task_resolve": task_resolve,
    "task_results": task_results,
    "task_summary": task_summary_query,
    "dedupe_results": dedupe_results_query,
    "app_progress": app_progress_query,
    "sentences": sentences_query,
    "pos_lines": pos_lines_query,
    "dependency_lines": dependency_lines_query,
    "constituency_lines": constituency_lines_query,
    "document_lines": document_lines_query,
    "annotation_sink": annotation_sink,
    "stream_tasks": stream_tasks_query,
    "stream_results": stream_results_query,
    "stream_results_store": stream_results_store,
    "requested_pages_by_place": requested_pages_by_place,
    "stream_progress": lambda spark, sf: _stream_progress(spark, sf, "update"),
    "stream_progress_complete": lambda spark, sf: _stream_progress(spark, sf, "complete"),
    # A batch for every manifest, so that counts are merged in levels.
    "stream_progress_batches": lambda spark, sf: _stream_progress(spark, sf, "update", 1),
}

# --- the same in SQL -----------------------------------------------------------------------------

TAB = "chr(9)"

SQL_RAW = f"""raw AS (
      SELECT lang, source, doc_id, unnest([0, 1, 2, 3]) AS k,
        unnest(['POS' || {TAB} || 'doc://' || doc_id,
                'CONSTITUENCY    doc://' || doc_id,
                'DEPENDENCY' || {TAB} || 'doc://' || doc_id,
                CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'POS' WHEN 2 THEN 'pos' || {TAB} || 'doc://' || doc_id
                  WHEN 3 THEN 'ERROR ERROR' WHEN 4 THEN 'POS' || {TAB} || 'doc://' || doc_id || '/missing'
                  ELSE ' POS doc://0 ' END]) AS value
      FROM documents)"""


def _sql_manifest(app: str) -> str:
    return f"""{SQL_RAW},
    manifest AS (SELECT {app} AS app_id, value,
        CAST(row_number() OVER (PARTITION BY {app} ORDER BY doc_id, k) - 1 AS BIGINT) AS line_no
      FROM raw)"""


SQL_TASKS = rf"""parts AS (SELECT app_id, line_no, trim(value, chr(9) || ' ') AS v FROM manifest),
    halves AS (SELECT app_id, line_no, regexp_extract(v, '^[^ \t]*') AS analysis,
        regexp_extract(v, '^[^ \t]*[ \t]+(.*)$', 1) AS rest, regexp_matches(v, '[ \t]') AS complete
      FROM parts),
    tasks AS (SELECT app_id, line_no, analysis, CASE WHEN complete THEN rest ELSE 'ERROR' END AS url,
        CASE WHEN NOT complete THEN 'expected an analysis and a url'
             WHEN analysis NOT IN ('POS', 'CONSTITUENCY', 'DEPENDENCY') THEN 'unknown analysis: ' || analysis
        END AS error FROM halves)"""

SQL_SENTENCES = r"""cut AS (
      SELECT 'doc://' || doc_id AS url,
        regexp_split_to_array(text, '[.!?]+[ \t\n\x0b\f\r]*') AS pieces FROM documents),
    numbered AS (SELECT url, unnest(range(len(pieces))) AS sent_no, unnest(pieces) AS piece FROM cut),
    trimmed AS (SELECT url, CAST(sent_no AS INTEGER) AS sent_no,
        regexp_replace(piece, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS sentence FROM numbered),
    sentences AS (SELECT * FROM trimmed WHERE length(sentence) BETWEEN 5 AND 400)"""

SQL_LINES = r"""tokens AS (SELECT url, sent_no, regexp_split_to_array(sentence, '[ \t\n\x0b\f\r]+') AS w FROM sentences),
    checked AS (SELECT *, CASE WHEN len(w) % 7 = 0 THEN 'ValueError: a sentence of such length' END AS error
      FROM tokens),
    lines AS (SELECT url, sent_no, error,
        CASE WHEN error IS NULL THEN
          list_aggregate(list_transform(w, lambda x: x || '/' || length(x) || ' '), 'string_agg', '') END AS pos,
        CASE WHEN error IS NULL THEN coalesce(list_aggregate(
          list_transform(range(1, len(w)), lambda i: 'next(' || w[i] || ', ' || w[i + 1] || ')' || chr(10)),
          'string_agg', ''), '') END AS dependency,
        CASE WHEN error IS NULL THEN
          '(S ' || list_aggregate(list_transform(w, lambda x: '(' || x || ')'), 'string_agg', ' ') || ')' END AS tree
      FROM checked),
    per_analysis AS (SELECT url, sent_no, 'POS' AS analysis, pos AS line FROM lines
      UNION ALL SELECT url, sent_no, 'DEPENDENCY', dependency FROM lines
      UNION ALL SELECT url, sent_no, 'CONSTITUENCY', tree FROM lines),
    outputs AS (SELECT analysis, url, string_agg(line || chr(10), '' ORDER BY sent_no) AS output
      FROM per_analysis WHERE line IS NOT NULL GROUP BY ALL)"""

SQL_RESULTS = """results AS (
      SELECT t.app_id, t.line_no, t.analysis, t.url, CASE WHEN e.error IS NULL THEN o.output END AS output,
        e.error, e.error IS NULL AS ok
      FROM tasks t
      LEFT JOIN (SELECT DISTINCT 'doc://' || doc_id AS url FROM documents) d ON d.url = t.url
      LEFT JOIN outputs o ON o.url = t.url AND o.analysis = t.analysis,
      LATERAL (SELECT coalesce(t.error,
        CASE WHEN d.url IS NULL THEN 'document not available: ' || t.url END,
        CASE WHEN coalesce(o.output, '') = '' THEN 'empty annotation' END) AS error) e)"""

MANIFEST = f"WITH {_sql_manifest('lang')}"
TASKS = f"{MANIFEST}, {SQL_TASKS}"
STREAMED = f"WITH {_sql_manifest('source')}, {SQL_TASKS}"
LINES = f"WITH {SQL_SENTENCES}, {SQL_LINES}"
RESULTS = f"{TASKS}, {SQL_SENTENCES}, {SQL_LINES}, {SQL_RESULTS}"
STREAMED_RESULTS = f"{STREAMED}, {SQL_SENTENCES}, {SQL_LINES}, {SQL_RESULTS}"
HASHED = "SELECT app_id, line_no, analysis, url, md5(output) AS output, error, ok FROM results"


def _sql_lines(column: str) -> str:
    return f"""{LINES} SELECT url, sent_no, CAST(0 AS INTEGER) AS part_no, {column} AS line, error
        FROM lines"""


# Words of a sentence by Python's split: any Unicode white space, of which SQL knows its own list.
SQL_FAULTS = """wide AS (SELECT url, sent_no, sentence, list_filter(regexp_split_to_array(sentence,
        '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS w FROM sentences),
    pos AS (SELECT *, len(w) % 5 = 4 AS fine, len(w) // 2 AS half FROM wide)"""


def _sql_tagged(words: str, tag: str) -> str:
    return f"coalesce(list_aggregate(list_transform({words}, lambda x: x || '/{tag} '), 'string_agg', ''), '')"


SQL_FAULT_ROWS = f"""WITH {SQL_SENTENCES}, {SQL_FAULTS}
        SELECT url, sent_no, 'POS' AS analysis, 0 AS part_no,
               CASE WHEN fine THEN {_sql_tagged('w[1:half]', 'A')} END AS line, NOT fine AS failed FROM pos
        UNION ALL SELECT url, sent_no, 'POS', 1, {_sql_tagged('w[half + 1:]', 'B')}, false FROM pos WHERE fine
        UNION ALL SELECT url, sent_no, 'DEPENDENCY', 0, NULL, true FROM pos
        UNION ALL SELECT url, sent_no, 'CONSTITUENCY', 0, NULL, true FROM pos"""

ORACLES = {
    "stream_redelivery": f"{STREAMED_RESULTS} {HASHED}",
    "stream_completion": f"""{STREAMED}
        SELECT app_id, count(*) AS submitted, count(*) AS finished, CAST(0 AS BIGINT) AS outstanding,
               true AS done FROM tasks GROUP BY ALL""",
    "task_results_repeated_pages": f"{RESULTS} {HASHED}",
    "annotation_faults": SQL_FAULT_ROWS,
    "annotation_faults_batched": SQL_FAULT_ROWS,
    "manifest_parse": f"{MANIFEST} SELECT app_id, line_no, value FROM manifest",
    "task_validation": f"{TASKS} SELECT * FROM tasks",
    "task_resolve": """
        SELECT 'web' AS app_id, CAST(page_id * 2 AS BIGINT) AS line_no, 'POS' AS analysis, url,
               CAST(NULL AS VARCHAR) AS error, md5(html) AS text FROM pages
        UNION ALL
        SELECT 'web', CAST(page_id * 2 + 1 AS BIGINT), 'POS', url || '$gone',
               'document not available: ' || url || '$gone', NULL FROM pages""",
    "task_results": f"{RESULTS} {HASHED}",
    "task_summary": f"""{RESULTS}
        SELECT app_id, line_no, analysis, url, coalesce(error, output) AS result,
               error IS NOT NULL AS is_error FROM results""",
    "dedupe_results": f"""{TASKS}
        SELECT t.app_id, t.line_no, t.analysis, t.url, coalesce(t.error,
          CASE WHEN d.doc_id IS NULL THEN 'document not available: ' || t.url END) AS error
        FROM tasks t LEFT JOIN documents d ON 'doc://' || d.doc_id = t.url""",
    "app_progress": f"""{TASKS}
        SELECT app_id, count(*) AS submitted, count(*) FILTER (error IS NULL) AS finished,
               count(*) FILTER (error IS NOT NULL) AS outstanding,
               count(*) FILTER (error IS NOT NULL) = 0 AS done FROM tasks GROUP BY ALL""",
    "sentences": f"WITH {SQL_SENTENCES} SELECT url, sent_no, sentence FROM sentences",
    "pos_lines": _sql_lines("pos"),
    "dependency_lines": _sql_lines("dependency"),
    "constituency_lines": _sql_lines("tree"),
    "document_lines": f"""{LINES}
        SELECT url, coalesce(string_agg(pos || chr(10), '' ORDER BY sent_no), '') AS output,
               CAST(count(pos) AS INTEGER) AS n_lines, count(error) AS n_skipped
        FROM lines GROUP BY ALL""",
    "annotation_sink": f"""{LINES}
        SELECT analysis, url, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
        FROM per_analysis WHERE line IS NOT NULL GROUP BY ALL""",
    "stream_tasks": f"{STREAMED} SELECT * FROM tasks",
    "stream_results": f"{STREAMED_RESULTS} {HASHED}",
    "stream_results_store": f"{STREAMED_RESULTS} {HASHED}",
    "requested_pages_by_place": f"""{TASKS}
        SELECT DISTINCT url, md5(text) AS text FROM tasks JOIN documents ON url = 'doc://' || doc_id
        WHERE error IS NULL AND line_no % 3 = 1""",
    "stream_progress": f"{STREAMED} SELECT app_id, count(*) AS n_tasks FROM tasks GROUP BY ALL",
    "stream_progress_batches": f"{STREAMED} SELECT app_id, count(*) AS n_tasks FROM tasks GROUP BY ALL",
    "stream_progress_complete": f"""{STREAMED}
        SELECT app_id, count(*) AS n_tasks FROM tasks GROUP BY ALL""",
}
