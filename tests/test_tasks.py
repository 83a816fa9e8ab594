import pytest
from checks.tasks import ANNOTATORS
from pyspark.sql import functions as F

from lexiloom.operators.annotate import _EDGES, _TOKENS, Batched, _all, _Built, _cells, _list_array, annotate
from lexiloom.operators.sentences import (
    annotation_lines,
    dependency_lines,
    document_lines,
    pos_lines,
    sentences,
)
from lexiloom.operators.tasks import app_progress, asked_documents, dedupe_results, parse_tasks, task_summary
from lexiloom.plans.text_analysis import run_tasks, text_analysis_job
from lexiloom.sources.manifests import read_manifest, write_annotations
from lexiloom.streaming.tasks import read_results, start_results, stream_lines

MANIFEST = [
    "POS\tdoc://1",
    "DEPENDENCY    doc://2",
    "pos\tdoc://1",
    "ERROR\tdoc://1",
    "ERROR ERROR",
    "POS",
    "",
    "POS\tdoc://missing",
    "POS\tdoc://1",
    "POS\thttp://h/a$b",
    "CONSTITUENCY\tdoc://empty",
    "  POS  doc://1 with blank ",
]
DOCS = [
    ("doc://1", "Robin runs home. Wow!  Bye for now?"),
    ("doc://2", "John saw Mary today."),
    ("doc://empty", "No. No! a b c d e f g."),
    ("http://h/a$b", "It works fine"),
    ("doc://1 with blank", "Odd name here"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(DOCS, "url string, text string")


@pytest.fixture
def manifest(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.txt").write_text("\n".join(MANIFEST) + "\n")
    (folder / "two.txt").write_text("\r\n".join(MANIFEST[:3]))
    return str(folder)


def app():
    return F.regexp_extract(F.col("file"), r"([^/]+)\.txt$", 1)


def test_manifest_lines_and_errors(spark, manifest, tmp_path):
    tasks = parse_tasks(read_manifest(spark, manifest, app(), str(tmp_path)))
    got = {(r.app_id, r.line_no): (r.analysis, r.url, r.error) for r in tasks.collect()}
    assert len(got) == len(MANIFEST) + 3
    assert got["one", 0] == got["two", 0] == ("POS", "doc://1", None)
    assert got["one", 1] == got["two", 1] == ("DEPENDENCY", "doc://2", None)
    assert got["one", 2][2] == "unknown analysis: pos"
    assert got["one", 4] == ("ERROR", "ERROR", "unknown analysis: ERROR")
    assert got["one", 5][:2] == ("POS", "ERROR") and got["one", 5][2]
    assert got["one", 6][:2] == ("", "ERROR") and got["one", 6][2]
    assert got["one", 9] == ("POS", "http://h/a$b", None)
    assert got["one", 11] == ("POS", "doc://1 with blank", None)


def test_line_numbers_over_many_splits_and_files(spark, tmp_path):
    folder = tmp_path / "big"
    for letter in ("a", "b"):
        (folder / f"app={letter}").mkdir(parents=True)
        for part in range(3):
            text = "".join(f"{letter} {part * 5000 + i}\n" for i in range(5000))
            (folder / f"app={letter}" / f"part-{part}").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        name = F.regexp_extract("file", "app=([^/]+)/", 1)
        numbered = read_manifest(spark, str(folder), name, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(numbered) == 30000
    assert all(r.value == f"{r.app_id} {r.line_no}" for r in numbered)


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Hello there. Wow!  Bye now?", [(0, "Hello there"), (2, "Bye now")]),
        ("Wait... what?! Really now", [(2, "Really now")]),
        ("x" * 400, [(0, "x" * 400)]),
        ("x" * 401, []),
        ("", []),
        (None, []),
        ("one\ntwo lines", [(0, "one\ntwo lines")]),
    ],
)
def test_sentences(spark, text, expected):
    docs = spark.createDataFrame([(1, text)], "id int, text string")
    got = sentences(docs).orderBy("sent_no").collect()
    assert [(r.sent_no, r.sentence) for r in got] == expected


def test_lines_of_annotations(spark):
    df = spark.sql(
        "SELECT array(named_struct('word','Robin','tag','NNP'), named_struct('word','runs','tag','VBZ')) AS tokens,"
        "array(named_struct('pos',1,'rel','dobj','gov','saw','dep','Mary'),"
        "named_struct('pos',0,'rel','nsubj','gov','saw','dep','John')) AS edges"
    )
    assert pos_lines(df).head().line == "Robin/NNP runs/VBZ "
    assert dependency_lines(df).head().line == "nsubj(saw, John)\ndobj(saw, Mary)\n"


def test_an_annotator_may_find_several_sentences_and_is_built_once(spark, tmp_path):
    log = tmp_path / "built"

    def factory():
        with open(log, "a") as f:
            f.write("x")
        return lambda text: [f"(S {half})" for half in text.split("; ")]

    docs = spark.createDataFrame(
        [("CONSTITUENCY", 0, "a b; c d"), ("CONSTITUENCY", 1, "e f"), ("OTHER", 2, "g h")],
        "analysis string, sent_no int, sentence string",
    ).coalesce(1)
    found = annotate(docs, {"CONSTITUENCY": factory})
    lines = annotation_lines(found).withColumn("id", F.lit(1))
    got = document_lines(lines, ["id"]).head()
    assert (got.output, got.n_lines, got.n_skipped) == ("(S a b)\n(S c d)\n(S e f)\n", 3, 1)
    assert log.read_text() == "x"


def test_batches_are_halved_down_to_the_sentence_at_fault(spark, tmp_path):
    log = tmp_path / "calls"

    def factory():
        def run(texts):
            with open(log, "a") as f:
                f.write(f"{len(texts)}\n")
            if any("bad" in t for t in texts):
                raise ValueError("bad one")
            return [[[(w, "T") for w in t.split()]] for t in texts]

        return run

    texts = [f"sentence number {k}" + " and more" * (k % 5) for k in range(100)]
    texts[17] = "a bad one"
    docs = spark.createDataFrame([("POS", k, t) for k, t in enumerate(texts)], "analysis string, sent_no int, sentence string").coalesce(1)
    found = annotate(docs, {"POS": Batched(factory, 32)}).collect()
    assert [r.sent_no for r in found] == list(range(100)) and [r.sent_no for r in found if r.error] == [17]
    assert found[17].error == "ValueError: bad one"
    assert [t.word for t in found[5].tokens] == texts[5].split()
    calls = [int(x) for x in log.read_text().split()]
    # Four batches, and two halves for each of five levels around the bad sentence.
    assert calls[0] == 32 and len(calls) == 4 + 10
    short = annotate(docs, {"POS": Batched(lambda: lambda texts: [[]] * (len(texts) - 1), 10)}).collect()
    assert len(short) == 100 and all("0 results for 1" in r.error for r in short)
    none = annotate(docs, {"POS": Batched(lambda: 1 / 0)}).collect()
    assert len(none) == 100 and all("ZeroDivisionError" in r.error for r in none)


def kept_frames(error):
    """Frames that the traceback of an exception keeps alive."""
    n, at = 0, error.__traceback__
    while at is not None:
        n, at = n + 1, at.tb_next
    return n


def test_remembered_errors_keep_no_frames():
    error = KeyError("the same for every sentence")

    def annotator(sentence):
        raise error

    annotators = {"POS": lambda: annotator, "DEPENDENCY": lambda: 1 / 0}
    built, texts = _Built(annotators), ["a sentence"] * 500
    for analysis, name in (("POS", "KeyError"), ("DEPENDENCY", "ZeroDivisionError"), ("OTHER", "KeyError")):
        found = _all(built, annotators, [analysis] * len(texts), texts)
        assert [len(rows) for rows in found] == [1] * len(texts) and all(rows[0][-1].startswith(name) for rows in found)
    assert [kept_frames(e) for e in (error, built.done["DEPENDENCY"], built.done["OTHER"])] == [0, 0, 0]


def test_remembered_errors_of_batches_keep_no_frames():
    error = KeyError("the same for every batch")

    def annotator(sentences):
        raise error

    annotators = {"POS": Batched(lambda: annotator, 8), "DEPENDENCY": Batched(lambda: 1 / 0, 8)}
    built, texts = _Built(annotators), ["a sentence"] * 100
    for analysis, name in (("POS", "KeyError"), ("DEPENDENCY", "ZeroDivisionError")):
        found = _all(built, annotators, [analysis] * len(texts), texts)
        assert [len(rows) for rows in found] == [1] * len(texts) and all(rows[0][-1].startswith(name) for rows in found)
    assert [kept_frames(e) for e in (error, built.done["DEPENDENCY"])] == [0, 0]


def test_a_partition_of_sentences_does_not_grow_with_the_input(spark):
    docs = spark.range(0, 40_000, 1, 4).select(F.lit("POS").alias("analysis"), F.concat(F.lit("words "), F.sha2(F.col("id").cast("string"), 512)).alias("sentence"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        found = annotate(docs, {"POS": ANNOTATORS["POS"]}, 2)
        per_task = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sum(n for _, n in per_task) == 40_000 and max(n for _, n in per_task) < 10_000


def test_cells_become_arrays_of_structs():
    tokens = [_cells("POS", [("a", "A"), ("b", "B")])[0], None, _cells("POS", [])[0], _cells("POS", [("c", "C")])[0]]
    assert _list_array(tokens, _TOKENS).to_pylist() == [
        [{"word": "a", "tag": "A"}, {"word": "b", "tag": "B"}], None, [], [{"word": "c", "tag": "C"}]
    ]
    edges = [None, _cells("DEPENDENCY", [("r", "g", "d"), ("s", "h", "e")])[1], _cells("DEPENDENCY", [])[1]]
    assert _list_array(edges, _EDGES, numbered=True).to_pylist() == [
        None, [{"pos": 0, "rel": "r", "gov": "g", "dep": "d"}, {"pos": 1, "rel": "s", "gov": "h", "dep": "e"}], []
    ]
    for kind, numbered in ((_TOKENS, False), (_EDGES, True)):
        assert _list_array((), kind, numbered).to_pylist() == [] and _list_array([None], kind, numbered).to_pylist() == [None]


def test_run_tasks(spark, manifest, pages, tmp_path):
    tasks = parse_tasks(read_manifest(spark, manifest, app(), str(tmp_path)))
    results = run_tasks(tasks, pages, ANNOTATORS, partitions=3, work_dir=str(tmp_path))
    got = {(r.app_id, r.line_no): r for r in results.collect()}
    assert len(got) == len(MANIFEST) + 3
    assert got["one", 0].output == "Robin/5 runs/4 home/4 \nBye/3 for/3 now/3 \n"
    assert got["one", 8].output == got["two", 0].output == got["one", 0].output
    assert got["one", 1].output == "next(John, saw)\nnext(saw, Mary)\nnext(Mary, today)\n\n"
    assert got["one", 7].error == "document not available: doc://missing"
    assert got["one", 10].error == "empty annotation"
    assert got["one", 10].output is None and not got["one", 10].ok
    assert got["one", 9].output == "It/2 works/5 fine/4 \n"

    stored = spark.createDataFrame(list(got.values()), results.schema)
    twice = stored.unionByName(stored)
    assert dedupe_results(twice).count() == len(got)
    summary = {(r.app_id, r.line_no): r for r in task_summary(stored).collect()}
    assert summary["one", 6].is_error and summary["one", 6].result == got["one", 6].error
    assert not summary["one", 0].is_error and summary["one", 0].result == got["one", 0].output
    progress = {r.app_id: r for r in app_progress(tasks, twice.filter("app_id = 'two'")).collect()}
    assert (progress["one"].submitted, progress["one"].outstanding, progress["one"].done) == (12, 12, False)
    assert (progress["two"].finished, progress["two"].done) == (3, True)


def test_annotation_sink(spark, tmp_path, rows):
    lines = spark.createDataFrame(
        [("POS", f"doc://{d}", s, 0, f"{d}-{s}") for d in range(5) for s in range(4)],
        "analysis string, url string, sent_no int, part_no int, line string",
    )
    path = str(tmp_path / "out")
    write_annotations(lines, path, ["analysis"], ["url"], ["sent_no", "part_no"])
    back = spark.read.parquet(path).select(lines.columns)
    assert rows(back) == rows(lines)
    with pytest.raises(Exception, match="already exists"):
        write_annotations(lines, path, ["analysis"], ["url"], ["sent_no", "part_no"])


def test_stream_equals_batch_and_goes_on_after_a_stop(spark, manifest, pages, tmp_path, rows):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        start_results(
            stream_lines(spark, manifest, app()), pages, ANNOTATORS, out, state, str(tmp_path)
        ).awaitTermination()

    run()
    run()  # nothing new: nothing is done twice
    tasks = parse_tasks(read_manifest(spark, manifest, app(), str(tmp_path)))
    batch = run_tasks(tasks, pages, ANNOTATORS, work_dir=str(tmp_path))
    assert rows(read_results(spark, out)) == rows(batch)

    with open(f"{manifest}/three.txt", "w") as f:
        f.write("POS doc://1\n")
    run()
    late = read_results(spark, out).filter("app_id = 'three'").collect()
    assert len(late) == 1 and late[0].ok
    assert read_results(spark, out).count() == batch.count() + 1


def test_text_analysis_job(spark, manifest, pages, tmp_path):
    out = str(tmp_path / "results")
    results = text_analysis_job(spark, manifest, pages, ANNOTATORS, out, 2, str(tmp_path / "w"))
    assert results.count() == len(MANIFEST) + 3
    assert results.filter("app_id LIKE '%two.txt' AND ok").count() == 2


def test_no_line_or_output_of_a_task_alone_is_shuffled(spark, manifest, pages, tmp_path, monkeypatch):
    from lexiloom.plans import text_analysis

    seen = {}
    real = text_analysis.materialize
    monkeypatch.setattr(text_analysis, "materialize", lambda df, label, *rest: (seen.update({label: df}), real(df, label, *rest))[1])
    tasks = parse_tasks(read_manifest(spark, manifest, app(), str(tmp_path)))
    run_tasks(tasks, pages, ANNOTATORS, work_dir=str(tmp_path)).collect()
    plan = seen["outputs"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("MapInArrow")]
    alone = asked_documents(tasks).filter("line_no IS NOT NULL").count()
    assert 0 < alone < asked_documents(tasks).count()


@pytest.mark.parametrize("long_text", [0, 30])
def test_long_texts_give_the_same_results(spark, manifest, pages, tmp_path, rows, monkeypatch, long_text):
    from lexiloom.plans import text_analysis

    tasks = parse_tasks(read_manifest(spark, manifest, app(), str(tmp_path)))
    # An app without a name, and the same task twice.
    tasks = tasks.unionByName(tasks.withColumn("app_id", F.lit(None).cast("string"))).unionByName(tasks.limit(2))
    expected = rows(run_tasks(tasks, pages, ANNOTATORS, work_dir=str(tmp_path)))
    assert len(expected) == tasks.count()
    monkeypatch.setattr(text_analysis, "LONG_TEXT", long_text)
    assert rows(run_tasks(tasks, pages, ANNOTATORS, 2, str(tmp_path))) == expected


def test_dependency_lines_are_made_without_a_formatter(spark):
    edges = [(1, "dobj", "saw", None), (0, None, "%s", "J")]
    df = dependency_lines(spark.createDataFrame([(edges,), ([],), (None,)], "edges array<struct<pos:int,rel:string,gov:string,dep:string>>"))
    assert [row.line for row in df.collect()] == ["null(%s, J)\ndobj(saw, null)\n", "", None]
    assert "format_string" not in df._jdf.queryExecution().executedPlan().toString()
