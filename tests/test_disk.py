"""What the queries leave on disk: built lines and outputs are compressed, and large rows are not moved more often than needed."""

from pathlib import Path

import pytest
from checks import common, corpus, paths
from checks.tasks import ANNOTATORS
from pyspark.sql import functions as F

from lexiloom import session
from lexiloom.operators.topk import MAX_RANK, PARTS, top_k
from lexiloom.plans import text_analysis
from lexiloom.sources.manifests import write_annotations

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """A new folder for all that is written on the way."""
    real = session.work_path
    for module in (session, corpus, paths):
        monkeypatch.setattr(module, "work_path", lambda spark, label, root=None, run_id=None: real(spark, label, root or str(tmp_path), run_id))
    return tmp_path


def files(folder: Path, label: str) -> list[str]:
    return [str(p) for p in folder.glob(f"{label}-[0-9a-f]*/**/part-*")]


# Queries and the folders of lines that they build or write.
WRITTEN = {
    "collocation_job_files": ["lines1", "lines2", "job"],
    "biarc_parse": ["biarcs"],
    "normalize_paths": ["biarcs"],
    "extract_paths": ["biarcs"],
    "path_similarity_job": ["biarcs"],
    "collocations_tsv_roundtrip": ["scored-tsv"],
    "collocations_from_lines": ["lines1", "lines2"],
}


@pytest.mark.parametrize("name", WRITTEN)
def test_lines_are_compressed_in_files_of_bounded_length(spark, shared, monkeypatch, name):
    monkeypatch.setattr(common, "FILE_LINES", 2000)
    query = (corpus.QUERIES | paths.QUERIES)[name]
    assert not query(spark, SF).isEmpty()
    for label in WRITTEN[name]:
        found = [f for f in files(shared, label) if not f.endswith(".parquet")]
        assert found and all(f.endswith(".txt.gz") for f in found), label
        if label in ("lines1", "lines2", "biarcs"):
            assert max(spark.read.text(f).count() for f in found[:8]) <= 2000


@pytest.mark.parametrize("n", [1, 2])
def test_compressed_lines_are_the_built_lines(spark, tmp_path, n):
    built = corpus.ngram_lines(spark, SF, n)
    common.write_lines(built.withColumn("half", F.length("value") % 2), str(tmp_path / "out"), "half")
    back = spark.read.text([str(tmp_path / f"out/half={half}") for half in (0, 1)]).select("value")
    assert back.count() == built.count() and back.exceptAll(built).isEmpty()


def test_a_rank_without_bound_moves_rows_once(spark, rows):
    """Parts of a group bound nothing for such a ``k``."""
    df = spark.range(500).selectExpr("id % 3 AS g", "id % 7 AS score", "id")
    every, few = (top_k(df, k, "score", ["g"], ["id"]) for k in (MAX_RANK, 1000))
    assert plan(every).count("Exchange") == 1 and plan(few).count("Exchange") == 2
    assert "Exchange" not in plan(every.select("g", "id"))
    assert rows(every) == rows(few) and every.count() == 500
    assert plan(top_k(df, MAX_RANK // PARTS, "score", ["g"], ["id"])).count("Exchange") == 2


def test_key_of_parsed_lines_travels_as_one_string(spark, monkeypatch, rows, lines):
    text = ["b\ta/NN/nsubj/2 b/VBZ/ROOT/0\t3\t1990,1", "b\ta/NN/nsubj/2 b/VBZ/ROOT/0\t4", "b\t/NN/nsubj/0\t1", "\ta a/NN/x/1\t1", "\t/NN/x/1 c/d/NN/x/1\t1\t1990,2"]
    monkeypatch.setattr(paths, "biarcs", lambda spark, sf: paths.read_biarcs(spark, sf))
    monkeypatch.setattr(type(spark.read), "text", lambda self, path: lines(*text))
    df = paths.biarc_parse(spark, "")
    assert plan(df).count("hashpartitioning(_groupingexpression") == 1
    assert rows(df) == [("", " c/d", "NN NN", "1 1", 1, 2), ("b", "", "NN", "0", 1, 0), ("b", "a b", "NN VBZ", "2 0", 7, 1)]


def test_slot_counts_are_kept_by_the_smaller_codec(spark, shared):
    assert not paths.scores(spark, SF).isEmpty()
    found = files(shared, "counts")
    assert found and all(f.endswith(".zstd.parquet") for f in found)


@pytest.mark.parametrize("long_text", [1 << 16, 30, 0])
def test_lines_of_short_texts_are_written_where_they_are_made(spark, tmp_path, rows, monkeypatch, long_text):
    texts = [(f"doc://{d}", " ".join(f"Word {s} of text {d}." for s in range(d % 5 + 1))) for d in range(40)] + [("doc://no", None)]
    pages = spark.createDataFrame(texts, "url string, text string")
    asked = [(f"doc://{d}", analysis) for d in range(40) for analysis in list(ANNOTATORS)[: d % 3 + 1]] + [("doc://no", "POS")]
    wanted = spark.createDataFrame(asked, "url string, analysis string").withColumn("error", F.lit(None).cast("string"))
    monkeypatch.setattr(text_analysis, "LONG_TEXT", long_text)
    made = text_analysis.annotated_lines(wanted, pages, ANNOTATORS, 3)
    assert {r.together for r in made.select("together").distinct().collect()} == {1 << 16: {True}, 30: {True, False}, 0: {False}}[long_text]
    names = ["analysis", "url", "sent_no", "part_no", "line"]
    seen = []
    real = type(spark.range(1)).sortWithinPartitions
    monkeypatch.setattr(type(spark.range(1)), "sortWithinPartitions", lambda df, *keys: (seen.append(real(df, *keys)), seen[-1])[1])
    write_annotations(made.select(*names, "together"), str(tmp_path / "out"), ["analysis"], ["url"], ["sent_no", "part_no"], "together")
    # The branch of short texts has no exchange above the annotators, and neither branch is computed twice.
    text = plan(seen[0])
    assert text.count("MapInArrow") == 2
    assert text[: text.index("MapInArrow")].count("Exchange") == 0
    back = spark.read.parquet(str(tmp_path / "out"))
    per_sentence = [(a, u, s) for u, a in asked if u != "doc://no" for s in range(int(u[6:]) % 5 + 1)]
    assert sorted((r.analysis, r.url, r.sent_no) for r in back.collect()) == sorted(per_sentence)
    assert rows(back.select(names)) == rows(made.select(names))
    placed = back.select("*", F.input_file_name().alias("file")).groupBy("analysis", "url").agg(F.count_distinct("file").alias("n"))
    assert placed.filter("n > 1").isEmpty()
