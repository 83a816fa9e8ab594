"""Streams: what they keep, what they read, and what they refuse."""

import pytest
from checks.tasks import ANNOTATORS
from pyspark.sql import functions as F

from lexiloom.operators.tasks import file_blocks, has_places, parse_tasks, requested_pages
from lexiloom.plans.text_analysis import run_tasks
from lexiloom.session import folder_names
from lexiloom.sources.manifests import read_manifest
from lexiloom.sources.pages import PageStore, write_pages
from lexiloom.streaming import ledger
from lexiloom.streaming import tasks as S

SCHEMA = "app_id string, n long"


def total(rows):
    return rows.groupBy("app_id").agg(F.sum("n").alias("n"))


def app():
    return F.regexp_extract(F.col("file"), r"([^/]+)\.txt$", 1)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(f"doc://{i}", f"Page number {i} is here. It has two sentences.") for i in range(40)], "url string, text string")


def manifest(folder, name, urls):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.txt").write_text("".join(f"POS\tdoc://{u}\n" for u in urls))


def test_cover():
    for fan in (2, 3, 8):
        for number in range(300):
            held = [k for level, block in ledger.cover(number, fan) for k in range(block * fan**level, (block + 1) * fan**level)]
            assert held == list(range(number))
    # Two hundred batches read no more than a few blocks each.
    assert max(len(ledger.cover(n)) for n in range(201)) <= 16
    assert len(ledger.cover(4096)) == 1


def test_entries_are_merged_in_levels(spark, tmp_path):
    root = str(tmp_path / "ledger")
    for number in range(21):
        ledger.compact(spark, root, number, SCHEMA, total, fan=4)
        ledger.compact(spark, root, number, SCHEMA, total, fan=4)  # a repeated batch
        before = {r.app_id: r.n for r in total(ledger.read_before(spark, root, number, SCHEMA, fan=4)).collect()}
        assert before == ({"all": sum(range(number)), f"b{number - 1}": 1} if number else {}) | {f"b{k}": 1 for k in range(number)}
        ledger.append(spark.createDataFrame([("all", number), (f"b{number}", 1)], SCHEMA).coalesce(1), root, number)
        blocks = ledger.finished_blocks(spark, root, fan=4)
        assert blocks == ledger.cover(number + 1, 4) or len(blocks) <= 8
        assert total(ledger.read_blocks(spark, root, blocks, SCHEMA)).filter("app_id = 'all'").first().n == sum(range(number + 1))
    assert {name: len(folder_names(spark, f"{root}/{name}")) for name in folder_names(spark, root)} == {"level=0": 1, "level=1": 1, "level=2": 1}


def test_a_foreign_checkpoint_is_refused(spark, pages, tmp_path):
    box = tmp_path / "in"
    manifest(box, "a", [1, 2])
    out = str(tmp_path / "out")

    def run(state, out=out):
        S.start_results(S.stream_lines(spark, str(box), app()), pages, ANNOTATORS, out, str(tmp_path / state)).awaitTermination()

    run("one")
    manifest(box, "b", [3])
    with pytest.raises(ValueError, match="another checkpoint"):
        run("two")
    with pytest.raises(ValueError, match="another output"):
        run("one", str(tmp_path / "elsewhere"))
    assert {r.app_id for r in S.read_results(spark, out).collect()} == {"a"}
    run("one")
    assert sorted((r.app_id, r.line_no) for r in S.read_results(spark, out).collect()) == [("a", 0), ("a", 1), ("b", 0)]
    with pytest.raises(ValueError):
        S.start_progress(S.stream_lines(spark, str(box), app()), out, str(tmp_path / "three"))


def test_many_batches_keep_few_files(spark, pages, tmp_path):
    box, out = tmp_path / "in", str(tmp_path / "out")
    for k in range(18):
        manifest(box, f"app{k % 6}-{k}", [k, k + 1, k + 2])
    stream = S.stream_lines(spark, str(box), F.regexp_extract("file", r"(app\d)-", 1), files_per_trigger=1)
    S.start_results(stream, pages, {}, out, str(tmp_path / "state")).awaitTermination()
    # Two blocks of eight and two single ones, whatever came before.
    assert ledger.finished_blocks(spark, f"{out}/accepted") == [(1, 0), (1, 1), (0, 16), (0, 17)]
    assert len(folder_names(spark, f"{out}/accepted/level=0")) == 2
    # Files of one app bring the same line numbers: one result for each.
    results = S.read_results(spark, out)
    assert results.count() == results.select("app_id", "line_no").distinct().count() == 18
    states = {r.app_id: tuple(r)[1:] for r in S.app_states(spark, out).collect()}
    assert states == {f"app{k}": (3, 3, 0, True) for k in range(6)}


def test_states_while_a_batch_is_at_work(spark, tmp_path):
    out = str(tmp_path / "out")
    for number, (app_id, done) in enumerate([("a", True), ("b", True), ("a", False)]):
        rows = spark.createDataFrame([(app_id, k + 10 * number) for k in range(4)], "app_id string, line_no long")
        ledger.append(S.task_runs(rows), f"{out}/accepted", number, ["app_bucket"])
        if done:
            rows.write.parquet(f"{out}/results/batch={number}")
    states = {r.app_id: tuple(r)[1:] for r in S.app_states(spark, out).collect()}
    assert states == {"a": (8, 4, 4, False), "b": (4, 4, 0, True)}


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_progress_keeps_no_state(spark, tmp_path, mode):
    box, out = tmp_path / "in", str(tmp_path / "out")
    for k in range(10):
        manifest(box, f"app{k % 3}-{k}", range(k + 1))
    stream = S.stream_lines(spark, str(box), F.regexp_extract("file", r"(app\d)-", 1), files_per_trigger=1)
    query = S.start_progress(stream, out, str(tmp_path / "state"), mode)
    query.awaitTermination()
    assert not query.lastProgress["stateOperators"]
    totals = {f"app{a}": sum(k + 1 for k in range(a, 10, 3)) for a in range(3)}
    assert {r.app_id: r.n_tasks for r in S.latest_progress(spark, out).collect()} == totals
    last = {r.app_id: r.n_tasks for r in spark.read.parquet(f"{out}/batch=9").collect()}
    assert last == totals if mode == "complete" else len(last) == 1 and last.items() <= totals.items()
    assert folder_names(spark, f"{out}/counts/level=0") and len(folder_names(spark, f"{out}/counts/level=0")) <= 3


def test_runs(spark, rows, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 4)
    lines = [*range(11), 13, 14, 20]
    frame = spark.createDataFrame([("a", k) for k in lines] + [("b", 5)], "app_id string, line_no long")
    runs = S.task_runs(frame)
    assert rows(runs.filter("app_id = 'a'").select("first", "last")) == sorted([(0, 3), (4, 7), (8, 10), (13, 14), (20, 20)], key=repr)
    joined = S.join_runs(runs)
    assert rows(joined.select("app_id", "first", "last")) == sorted([("a", 0, 10), ("a", 13, 14), ("a", 20, 20), ("b", 5, 5)], key=repr)
    assert rows(S.join_runs(joined)) == rows(joined)


def test_a_manifest_of_several_splits(spark, pages, tmp_path, rows):
    box, out = tmp_path / "in", str(tmp_path / "out")
    manifest(box, "large", [k % 50 for k in range(4000)])
    (box / "other.txt").write_text("POS doc://1\r\nPOS\r\n\r\nbad line here\rPOS doc://2")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        S.start_tasks(S.stream_lines(spark, str(box), app()), out, str(tmp_path / "state")).awaitTermination()
        batch = parse_tasks(read_manifest(spark, str(box), app(), str(tmp_path)))
        assert spark.read.text(str(box)).rdd.getNumPartitions() > 4
        got = S.read_tasks(spark, out)
        assert rows(got.drop("arrived")) == rows(batch) and got.count() == 4005
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_page_store_is_read_by_prefix(spark, pages, tmp_path, rows):
    store = write_pages(pages.unionByName(pages.limit(5).withColumn("text", F.lit("Less"))), str(tmp_path / "store"), prefixes=16, files=2)
    assert rows(store.all().select("url")) == rows(pages.unionByName(pages.limit(5)).select("url"))
    wanted = spark.createDataFrame([("doc://7",), ("doc://8",), ("none",)], "url string")
    found = PageStore(spark, str(tmp_path / "store")).holding(wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(prefix" in plan or "PartitionFilters: [prefix" in plan
    folders = {r[0].split("prefix=")[1].split("/")[0] for r in found.select("_metadata.file_path").distinct().collect()}
    assert len(folders) <= 3 and {r.url for r in found.collect()} >= {"doc://7", "doc://8"}
    assert store.holding(wanted.limit(0)).count() == 0
    with pytest.raises(FileNotFoundError):
        PageStore(spark, str(tmp_path))
    manifest(tmp_path / "in", "a", [0, 7, 8, 99])
    tasks = parse_tasks(read_manifest(spark, str(tmp_path / "in"), app(), str(tmp_path)))
    assert rows(run_tasks(tasks, store, ANNOTATORS, work_dir=str(tmp_path))) == rows(run_tasks(tasks, store.all().select("url", "text"), ANNOTATORS, work_dir=str(tmp_path)))


def test_pages_by_place(spark, pages, tmp_path, rows):
    path = str(tmp_path / "pages")
    more = [(f"doc://{i}", t) for i in (3, 4, 5) for t in (None, "A", "Z")] + [("hot", f"text {k:03}") for k in range(60)] + [("none", None), (None, "x")]
    pages.unionByName(spark.createDataFrame(more, "url string, text string")).repartition(6).write.parquet(path)
    table = spark.read.parquet(path)
    wanted = [f"doc://{i}" for i in range(0, 60, 3)] + ["hot", "none", "gone"]
    tasks = spark.createDataFrame([("a", k, "POS", u, None) for k, u in enumerate(wanted * 2)] + [("a", 999, "POS", "doc://1", "bad")], "app_id string, line_no long, analysis string, url string, error string")
    expected = rows(requested_pages(tasks, table, str(tmp_path)))
    assert len(expected) == 15 and ("hot", "text 000") in expected and ("doc://3", "A") in expected
    late = requested_pages(tasks, table.select("url", "text").filter("url IS NOT NULL"), str(tmp_path), max_rows=7)
    assert rows(late) == expected
    # A table that is not read from files is joined by URL.
    made = spark.createDataFrame(table.collect(), table.schema)
    assert rows(requested_pages(tasks, made, str(tmp_path), max_rows=7)) == expected
    # Nor has a table of lines, or a join of two tables, places of its own.
    assert has_places(table) and has_places(table.select("url").filter("url > 'a'"))
    assert not any(map(has_places, (made, spark.read.text(path), table.join(table.select("url"), "url"), table.unionByName(table), table.groupBy("url").count())))
    none = tasks.filter("line_no < 0")
    assert requested_pages(none, table, str(tmp_path), max_rows=0).count() == 0 == requested_pages(none, table, str(tmp_path)).count()


def test_places_are_fetched_in_chunks_of_rows(spark, tmp_path, rows):
    path = str(tmp_path / "pages")
    made = spark.range(0, 90, 1, 2).select(F.array(F.concat(F.lit("a"), "id"), F.concat(F.lit("b"), F.col("id") % 60)).alias("urls"), F.concat(F.lit("t"), "id").alias("text"))
    made.write.parquet(path)
    # A row gives two URLs, of which one may be wanted, or both; some URLs have two rows.
    table = spark.read.parquet(path).select(F.explode("urls").alias("url"), "text")
    assert has_places(table)
    wanted = [f"a{i}" for i in range(0, 90, 2)] + [f"b{i}" for i in range(0, 60, 3)]
    tasks = spark.createDataFrame([("a", k, "POS", u, None) for k, u in enumerate(wanted)], "app_id string, line_no long, analysis string, url string, error string")
    found = requested_pages(tasks, table, str(tmp_path), max_rows=2)
    assert rows(found) == rows(requested_pages(tasks, table, str(tmp_path))) and found.count() == 65
    assert len(list(tmp_path.glob("wanted-pages-*/block=*"))) == 1


def test_no_text_is_shuffled_to_find_pages(spark, pages, tmp_path, monkeypatch):
    from lexiloom.operators import tasks as operators

    path = str(tmp_path / "pages")
    pages.write.parquet(path)
    seen = []
    real = operators.materialize
    monkeypatch.setattr(operators, "materialize", lambda df, *rest: (seen.append(df), real(df, *rest))[1])
    tasks = spark.createDataFrame([("a", 0, "POS", "doc://1", None), ("a", 1, "POS", "doc://2", None)], "app_id string, line_no long, analysis string, url string, error string")
    requested_pages(tasks, spark.read.parquet(path), str(tmp_path), max_rows=1).collect()
    assert len(seen) == 2
    for df in seen:
        assert "text#" not in df._jdf.queryExecution().executedPlan().toString()


def test_file_blocks():
    sizes = [("a", 3), ("b", 4), ("c", 25), ("d", 1), ("e", 9), ("f", 10)]
    blocks = list(file_blocks(sizes, 10))
    assert blocks == [(["a", "b"], 1, 0), (["c"], 3, 0), (["c"], 3, 1), (["c"], 3, 2), (["d", "e"], 1, 0), (["f"], 1, 0)]
    assert list(file_blocks([], 10)) == []


def test_deliveries_are_merged_without_moving_outputs(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 4)
    name = "IF(id % 2 = 0, 'a', 'b') AS app_id", "id AS line_no"
    first = spark.range(40).filter("id % 7 <> 3").selectExpr(*name, "concat('first ', id) AS output")
    second = spark.range(50).selectExpr(*name, "concat('second ', id) AS output")
    third = spark.range(45, 60).selectExpr(*name, "concat('third ', id) AS output")
    merged = S.merge_deliveries([first, second, third], str(tmp_path))
    which = ["first" if k < 40 and k % 7 != 3 else "second" if k < 50 else "third" for k in range(60)]
    assert rows(merged) == sorted([(("a", "b")[k % 2], k, f"{which[k]} {k}") for k in range(60)], key=repr)
    text = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("LeftAnti, BuildRight") == 2 and "SortMergeJoin" not in text and "Aggregate" not in text
    assert rows(S.merge_deliveries([first])) == rows(first)


def test_fetched_texts_are_written_once(spark, tmp_path, rows):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(f"doc://{i % 25}", f"t{i}") for i in range(30)], "url string, text string").write.parquet(path)
    table = spark.read.parquet(path)
    tasks = spark.createDataFrame([("a", k, "POS", f"doc://{k}", None) for k in range(20)], "app_id string, line_no long, analysis string, url string, error string")
    found = requested_pages(tasks, table, str(tmp_path), max_rows=3, written=True)
    assert rows(found) == rows(requested_pages(tasks, table, str(tmp_path), written=True))
    fetched, = tmp_path.glob("wanted-pages-*")
    (compared,) = tmp_path.glob("repeated-pages-*")
    assert spark.read.parquet(str(fetched)).count() == 25 and spark.read.parquet(str(compared)).count() == 5
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()
