"""What the physical plans must look like to hold at scale."""

import pytest
from checks import corpus, paths, tasks

from lexiloom.operators.collocations import join_counts
from lexiloom.operators.joins import SORTED_ROWS, lookup
from lexiloom.operators.similarity import mutual_information_scores, path_totals, slot_totals, word_totals
from lexiloom.operators.topk import top_k
from lexiloom.plans.collocations import collocations
from lexiloom.session import materialize, spread, work_path

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    """Every table counts as large, so nothing is broadcast because the tests are small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_collocations(spark, tmp_path, no_small_tables):
    df = collocations(
        corpus.bigrams(spark, SF), corpus.unigrams(spark, SF), k=5, work_dir=str(tmp_path)
    )
    text = plan(df)
    assert text.count("BroadcastHashJoin") == 1  # the counted totals
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text and "ArrowEval" not in text
    # The ranking drops rows before the shuffle by period, and again after it.
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    # Two levels of the ranking, each with a limit before its shuffle.
    assert ["Final" in line for line in limits] == [True, False, True, False]
    assert "Partial" in limits[1] and "Partial" in limits[3]
    # Both sides of a word join have an exchange directly below the sort, so that
    # partitions of a hot word can be split at run time.
    assert text.count("SortMergeJoin") == 2


def test_totals_beyond_the_bound_are_joined_with_salt(spark, tmp_path, no_small_tables, rows):
    pairs = spark.range(900).selectExpr(
        "'d' AS decade", "concat('a', id) AS w1", "concat('b', id) AS w2", "2L AS c12"
    )
    words = pairs.selectExpr("decade", "w1 AS word", "5L AS c").union(
        pairs.selectExpr("decade", "w2", "5L")
    )
    totals = spark.createDataFrame([("d", 9000), ("e", 1)], "decade string, n long")
    few = join_counts(pairs, words, totals)
    many = join_counts(pairs, words, totals, max_broadcast_rows=1)
    lazy = join_counts(pairs, words, totals, max_broadcast_rows=None)
    assert "Broadcast" in plan(few)
    for salted in (many, lazy):
        assert "Broadcast" not in plan(salted) and "_salt" in plan(salted)
        assert rows(salted) == rows(few)
    assert few.count() == 900


def test_corpus_scan_reads_two_columns(spark):
    text = plan(corpus.bigram_counts_query(spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "partial_sum" in text


def test_only_the_two_slots_are_broadcast(spark, no_small_tables):
    text = plan(paths.scores(spark, SF))
    joins = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
    assert joins and all("NestedLoop" not in line for line in joins)
    assert text.count("SortMergeJoin") >= 2 and "Cartesian" not in text


def test_similarity_never_pairs_within_a_word(spark, no_small_tables):
    text = plan(paths.pair_similarity_query(spark, SF))
    assert "Cartesian" not in text and "NestedLoop" not in text and "Broadcast" not in text


def test_task_results_has_no_forced_broadcast(spark, no_small_tables):
    text = plan(tasks.results(spark, SF))
    assert "Broadcast" not in text and "Cartesian" not in text


def test_skewed_word_join_is_split(spark, tmp_path, no_small_tables):
    """A third of all pairs share their first word; the run-time plan splits that partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        pairs = spark.range(60000, numPartitions=8).selectExpr(
            "'d' AS decade", "IF(id % 3 = 0, 'hot', concat('w', id % 500)) AS w1",
            "concat('v', id) AS w2", "1L AS count",
        )
        words = spark.range(60000).selectExpr("'d' AS decade", "concat('v', id) AS ngram", "1L AS count")
        firsts = spark.range(500).selectExpr("'d' AS decade", "concat('w', id) AS ngram", "40L AS count")
        hot = spark.range(1).selectExpr("'d' AS decade", "'hot' AS ngram", "20000L AS count")
        df = collocations(pairs, words.union(firsts).union(hot), k=10, work_dir=str(tmp_path))
        assert df.count() == 10
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_work_path_uses_the_shared_folder(spark, tmp_path):
    assert work_path(spark, "x", str(tmp_path)).startswith(str(tmp_path))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert work_path(spark, "x").startswith(shared.rstrip("/"))
    else:
        with pytest.raises(ValueError, match="needs a folder"):
            work_path(spark, "stage", run_id="r")
    assert work_path(spark, "x") != work_path(spark, "x")


def test_spread_leaves_large_scans_alone(spark):
    few, many = spark.range(10, numPartitions=1), spark.range(10, numPartitions=9)
    assert spread(few).rdd.getNumPartitions() == 4
    assert spread(many) is many


def test_a_ranking_has_a_bounded_last_step(spark):
    """Rows are limited before each of two shuffles; the last one gets k rows a part at most."""
    scored = spark.range(4000).repartition(40).selectExpr("CAST(id % 2 AS STRING) AS decade", "CAST(id AS STRING) AS w1", "'x' AS w2", "CAST(id % 97 AS DOUBLE) AS llr")
    best = top_k(scored, 5, "llr", ["decade"], ["w1", "w2"], parts=4)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = top_k(scored, 5, "llr", ["decade"], ["w1", "w2"], parts=4)
        found = [tuple(r) for r in rows.orderBy("decade", "rank").select("w1", "rank").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    expected = [sorted(str(i) for i in range(d, 4000, 2) if i % 97 == 96)[:5] for d in (0, 1)]
    assert found == [(w, k) for own in expected for k, w in enumerate(own, 1)]


def test_lines_are_made_without_a_formatter(spark):
    for df in (corpus.ngram_lines(spark, SF, 1), corpus.ngram_lines(spark, SF, 2), paths.biarc_lines(spark, SF)):
        assert "format_string" not in plan(df) and df.filter("value IS NULL").isEmpty()


def test_lines_of_two_folders_are_made_once(spark, monkeypatch):
    made, given = [], []
    real = corpus.ngram_lines
    monkeypatch.setattr(corpus, "ngram_lines", lambda spark, sf, n: (made.append(n), real(spark, sf, n))[1])

    def job(spark, pairs, words, *rest, **more):
        given.extend([pairs, words])
        raise InterruptedError

    monkeypatch.setattr(corpus, "collocation_job", job)
    with pytest.raises(InterruptedError):
        corpus.collocation_job_files(spark, SF)
    assert sorted(made) == [1, 2]
    for n, folders in ((2, given[0]), (1, given[1])):
        halves = [spark.read.text(folder).count() for folder in folders]
        assert len(halves) == 2 and all(halves) and sum(halves) == real(spark, SF, n).count()


def test_large_totals_of_paths_and_fillers_are_hashed(spark, tmp_path, no_small_tables):
    """Counts are not sorted for the joins with their totals; a hot filler is still split."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = SORTED_ROWS * 8 // 5
        spark.range(n, numPartitions=8).selectExpr(
            "concat('p', id) AS path", "'X' AS slot", "IF(id % 7 = 0, 'hot', concat('w', id)) AS word", "id % 5 + 1 AS n_psw"
        ).write.parquet(str(tmp_path / "counts"))
        counts = spark.read.parquet(str(tmp_path / "counts"))
        paths_ = materialize(path_totals(counts), "paths", str(tmp_path))
        words = materialize(word_totals(counts), "words", str(tmp_path))
        scores = mutual_information_scores(counts, paths_, words, slot_totals(words))
        found = scores.selectExpr("count(1)", "count(DISTINCT path)", "round(sum(mi), 3)").first()
        text = plan(scores)
        assert text.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in text
        scores.collect()
        assert "ShuffledHashJoin(skew=true)" in plan(scores)
        # Sorted, as for a few rows.
        sums = counts.selectExpr("*", "sum(n_psw) OVER (PARTITION BY path) AS p", "sum(n_psw) OVER (PARTITION BY word) AS w", "sum(n_psw) OVER () AS s")
        assert found == sums.selectExpr("count(1)", "count(DISTINCT path)", "round(sum(ln(n_psw * s / (p * w))), 3)").first()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_only_tables_that_fit_are_hashed(spark):
    """A hash table can not spill, so one with too many rows a partition is left to be sorted."""
    keys = spark.range(100)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = [lookup(keys, small, bound) is not keys for small, bound in ((99, 100), (100, 100), (99, 100 // partitions - 1))]
    assert hashed == [True, False, False]


def test_large_word_counts_are_hashed(spark, tmp_path, no_small_tables, rows):
    """Pairs are not sorted for the joins with the counts of their words."""
    n = SORTED_ROWS * 8 // 5
    words = materialize(spark.range(n).selectExpr("'d' AS decade", "concat('w', id) AS word", "id % 3 AS c"), "words", str(tmp_path))
    totals = spark.createDataFrame([("d", 9 * n)], "decade string, n long")
    pairs = spark.range(0, n, 500).selectExpr("'d' AS decade", "concat('w', id) AS w1", "concat('w', id + 1) AS w2", "1L AS c12")
    hashed, lazy = join_counts(pairs, words, totals), join_counts(pairs, words, totals, max_broadcast_rows=None)
    assert plan(hashed).count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan(hashed)
    assert "ShuffledHashJoin" not in plan(lazy)
    assert rows(hashed) == rows(lazy) and hashed.count() > 500
