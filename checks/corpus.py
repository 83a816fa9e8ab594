"""N-gram parsing, counting, joining, scoring, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from checks import common as c
from lexiloom.functions import clean_token, decade, is_stopword, register_functions
from lexiloom.functions.stopwords import remove_stopwords
from lexiloom.operators.collocations import finite_scores, join_counts, merge_counts
from lexiloom.operators.ngrams import (
    bigram_counts,
    parse_ngrams,
    period_totals,
    unigram_counts,
    unigram_counts_with_totals,
    valid_bigrams,
    valid_document_bigrams,
    valid_unigrams,
    with_decade,
)
from lexiloom.operators.topk import top_k
from lexiloom.plans.collocations import collocation_job, scored_collocations
from lexiloom.session import materialize, work_path
from lexiloom.sources.documents import (
    document_bigrams,
    document_unigrams,
    document_words,
    word_pairs,
)
from lexiloom.sources.ngrams import read_collocations, read_ngrams, write_tsv
from lexiloom.sources.sequencefile import read_sequence_files

K = 100


def raw_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    return with_decade(document_bigrams(c.dated_documents(spark, sf), ["year", "lang"]))


def raw_unigrams(spark: SparkSession, sf: str) -> DataFrame:
    return with_decade(document_unigrams(c.dated_documents(spark, sf), ["year", "lang"]))


def bigrams(spark: SparkSession, sf: str) -> DataFrame:
    docs = c.dated_documents(spark, sf)
    return with_decade(valid_document_bigrams(docs, ["year", "lang"], c.STOP))


def unigrams(spark: SparkSession, sf: str) -> DataFrame:
    return valid_unigrams(raw_unigrams(spark, sf), c.STOP)


# --- lines -------------------------------------------------------------------------------

# Forms of a line, chosen by document and position: most are good, some must be dropped.
# {g} n-gram, {y} year, {n} count.
LINE_FORMS = [
    "{g}\t{y}\t{n}\t3\t2",
    "{g}\t{y}\t{n}\t3",
    "{g}\t+{y}\t{n}\t1",
    "{g}\t{y}\t{n}",
    "{g}\t{y}\t{n}\t",
    "{g}\t {y}\t{n}\t1",
    "{g}\t{y}\t{n}.5\t1",
    "{g}\t{y}\t3000000000\t1",
    " {g}\t{y}\t{n}\t1",
    "{g}\t{y}\t{n}\tx\t\t",
    "{g}",
    "",
]


def _sql_line(form: str) -> str:
    text = "'" + form.replace("\t", "' || chr(9) || '") + "'"
    for mark, column in (("{g}", "g"), ("{y}", "year"), ("{n}", "n")):
        text = text.replace(mark, f"' || {column} || '")
    return text


def ngram_lines(spark: SparkSession, sf: str, n: int) -> DataFrame:
    """One line per word (pair) of every document, in one of the forms above."""
    words = document_words(c.dated_documents(spark, sf), ["doc_id", "year"])
    grams = word_pairs("words") if n == 2 else F.col("words")
    rows = words.select("doc_id", "year", F.posexplode(grams).alias("i", "g"))
    if n == 2:
        rows = rows.withColumn("g", F.concat_ws(" ", "g.w1", "g.w2"))
    rows = rows.withColumn("n", F.col("i") % 4 + 1)
    form = (F.col("doc_id") + F.col("i")) % len(LINE_FORMS)
    line = F.lit(None).cast("string")
    for number, text in enumerate(LINE_FORMS):
        line = F.when(form == number, c.filled(text, "g y n")).otherwise(line)
    return rows.withColumnRenamed("year", "y").select(line.alias("value"))


def ngram_parse(spark: SparkSession, sf: str, n: int) -> DataFrame:
    path = work_path(spark, f"lines{n}")
    c.write_lines(ngram_lines(spark, sf, n), path)
    parsed = parse_ngrams(read_ngrams(spark, path), n)
    return parsed.groupBy("ngram", "year").agg(
        F.sum("count").alias("total"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("pages").alias("pages"),
    )


def _sql_parse(n: int) -> str:
    forms = " ".join(f"WHEN {i} THEN {_sql_line(f)}" for i, f in enumerate(LINE_FORMS))
    gram = "r1" if n == 1 else "r1 || ' ' || r2"
    lists = "unnest(t) AS r1" if n == 1 else "unnest(t[1:len(t) - 1]) AS r1, unnest(t[2:]) AS r2"
    line = (
        r"rtrim(line, chr(9))"
        if n == 2
        else r"regexp_replace(line, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
    )
    fields = 4 if n == 2 else 3
    number = r"regexp_full_match(f[{0}], '[+-]?[0-9]+')"
    words = "AND len(regexp_split_to_array(f[1], '[ \\t\\n\\r]+')) = 2" if n == 2 else ""
    return rf"""WITH {c.sql_words()},
    pos AS (SELECT doc_id, year, unnest(range(0, len(t) - {n - 1})) AS i, {lists}
            FROM docs WHERE len(t) >= {n}),
    src AS (SELECT doc_id, i, year, i % 4 + 1 AS n, {gram} AS g FROM pos),
    lines AS (SELECT CASE (doc_id + i) % {len(LINE_FORMS)} {forms} END AS line FROM src),
    parts AS (SELECT string_split({line}, chr(9)) AS f FROM lines),
    good AS (SELECT f[1] AS ngram, try_cast(f[2] AS INTEGER) AS year, try_cast(f[3] AS INTEGER) AS cnt,
               CASE WHEN {number.format(4)} THEN try_cast(f[4] AS BIGINT) END AS pages
             FROM parts WHERE len(f) >= {fields} AND {number.format(2)} AND {number.format(3)} {words})
    SELECT ngram, year, CAST(sum(cnt) AS BIGINT) AS total, count(*) AS n_lines,
           CAST(sum(pages) AS BIGINT) AS pages
    FROM good WHERE year IS NOT NULL AND cnt IS NOT NULL GROUP BY ALL"""


def sequencefile_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Word lines written as a SequenceFile with long keys, read back and counted."""
    lines = ngram_lines(spark, sf, 1).select("value").filter(F.col("value") != "")
    path = work_path(spark, "sequence")
    # Keys beyond 32 bits, so that they are written as longs.
    first = 1 << 33
    lines.withColumn("k", F.monotonically_increasing_id() + first).select("k", "value").rdd.map(
        tuple
    ).saveAsSequenceFile(path)
    parsed = parse_ngrams(read_ngrams(spark, path, "sequence"), 1)
    return parsed.groupBy("ngram", "year").agg(F.sum("count").alias("total"))


def sequencefile_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same lines in block-compressed SequenceFiles, read in many splits."""
    lines = ngram_lines(spark, sf, 1).select("value").filter(F.col("value") != "")
    path, option = work_path(spark, "sequence"), "mapreduce.output.fileoutputformat.compress"
    first = 1 << 33
    lines.withColumn("k", F.monotonically_increasing_id() + first).select("k", "value").rdd.map(
        tuple
    ).saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.Text",
        conf={option: "true", f"{option}.type": "BLOCK", f"{option}.codec": "org.apache.hadoop.io.compress.DefaultCodec"},
    )
    parsed = parse_ngrams(read_sequence_files(spark, [path], split_bytes=100_000), 1)
    return parsed.groupBy("ngram", "year").agg(F.sum("count").alias("total"))


# --- cleaning, stop words, counts ----------------------------------------------------------


def clean_tokens(spark: SparkSession, sf: str) -> DataFrame:
    words = raw_unigrams(spark, sf).groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))
    token = clean_token(F.col("ngram")).alias("token")
    return words.select(token, "n").groupBy("token").agg(F.sum("n").alias("n"))


def valid_bigram_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = valid_bigrams(raw_bigrams(spark, sf), c.STOP)
    return rows.groupBy("lang", "w1", "w2").agg(F.count(F.lit(1)).alias("n"))


def stopword_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Literal lists and the anti join against a stop table must leave the same words."""
    words = raw_unigrams(spark, sf).groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))
    listed = [(w, True) for w in c.STOP.folded] + [(w, False) for w in c.STOP.exact]
    stop = spark.createDataFrame(listed, "word string, folded boolean")
    return remove_stopwords(words, "ngram", stop).select(
        F.col("ngram").alias("word"), "n", is_stopword(F.col("ngram"), c.STOP).alias("is_stop")
    )


def decade_bucket(spark: SparkSession, sf: str) -> DataFrame:
    years = c.dated_documents(spark, sf).select((F.col("year") - 1950).alias("offset"), "year")
    return years.groupBy(
        decade(F.col("year")).alias("decade"), decade(F.col("offset")).alias("offset_decade")
    ).agg(F.count(F.lit(1)).alias("n"))


def bigram_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    return bigram_counts(bigrams(spark, sf))


def unigram_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    return unigram_counts(unigrams(spark, sf))


def decade_totals(spark: SparkSession, sf: str) -> DataFrame:
    return period_totals(unigram_counts(unigrams(spark, sf)))


def unigram_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return unigram_counts_with_totals(unigrams(spark, sf))


# --- scores ----------------------------------------------------------------------------------


def _rounded(df: DataFrame) -> DataFrame:
    # Engines differ in the last bits of ln, so both sides compare and rank rounded scores.
    return df.withColumn("llr", F.round("llr", 6))


def collocation_join(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the halves of the corpus from outside: repeated keys are summed again."""
    words = unigram_counts(unigrams(spark, sf).withColumn("half", F.length("lang")))
    words = materialize(merge_counts(words.unionAll(words), ["decade", "word"], "c"), "words")
    totals = materialize(period_totals(words), "totals")
    return join_counts(bigram_counts(bigrams(spark, sf)), words, totals)


def llr_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(scored_collocations(bigrams(spark, sf), unigrams(spark, sf)))


def _topk(scored: DataFrame, period: str) -> DataFrame:
    best = top_k(_rounded(scored), K, "llr", [period], ["w1", "w2"])
    return best.select(period, "w1", "w2", "llr", "rank")


def collocations_topk(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_collocations(bigrams(spark, sf), unigrams(spark, sf))
    return _topk(scored, "decade")


def collocations_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_collocations(
        bigrams(spark, sf), unigrams(spark, sf), period="lang"
    )
    return _topk(scored, "lang")


def collocations_checkpointed(spark: SparkSession, sf: str) -> DataFrame:
    """Every stage written and read back, the score table included."""
    scored = scored_collocations(
        bigrams(spark, sf), unigrams(spark, sf), stages="all"
    )
    return _topk(scored, "decade")


def collocations_fused(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_collocations(
        bigrams(spark, sf), unigrams(spark, sf), stages="none"
    )
    return _topk(scored, "decade")


def collocations_tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Scored pairs through text files: sorted write, tolerant read, ranking."""
    scored = scored_collocations(bigrams(spark, sf), unigrams(spark, sf))
    path = work_path(spark, "scored-tsv")
    columns = ["decade", "w1", "w2", "llr", "c12", "c1", "c2"]
    write_tsv(scored, path, columns, order=["decade", F.desc("llr"), "w1", "w2"], compression="gzip")
    read = finite_scores(read_collocations(spark, path))
    best = top_k(_rounded(read), K, "llr", ["decade"], ["w1", "w2"])
    return best.select("decade", "w1", "w2", "llr", "c12", "c1", "c2", "rank")


def collocations_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way from n-gram line files, as a corpus of n-gram lines is delivered."""
    folders = {}
    for n in (1, 2):
        folders[n] = work_path(spark, f"lines{n}")
        c.write_lines(ngram_lines(spark, sf, n), folders[n])
    scored = scored_collocations(
        with_decade(valid_bigrams(parse_ngrams(read_ngrams(spark, [folders[2]]), 2), c.STOP)),
        with_decade(valid_unigrams(parse_ngrams(read_ngrams(spark, [folders[1]]), 1), c.STOP)),
    )
    return _topk(scored, "decade")


def collocation_job_files(spark: SparkSession, sf: str) -> DataFrame:
    """The job itself, two folders of each kind, all pairs; ``ordered`` is the order in the files."""
    folders: dict[int, list[str]] = {}
    for n in (1, 2):
        root = work_path(spark, f"lines{n}")
        halves = ngram_lines(spark, sf, n).withColumn("half", F.pmod(F.xxhash64("value"), F.lit(2)))
        c.write_lines(halves, root, "half")
        folders[n] = [f"{root}/half={half}" for half in (0, 1)]
    out, work = work_path(spark, "job"), work_path(spark, "job-stages")
    every = 2**31 - 1
    folder = collocation_job(
        spark, folders[2], folders[1], out, c.STOP, k=every, work_dir=work, run_id="run-1", compression="gzip"
    )
    fields = F.split("value", "\t")
    rows = spark.read.text(folder).select(
        fields[0].alias("decade"),
        fields[1].alias("w1"),
        fields[2].alias("w2"),
        fields[3].cast("double").alias("llr"),
        # The number of the part; the whole name in every row would be shuffled.
        F.split(F.col("_metadata.file_name"), "-")[1].cast("int").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    place = Window.partitionBy("decade").orderBy("file", "block", "seq")
    ordered = F.coalesce(F.lag("llr").over(place) >= F.col("llr"), F.lit(True))
    return _rounded(rows.select("decade", "w1", "w2", "llr", ordered.alias("ordered")))


def tsv_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Scored lines of which most are broken: bad scores, missing fields, bad counts."""
    id_ = F.col("doc_id").cast("string")
    start = [F.lit("1990s"), F.concat(F.lit("a"), id_), F.lit("b")]
    ends = [
        [F.lit("2.5"), F.lit("3"), F.lit("4"), F.lit("5")],
        [F.lit("NaN")],
        [F.lit("Infinity"), F.lit("1")],
        [],
        [F.lit("-1e3"), F.lit("x"), F.lit("9223372036854775808"), F.lit("")],
        [F.lit("1,5")],
        [F.lit(" 7 "), F.lit("-2")],
    ]
    kinds = F.array(*(F.concat_ws("\t", *start, *end) for end in ends))
    docs = c.table(spark, sf, "documents")
    lines = docs.select(F.get(kinds, (F.col("doc_id") % 7).cast("int")).alias("value"))
    path = work_path(spark, "bad-lines")
    lines.write.text(path)
    return read_collocations(spark, path)


def stopword_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Raw words, stop words and others, by the column and by the SQL function."""
    register_functions(spark, c.STOP)
    words = raw_unigrams(spark, sf).select(F.col("ngram").alias("word")).distinct()
    return words.select(
        "word",
        is_stopword(F.col("word"), c.STOP).alias("is_stop"),
        F.expr("is_stopword(word)").alias("is_stop_sql"),
    )


def sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    """The registered SQL functions over the counted pairs."""
    register_functions(spark, c.STOP)
    words = materialize(unigram_counts(unigrams(spark, sf)), "words")
    totals = materialize(period_totals(words), "totals")
    joined = join_counts(bigram_counts(bigrams(spark, sf)), words, totals)
    return joined.selectExpr(
        "decade",
        "w1",
        "w2",
        "round(llr(c12, c1, c2, n), 6) AS llr",
        "clean_token(concat(w1, '-', w2)) AS joined",
        "is_stopword(concat(' ', w1)) AS is_stop",
        "decade(cast(c12 AS int)) AS c12_bucket",
    )


QUERIES = {
    "collocation_job_files": collocation_job_files,
    "tsv_bad_lines": tsv_bad_lines,
    "stopword_flags": stopword_flags,
    "ngram_parse_bigram": lambda spark, sf: ngram_parse(spark, sf, 2),
    "ngram_parse_unigram": lambda spark, sf: ngram_parse(spark, sf, 1),
    "sequencefile_roundtrip": sequencefile_roundtrip,
    "sequencefile_blocks": sequencefile_blocks,
    "clean_tokens": clean_tokens,
    "valid_bigrams": valid_bigram_rows,
    "stopword_filter": stopword_filter,
    "decade_bucket": decade_bucket,
    "bigram_counts": bigram_counts_query,
    "unigram_counts": unigram_counts_query,
    "decade_totals": decade_totals,
    "unigram_grouping_sets": unigram_grouping_sets,
    "collocation_join": collocation_join,
    "llr_scores": llr_scores,
    "collocations_topk": collocations_topk,
    "collocations_by_lang": collocations_by_lang,
    "collocations_checkpointed": collocations_checkpointed,
    "collocations_fused": collocations_fused,
    "collocations_tsv_roundtrip": collocations_tsv_roundtrip,
    "collocations_from_lines": collocations_from_lines,
    "sql_functions": sql_functions,
}


def _with(*parts: str) -> str:
    return "WITH " + ",\n    ".join(parts)


BASE = _with(c.sql_words(), c.SQL_RAW, c.SQL_BI, c.SQL_UNI)


def _sql_counts(period: str, times: int = 1) -> str:
    return f"""bc AS (SELECT {period}, w1, w2, count(*) AS c12 FROM bi GROUP BY ALL),
    uc AS (SELECT {period}, word, count(*) * {times} AS c FROM uni GROUP BY ALL),
    tot AS (SELECT {period}, CAST(sum(c) AS BIGINT) AS n FROM uc GROUP BY ALL),
    joined AS (SELECT bc.{period}, w1, w2, c12, u1.c AS c1, u2.c AS c2, n
      FROM bc JOIN uc u1 ON u1.{period} = bc.{period} AND u1.word = w1
              JOIN uc u2 ON u2.{period} = bc.{period} AND u2.word = w2
              JOIN tot ON tot.{period} = bc.{period}),
    scored AS (SELECT *, round({c.sql_llr()}, 6) AS llr FROM joined)"""


def _sql_topk(period: str, more: str = "") -> str:
    return f"""{BASE}, {_sql_counts(period)}
    SELECT {period}, w1, w2, llr, {more} CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY {period} ORDER BY llr DESC, w1, w2) AS rank FROM scored)
    WHERE rank <= {K}"""


def _sql_from_lines() -> str:
    parsed = []
    for n in (1, 2):
        body = _sql_parse(n).removeprefix("WITH ").strip()
        parsed.append(f"p{n} AS (WITH {body})")
    return f"""WITH {parsed[0]}, {parsed[1]},
    bi AS (SELECT * FROM (SELECT {c.SQL_DECADE} AS decade, total,
             {c.sql_clean("split_part(ngram, ' ', 1)")} AS w1, {c.sql_clean("split_part(ngram, ' ', 2)")} AS w2
           FROM p2) WHERE {c.sql_valid('w1')} AND {c.sql_valid('w2')}),
    bc AS (SELECT decade, w1, w2, CAST(sum(total) AS BIGINT) AS c12 FROM bi GROUP BY ALL),
    uc AS (SELECT {c.SQL_DECADE} AS decade, ngram AS word, CAST(sum(total) AS BIGINT) AS c FROM p1
           WHERE NOT {c.sql_is_stop('ngram')} GROUP BY ALL),
    tot AS (SELECT decade, CAST(sum(c) AS BIGINT) AS n FROM uc GROUP BY ALL),
    joined AS (SELECT bc.decade, w1, w2, c12, u1.c AS c1, u2.c AS c2, n
      FROM bc JOIN uc u1 ON u1.decade = bc.decade AND u1.word = w1
              JOIN uc u2 ON u2.decade = bc.decade AND u2.word = w2
              JOIN tot ON tot.decade = bc.decade),
    scored AS (SELECT *, round({c.sql_llr()}, 6) AS llr FROM joined)
    SELECT decade, w1, w2, llr, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY decade ORDER BY llr DESC, w1, w2) AS rank FROM scored)
    WHERE rank <= {K}"""


ORACLES = {
    "collocation_job_files": _sql_from_lines().rpartition("SELECT decade, w1, w2, llr, CAST(rank")[0]
    + "SELECT decade, w1, w2, llr, true AS ordered FROM scored",
    "tsv_bad_lines": """
        SELECT '1990s' AS decade, 'a' || doc_id AS w1, 'b' AS w2,
               CASE doc_id % 7 WHEN 0 THEN 2.5e0 WHEN 4 THEN -1e3 ELSE 7e0 END AS llr,
               CAST(CASE doc_id % 7 WHEN 0 THEN 3 WHEN 6 THEN -2 ELSE -1 END AS BIGINT) AS c12,
               CAST(CASE doc_id % 7 WHEN 0 THEN 4 ELSE -1 END AS BIGINT) AS c1,
               CAST(CASE doc_id % 7 WHEN 0 THEN 5 ELSE -1 END AS BIGINT) AS c2
        FROM documents WHERE doc_id % 7 IN (0, 4, 6)""",
    "stopword_flags": f"""{BASE} SELECT DISTINCT word, {c.sql_is_stop('word')} AS is_stop,
        {c.sql_is_stop('word')} AS is_stop_sql FROM raw_uni""",
    "ngram_parse_bigram": _sql_parse(2),
    "ngram_parse_unigram": _sql_parse(1),
    "sequencefile_roundtrip": f"SELECT ngram, year, total FROM ({_sql_parse(1)})",
    "sequencefile_blocks": f"SELECT ngram, year, total FROM ({_sql_parse(1)})",
    "clean_tokens": f"""{BASE} SELECT {c.sql_clean('word')} AS token, count(*) AS n
        FROM raw_uni GROUP BY ALL""",
    "valid_bigrams": f"{BASE} SELECT lang, w1, w2, count(*) AS n FROM bi GROUP BY ALL",
    "stopword_filter": f"""{BASE} SELECT word, count(*) AS n, false AS is_stop FROM uni GROUP BY ALL""",
    "decade_bucket": f"""{BASE} SELECT (year // 10 * 10) || 's' AS decade,
        (trunc((year - 1950) / 10)::INTEGER * 10) || 's' AS offset_decade, count(*) AS n
        FROM docs GROUP BY ALL""",
    "bigram_counts": f"{BASE} SELECT decade, w1, w2, count(*) AS c12 FROM bi GROUP BY ALL",
    "unigram_counts": f"{BASE} SELECT decade, word, count(*) AS c FROM uni GROUP BY ALL",
    "decade_totals": f"{BASE} SELECT decade, count(*) AS n FROM uni GROUP BY ALL",
    "unigram_grouping_sets": f"""{BASE} SELECT decade, word, count(*) AS c,
        CAST(grouping(word) AS INTEGER) AS is_total
        FROM uni GROUP BY GROUPING SETS ((decade, word), (decade))""",
    "collocation_join": f"{BASE}, {_sql_counts('decade', 2)} SELECT * FROM joined",
    "llr_scores": f"""{BASE}, {_sql_counts('decade')}
        SELECT decade, w1, w2, llr, c12, c1, c2 FROM scored""",
    "collocations_topk": _sql_topk("decade"),
    "collocations_by_lang": _sql_topk("lang"),
    "collocations_checkpointed": _sql_topk("decade"),
    "collocations_fused": _sql_topk("decade"),
    "collocations_tsv_roundtrip": _sql_topk("decade", "c12, c1, c2,"),
    "collocations_from_lines": _sql_from_lines(),
    "sql_functions": f"""{BASE}, {_sql_counts('decade')}
        SELECT decade, w1, w2, llr, w1 || w2 AS joined, false AS is_stop,
               (c12 // 10 * 10) || 's' AS c12_bucket FROM scored""",
}
