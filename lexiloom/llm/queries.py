"""The registered query of every operator, with its production parameters, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    kneser_ney,
    licenses,
    line_dedup,
    maxent,
    minhash,
    phrases,
    quotes,
    suffix_dedup,
    token_counts,
    weak_labels,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.lm_scores(table(spark, sf_dir, "documents"))


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judge(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op6_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=80, recall=0.99
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=5, percent=85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_digests(docs, line_dedup.keep_bitmaps(docs, min_chars=40, min_docs=5))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), min_count=10, top=2000, absorb_percent=50)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), limit=512)


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_perplexity": op2_perplexity,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quotes": op4_quotes,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_weak_labels": op6_weak_labels,
    "op7_decontamination": op7_decontamination,
    "op8_licenses": op8_licenses,
    "op9_minhash": op9_minhash,
    "op10_line_dedup": op10_line_dedup,
    "op11_phrases": op11_phrases,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_counts": op13_token_counts,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: Lines of ``documents``, numbered, each with its key.
LINES_SQL = f"""lines AS (
  SELECT doc_id, pos, line, translate(trim(line, {SPACE_SQL}), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM docs))),
shared AS (SELECT key, max(doc_id) AS top FROM lines WHERE length(key) >= 40
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT lines.*, shared.key IS NOT NULL AND doc_id < top AS gone
           FROM lines LEFT JOIN shared USING (key))"""

#: Word lists of ``documents``, A-Z lower-cased.
WORDS_SQL = f"""words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM docs)"""

NEAR_SQL = f"""{WORDS_SQL},
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
           THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b USING (g)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
near AS (SELECT doc_id, len(s) AS n_shingles, low AS component_id
         FROM sets JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id))"""

def license_sql() -> str:
    """The licence scan with the same sentences and rules, a step per rule."""
    values = ", ".join(f"('{name}', '{text}')" for name, text in licenses.SENTENCES.items())
    steps, found = [], []
    for k, (name, own) in enumerate(licenses.RULES):
        rule = "," + ",".join(own) + ","
        steps.append(
            f"r{k + 1} AS (SELECT * EXCLUDE (s), replace(replace(s, '{rule}', ',|,'), '{rule}', ',|,') AS s, "
            f"contains(s, '{rule}') AS f{k} FROM r{k})"
        )
        found.append(f"CASE WHEN f{k} THEN '{name}' END")
    return rf"""WITH known(id, sentence) AS (VALUES {values}),
pieces AS (SELECT doc_id, unnest(p) AS piece, unnest(range(len(p))) AS i FROM (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(translate(coalesce(text, ''), chr(1), ' '),
    '([.!?;:])[ \t\r\n]+', '\1' || chr(1), 'g'), '\n[ \t\r]*\n', chr(1), 'g'), chr(1)) AS p FROM documents)),
lines AS (SELECT doc_id, i, unnest(l) AS sentence, unnest(range(len(l))) AS j FROM (
  SELECT doc_id, i, CASE WHEN contains(piece, chr(10)) THEN [piece] || string_split(piece, chr(10)) ELSE [piece] END AS l FROM pieces)),
hits AS (SELECT doc_id, i, j, id FROM lines JOIN known
         ON trim(regexp_replace(lower(lines.sentence), '[^a-z0-9]+', ' ', 'g')) = known.sentence),
r0 AS (SELECT doc_id, count(id) AS n, coalesce(string_agg(id, ',' ORDER BY i, j), '') AS ids,
       ',' || coalesce(string_agg(id, ',' ORDER BY i, j), '') || ',' AS s FROM documents LEFT JOIN hits USING (doc_id) GROUP BY doc_id),
{", ".join(steps)}
SELECT doc_id, n AS n_sentences, ids AS sentence_ids,
       array_to_string(list_filter([{", ".join(found)}], lambda x: x IS NOT NULL), ',') AS licenses FROM r{len(licenses.RULES)}"""


#: Quote linking in the same steps; quoted blocks are numbered runs of lines of one level.
QUOTES_SQL = r"""WITH RECURSIVE
msg AS (SELECT row_number() OVER () AS m, conv_id, turn, role,
  string_split(translate(coalesce(text, ''), chr(1) || chr(2) || chr(13), ''), chr(10)) AS l FROM conversations),
levelled AS (SELECT *, list_transform(l, lambda x: CASE WHEN regexp_matches(x, '^[ \t]*>')
    THEN length(regexp_extract(x, '^[ \t>]*')) - length(replace(regexp_extract(x, '^[ \t>]*'), '>', '')) ELSE 0 END) AS v FROM msg),
owned AS (SELECT *, regexp_replace(trim(array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: v[i] = 0
      AND NOT (coalesce(v[i + 1], 0) > 0 AND regexp_matches(l[i], '(?i)\b(wrote|schrieb|écrit|escribió) ?:[ \t]*$'))),
    lambda i: l[i]), chr(10)), chr(32) || chr(9) || chr(10)), '\n[ \t]*\n[ \t\n]*', chr(10) || chr(10), 'g') AS own FROM levelled),
line AS (SELECT m, conv_id, turn, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS x, unnest(v) AS lv FROM levelled),
flagged AS (SELECT *, CASE WHEN i = 1 OR lv <> lag(lv) OVER w
    OR trim(regexp_replace(lag(x) OVER w, '^[ \t>]*', ''), chr(32) || chr(9)) = '' THEN 1 ELSE 0 END AS new
  FROM line WINDOW w AS (PARTITION BY m ORDER BY i)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY m ORDER BY i) AS run FROM flagged),
block AS (SELECT m, conv_id, turn, run, any_value(lv) AS lv, trim(regexp_replace(lower(string_agg(
    CASE WHEN lv > 0 THEN regexp_replace(x, '^[ \t>]*', '') ELSE x END, chr(10) ORDER BY i)), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS p
  FROM numbered GROUP BY m, conv_id, turn, run),
origin AS (SELECT conv_id, p, min(turn) AS source FROM (SELECT conv_id, turn, p FROM block WHERE lv = 0
    UNION ALL SELECT conv_id, turn, trim(regexp_replace(lower(own), '[ \t\n\x0B\f\r]+', ' ', 'g')) FROM owned)
  WHERE p <> '' GROUP BY conv_id, p),
link AS (SELECT b.conv_id, b.turn, b.run, b.lv, o.source FROM block b JOIN origin o USING (conv_id, p)
  WHERE b.lv > 0 AND b.p <> '' AND o.source < b.turn),
parent AS (SELECT conv_id, turn, source AS parent FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn
  ORDER BY lv, source DESC) AS k FROM link) WHERE k = 1),
counted AS (SELECT conv_id, turn, count(DISTINCT run) AS quotes FROM link GROUP BY conv_id, turn),
chain(conv_id, turn, root, depth) AS (SELECT conv_id, turn, parent, 1::BIGINT FROM parent
  UNION ALL SELECT c.conv_id, c.turn, p.parent, c.depth + 1 FROM chain c JOIN parent p ON p.conv_id = c.conv_id AND p.turn = c.root),
top AS (SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM chain GROUP BY conv_id, turn)
SELECT o.conv_id, o.turn, o.role, p.parent, CASE WHEN o.conv_id IS NOT NULL THEN coalesce(t.root, o.turn) END AS root,
       coalesce(t.depth, 0) AS depth, coalesce(c.quotes, 0) AS quotes, o.own AS text
FROM owned o LEFT JOIN parent p ON p.conv_id = o.conv_id AND p.turn = o.turn
LEFT JOIN top t ON t.conv_id = o.conv_id AND t.turn = o.turn LEFT JOIN counted c ON c.conv_id = o.conv_id AND c.turn = o.turn"""


#: All phrases of up to three words, counted; phrases are lists of words.
PHRASES_SQL = f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
f AS (SELECT lang, p, count(*) AS a FROM (
        SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i])) AS p FROM lists UNION ALL
        SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) AS p FROM lists UNION ALL
        SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS p FROM lists) GROUP BY lang, p),
sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE len(p) = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE len(p) > 1 AND a >= 10),
held AS (SELECT lang, p, max(a) AS longer FROM (
           SELECT lang, p[1:2] AS p, a FROM c WHERE len(p) = 3 UNION ALL SELECT lang, p[2:3], a FROM c WHERE len(p) = 3) GROUP BY lang, p),
free AS (SELECT c.* FROM c LEFT JOIN held ON c.lang = held.lang AND c.p = held.p WHERE longer IS NULL OR len(c.p) = 3 OR 100 * longer < 50 * c.a),
cuts AS (SELECT free.lang, free.p, free.a, k, l.a AS l, r.a AS r, (1000000 * free.a::HUGEINT * free.a) // (l.a::HUGEINT * r.a) AS score
         FROM (SELECT *, unnest(range(1, len(p))) AS k FROM free) free
         JOIN f l ON l.lang = free.lang AND l.p = free.p[1:k] JOIN f r ON r.lang = free.lang AND r.p = free.p[k + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
named AS (SELECT *, array_to_string(p, ' ') AS phrase FROM lowest)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM named JOIN sizes USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000"""

#: Every anchor against every row; sums of integers are exact in doubles here.
NEGATIVES_SQL = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5"""


ORACLES = {
    "op4_quotes": QUOTES_SQL,
    "op8_licenses": license_sql(),
    "op9_minhash": f"""WITH RECURSIVE docs AS (SELECT doc_id, text FROM documents), {NEAR_SQL}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM near""",
    "op10_line_dedup": f"""WITH docs AS (SELECT doc_id, text FROM documents), {LINES_SQL}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op11_phrases": PHRASES_SQL,
    "op12_hard_negatives": NEGATIVES_SQL,
}
