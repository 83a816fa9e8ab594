import pytest
from pyspark.sql import functions as F

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
from lexiloom.sources.documents import document_bigrams
from lexiloom.sources.ngrams import read_ngrams

BIGRAM_LINES = [
    "Robin Hood\t1561\t4\t3\t2",
    "Robin Hood\t1569\t6\t3\t2",
    "thou art\t1560\t5\t1",
    "Thou art\t1560\t2\t1",
    'Rob-in "Hood"\t1561\t1\t1',
    "the Hood\t1561\t9\t1",
    "THE Hood\t1561\t9\t1",
    "של בית\t1561\t9\t1",
    "בית דין\t1561\t9\t1",
    "1984 Hood\t1984\t9\t1",
    "١٢ Hood\t1984\t9\t1",
    "--- Hood\t1984\t9\t1",
    "Hood\t1984\t9\t1",
    "a b c\t1984\t9\t1",
    " x y\t1984\t9\t1",
    "Robin Hood\t1984\t9",
    "Robin Hood\t1984\t9\t",
    "Robin Hood\t+1984\t9\t1",
    "Robin Hood\t 1984\t9\t1",
    "Robin Hood\t1984\t9.5\t1",
    "Robin Hood\t1984\t3000000000\t1",
]
UNIGRAM_LINES = [
    "Hood\t1561\t40\t3",
    "Hood\t1561\t40",
    ' "Hood"\t1561\t2\t1 ',
    "The\t1561\t900\t3",
    "1984\t1984\t7\t1",
    ".\t1984\t7\t1",
    "",
    "   ",
    "Hood\t1561",
]


def test_bigram_lines(lines, stop, rows):
    parsed = parse_ngrams(lines(*BIGRAM_LINES), 2)
    counts = bigram_counts(with_decade(valid_bigrams(parsed, stop)))
    assert rows(counts) == sorted(
        [
            ("1560s", "Robin", "Hood", 11),
            ("1560s", "Thou", "art", 2),
            ("1560s", "thou", "art", 5),
            ("1560s", "בית", "דין", 9),
            ("1980s", "Robin", "Hood", 9),
            ("1980s", "١٢", "Hood", 9),
        ],
        key=repr,
    )


def test_white_space_after_a_pair_is_harmless(lines):
    parsed = parse_ngrams(lines("a  b \t1984\t1\t1"), 2).head()
    assert (parsed.w1, parsed.w2) == ("a", "b")


def test_unigram_lines(lines, stop, rows):
    parsed = with_decade(valid_unigrams(parse_ngrams(lines(*UNIGRAM_LINES), 1), stop))
    counts = unigram_counts(parsed)
    assert rows(counts) == sorted(
        [("1560s", '"Hood"', 2), ("1560s", "Hood", 80), ("1980s", "1984", 7)], key=repr
    )
    assert rows(period_totals(counts)) == [("1560s", 82), ("1980s", 7)]
    both = unigram_counts_with_totals(parsed)
    assert rows(both.filter("is_total = 0").select("decade", "word", "c")) == rows(counts)
    assert rows(both.filter("is_total = 1").select("decade", "c")) == [("1560s", 82), ("1980s", 7)]


def test_pages_are_kept_when_readable(lines):
    pages = [r.pages for r in parse_ngrams(lines("w\t1990\t1\t7", "w\t1990\t1\tx", "w\t1990\t1"), 1).collect()]
    assert pages == [7, None, None]


def test_sums_are_64_bit(lines, stop):
    many = lines("w\t1990\t2147483647\t1", "w\t1991\t2147483647\t1")
    counts = unigram_counts(with_decade(valid_unigrams(parse_ngrams(many, 1), stop)))
    assert period_totals(counts).head().n == 4294967294


def test_cleaning_before_and_after_pairing_agree(spark, stop, rows):
    docs = spark.createDataFrame(
        [(1, 'The "big" bad wolf, 1984 -- of Robin-Hood\nand more'), (2, "one"), (3, ""), (4, None)],
        "id int, text string",
    )
    after = valid_bigrams(document_bigrams(docs, ["id"]), stop)
    before = valid_document_bigrams(docs, ["id"], stop)
    assert rows(before.select("id", "w1", "w2", "count")) == rows(
        after.select("id", "w1", "w2", "count")
    )
    assert ("bad", "wolf") in {(r.w1, r.w2) for r in before.collect()}


def test_text_from_several_folders(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part").write_text(f"{name}\t1990\t1\t1\n")
    read = read_ngrams(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted(r.value for r in read.collect()) == ["a\t1990\t1\t1", "b\t1990\t1\t1"]
    with pytest.raises(ValueError):
        read_ngrams(spark, str(tmp_path), "zip")


def test_sequence_files(spark, tmp_path):
    values = [((1 << 33) + i, f"w{i}\t1990\t{i}\t1") for i in range(5)]
    path = str(tmp_path / "seq")
    spark.sparkContext.parallelize(values, 2).saveAsSequenceFile(path)
    parsed = parse_ngrams(read_ngrams(spark, path, "sequence"), 1)
    assert parsed.agg(F.sum("count")).head()[0] == 10
