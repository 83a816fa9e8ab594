"""Registered queries against their SQL, and the pipeline against brute-force stages."""


import pytest
from checks.compare import compare, duck

import __spark_entry__ as driver
import corpus_pipeline as P
from lexiloom.llm import queries

from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_line_dedup import key
from tests.llm.test_minhash import brute as near

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = driver.queries().keys()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, name):
    ok, note = compare(spark, duck(SF), name, SF)
    assert ok, note


def cut(docs):
    holders = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(d)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    return [(d, t if t is None else "\n".join(x for x in t.split("\n") if gone.get(key(x), d) == d)) for d, t in docs]


def test_stages_decide_on_what_is_left(spark):
    """Stages after the classifier, each against brute force on its predecessor's rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    names = [name for name, _ in P.STAGES]
    assert names == ["quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "byte_bpe"]
    columns, left = docs.columns, None
    for name, stage in P.STAGES:
        before = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()) if left is None else left
        docs = P.materialize(stage(spark, docs, SF), f"test-{name}")
        if name == "byte_bpe":
            assert sorted(r.doc_id for r in docs.collect()) == [d for d, _ in before]
            break
        assert docs.columns == columns
        left = sorted((r.doc_id, r.text) for r in docs.collect())
        if name == "line_dedup":
            assert left == cut(before)
        elif name == "minhash_near_dedup":
            assert {d for d, _ in left} == {d for d, _, low in near(before, percent=80) if d == low}
        elif name == "benchmark_decontamination":
            assert {d for d, _ in left} == {d for d, _ in before} - {d for d, _, _ in leaks(before, items, 80)}
        else:
            assert 0 < len(left) < len(before)


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() < 200


def test_main_package_does_not_need_this_one():
    from pathlib import Path

    root = Path(driver.__file__).parent
    for path in [*root.glob("lexiloom/**/*.py"), *root.glob("checks/*.py")]:
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
