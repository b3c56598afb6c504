import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_tables import classes
from tests.llm.test_texts import base_spans, hits
from tests.llm.test_words import SPACED

SF = "/root/testdata/sf0.001"


def test_each_stage_judges_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(9000, None, "en", "s", 0), (9001, "", None, "s", 0), (9002, "12 34", "en", None, 5), (9003, "the token = abcdef12 of it", "en", None, 26)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in cp.STAGES:
        made = stage(spark, docs, SF)
        made.write.parquet(str(tmp_path / name))
        before = docs.collect()
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = (before, docs.collect())
        if name != cp.STAGES[-1][0]:
            assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns

    before, after = kept["language_id"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} >= {9000, 9001, 9002} and len(after) >= 0.97 * len(before)
    before, after = kept["near_duplicates"]
    texts = [r["text"] for r in sorted(before, key=lambda r: r["doc_id"])]
    ids = sorted(r["doc_id"] for r in before)
    assert sorted(r["doc_id"] for r in after) == sorted({ids[least] for _, least in classes(texts, 5, 80, 100)})
    before, after = kept["decontamination"]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if not hits(r["text"], items)[1])
    before, after = kept["secrets"]
    assert len(before) == len(after) and not any(base_spans(r["text"]) for r in after)
    plain = {r["doc_id"]: r["text"] for r in after}
    assert all(plain[r["doc_id"]] == r["text"] for r in before if not base_spans(r["text"]) and "<SECRET>" not in plain[r["doc_id"]])
    before, after = kept["mixing"]
    total = sum(len(SPACED.findall(r["text"])) for r in before)
    assert abs(sum(r["taken"] for r in after) - total) <= 30 and all(len(SPACED.findall(r["text"])) == r["taken"] for r in after)


def test_run_applies_the_stages(spark):
    found = cp.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "taken"} <= set(found.columns) and found.count() > 100
    assert cp.ORACLE_SQL is None


@pytest.mark.parametrize("number", range(len(cp.STAGES)))
def test_empty_tables(spark, number):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    assert cp.STAGES[number][1](spark, docs, SF).count() == 0
