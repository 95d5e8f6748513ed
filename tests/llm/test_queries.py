import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from aljibe.llm import exact_dedup, simhash
from aljibe.llm.queries import ORACLE, QUERIES
from checks import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not present")


def test_queries_equal_sql(spark):
    assert compare.differences(spark, FOLDER, list(ORACLE)) == {}


def test_every_operator_and_the_pipeline_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_main_text", "op3_toxicity", "op7_personal_data", "op9_byte_bpe", "op10_simhash", "op11_licenses", "op12_word_runs"])
def test_a_row_per_row(spark, name):
    source = "pages" if name == "op1_main_text" else "documents"
    assert QUERIES[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()


def test_pipeline_stages_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, FOLDER).cache()
        assert kept.columns == columns and kept.dtypes == docs.dtypes, name
        ids, left = {r[0] for r in before.select("doc_id").collect()}, {r[0] for r in kept.select("doc_id").collect()}
        assert left <= ids
        if name == "exact_dedup":
            assert left == {r.doc_id for r in exact_dedup.fresh_index(spark).deduplicate(before).where("kept").collect()}
        if name == "simhash":
            assert left == {r.component_id for r in simhash.near_duplicates(before).collect()}
        if name == "personal_data":
            assert left == ids and kept.where("text like '%@%.example.com%'").count() == 0
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r[0] for r in packed.select("doc_id").collect()} == left
