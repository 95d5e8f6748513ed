import hashlib
import re

import pytest

from aljibe.llm import exact_dedup
from aljibe.llm.exact_dedup import DigestIndex, fresh_index, without_copies

DOCS = [(5, "a  b"), (3, "a\tb"), (9, "a\u00a0b"), (7, None), (2, ""), (8, " "), (4, "z" * 50_000), (6, "z" * 50_000), (1, "alone"), (None, "a b"), (3, "a\tb")]


def expected(docs):
    plain = [(i, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()) for i, t in docs]
    keep, size = {}, {}
    for i, h in plain:
        keep[h] = min((x for x in (keep.get(h), i) if x is not None), default=None)
        size[h] = size.get(h, 0) + 1
    return sorted([(i, keep[h], size[h], i == keep[h], h) for i, h in plain], key=repr)


def test_equals_brute_force(spark, rows, with_clashes):
    docs = with_clashes(spark.createDataFrame(DOCS, "doc_id long, text string"))
    got = fresh_index(spark, 4).deduplicate(docs)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected(DOCS)


def test_later_batches_meet_the_index(spark, rows):
    index = fresh_index(spark, 4)
    index.deduplicate(spark.createDataFrame([(10, "a"), (11, "b"), (12, "a")], "doc_id long, text string")).collect()
    got = index.deduplicate(spark.createDataFrame([(1, "a"), (2, "c"), (3, "c")], "doc_id long, text string"))
    assert rows(got, "doc_id", "keep_id", "kept") == [(1, 10, False), (2, 2, True), (3, 2, False)]
    assert index.read().count() == 3
    detail = {r[0]: r[1] for r in spark.sql(f"DESCRIBE FORMATTED {index.table}").collect()}
    assert detail["Num Buckets"] == "4" and detail["Bucket Columns"] == detail["Sort Columns"] == "[`digest`]"
    plan = got.sparkSession.table(index.table).hint("merge").join(index.read().hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_an_empty_table_gives_no_rows(spark):
    assert fresh_index(spark).deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_of_each_text_stays_with_all_columns(spark, rows, with_clashes):
    docs = with_clashes(spark.createDataFrame(DOCS, "doc_id long, text string"))
    got = without_copies(docs, fresh_index(spark, 4))
    assert got.columns == docs.columns
    assert rows(got, "doc_id", "text") == sorted([(3, "a\tb"), (9, "a\u00a0b"), (2, ""), (8, " "), (4, "z" * 50_000), (1, "alone")], key=repr)


@pytest.mark.parametrize("docs", [[(None, "a"), (None, "a"), (None, "b")], [(1, "a"), (1, "b"), (1, "a")]])
def test_missing_and_repeated_ids(spark, rows, docs):
    got = without_copies(spark.createDataFrame(docs, "doc_id long, text string"), fresh_index(spark, 4))
    assert rows(got) == sorted(set(docs), key=repr)


def test_buckets_follow_the_first_batch_and_the_index_goes(spark, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_PER_BUCKET", 5)
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('text ', id % 150) AS text")
    with fresh_index(spark) as index:
        found = index.deduplicate(docs)
        assert index.buckets == 30
        again = DigestIndex(spark, index.table).deduplicate(docs)
        assert again.where("kept").count() == 150
    assert not spark.catalog.tableExists(index.table)
    assert found.where("kept").count() == 150 and again.where("kept").count() == 150  # both still read what they need


def test_queries_leave_no_index_behind(spark):
    from aljibe.llm.queries import QUERIES

    before = {t.name for t in spark.catalog.listTables()}
    assert QUERIES["op6_exact_dedup"](spark, "/root/testdata/sf0.001").count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before
