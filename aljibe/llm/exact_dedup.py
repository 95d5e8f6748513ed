"""Exact deduplication against a persistent digest index, bucketed and sorted by hash."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aljibe.llm.names import unused
from aljibe.session import staged

INDEX_SCHEMA = "digest binary, keep_id bigint"
LEAST_BUCKETS, ROWS_PER_BUCKET = 16, 2_000_000


def normalised(text):
    """``text`` with each run of ASCII white space as one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class DigestIndex:
    """Table of the digests seen so far and the document that stands for each.

    The table is bucketed and sorted by digest, so a new batch meets it in a
    sort-merge join in which only the digests of the batch are shuffled. The number of buckets is that of the join's tasks and is for good; if not given, it follows
    from the distinct texts of the first batch, ROWS_PER_BUCKET each. As a context manager the index is dropped in the end; what ``deduplicate`` has returned stays.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table, self.buckets = spark, table, buckets
        if spark.catalog.tableExists(table):
            described = {row[0]: row[1] for row in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
            self.buckets = int(described["Num Buckets"])
        elif buckets:
            self._append(spark.createDataFrame([], INDEX_SCHEMA))

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def _append(self, rows: DataFrame) -> None:
        if not self.buckets:
            self.buckets = max(LEAST_BUCKETS, -(-rows.count() // ROWS_PER_BUCKET))
        (rows.repartition(self.buckets, "digest").write.mode("append").format("parquet")
             .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))

    def read(self) -> DataFrame:
        return self.spark.table(self.table) if self.spark.catalog.tableExists(self.table) else self.spark.createDataFrame([], INDEX_SCHEMA)

    def deduplicate(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per row of ``docs``: doc_id, keep_id, group_size, kept, keep_rows, text_sha256. Runs jobs.

        Texts that the index holds already keep its document, whatever the ids of
        the batch; of new equal texts the smallest id stays and is appended.
        ``group_size`` counts the rows of the batch with that text. NULL and empty
        texts are equal. A NULL id is larger than any other. Rows that repeat both
        id and text are marked alike; ``keep_rows`` says how many rows of the batch
        carry the id that stays. Other columns are not read, so they may have any name.

        Only digests are shuffled, never texts. Equal digests are counted per task
        before the shuffle, and the rows meet the short list of repeated digests in
        a join whose hot keys Spark can split.
        """
        hashed = staged(docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest")))
        per_id = hashed.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
        groups = staged(per_id.groupBy("digest").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rows")).alias("first"),
            F.sum("rows").alias("group_size")))
        fresh = groups.join(self.read().hint("merge"), "digest", "left_anti")
        self._append(staged(fresh.select("digest", F.col("first.doc_id").alias("keep_id"))))
        listed = groups.join(self.read().hint("merge"), "digest").select(
            "digest", "keep_id", "group_size",
            F.when(F.col("first.doc_id").eqNullSafe(F.col("keep_id")), F.col("first.rows")).otherwise(0).alias("keep_rows"))
        own = listed.filter((F.col("group_size") > 1) | (F.col("keep_rows") == 0))
        marked = hashed.join(staged(own).withColumn("repeated", F.lit(True)), "digest", "left")
        repeated = F.col("repeated").isNotNull()
        keep = F.when(repeated, F.col("keep_id")).otherwise(F.col("doc_id"))
        return marked.select(
            "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
            (F.col("doc_id").eqNullSafe(keep) & (F.coalesce("keep_rows", F.lit(1)) > 0)).alias("kept"),
            F.coalesce("keep_rows", F.lit(1)).cast("bigint").alias("keep_rows"),
            F.lower(F.hex("digest")).alias("text_sha256"))


def fresh_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index of its own in the warehouse."""
    return DigestIndex(spark, f"llm_digests_{uuid.uuid4().hex}", buckets)


def without_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text nobody else stands for, all columns as they are. Runs jobs.

    Only the ids that go are joined, by sort-merge at every size: their list grows with the documents. Of rows that repeat
    a kept id and text one stays.
    """
    marked = staged(index.deduplicate(docs, id_col, text_col))
    key, digest = F.col(id_col).cast("bigint"), F.sha2(normalised(F.col(text_col)), 256)
    a, b = unused(docs, "_listed_id"), unused(docs, "_listed_digest")
    names = [F.col("doc_id").alias(a), F.col("text_sha256").alias(b)]
    gone = staged(marked.filter(~F.col("kept") & F.col("doc_id").isNotNull()).select(*names).distinct())
    again = staged(marked.filter(F.col("kept") & F.col("doc_id").isNotNull() & (F.col("keep_rows") > 1)).select(*names).distinct())
    nameless = staged(marked.filter(F.col("kept") & F.col("doc_id").isNull()).select(*names).distinct())
    same = (key == F.col(a)) & (digest == F.col(b))
    kept = docs.filter(key.isNotNull()).join(gone.hint("merge"), same, "left_anti")
    if not again.isEmpty():
        twice = kept.join(again, same, "left_semi").withColumn(b, digest).dropDuplicates([id_col, b]).drop(b)
        kept = kept.join(again, same, "left_anti").unionByName(twice)
    if nameless.isEmpty():
        return kept
    anonymous = docs.filter(key.isNull()).withColumn(a, digest).join(nameless.select(b), F.col(a) == F.col(b), "left_semi")
    return kept.unionByName(anonymous.dropDuplicates([a]).drop(a))
