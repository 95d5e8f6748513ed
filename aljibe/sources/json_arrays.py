"""Large JSON files that hold one array of documents, read by several tasks per file.

Where a byte range of such a file begins, nothing tells whether it is inside a string or how deep. Both are running sums, so they are found like
any running sum over many tasks: every range is summed up for either beginning, the sums are added along each file, and then each range is cut at the ends
of its documents, knowing how it begins. Documents that lie in more than one range are put together from their parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from aljibe.session import staged

#: The splits of a scan are broadcast, a few numbers each, up to this many; beyond, the scan is joined to them by a shuffle.
BROADCAST_SPLITS = 200_000
#: An escape and what it escapes, which is neither a quote nor a bracket then.
ESCAPED = re.compile(rb"\\.", re.DOTALL)
QUOTE, OPEN, CLOSE = ord('"'), ord("{"), ord("}")
DEPTH = np.zeros(256, np.int32)
DEPTH[[OPEN, ord("[")]], DEPTH[[CLOSE, ord("]")]] = 1, -1
SPLIT = "file bigint, start bigint"


def _pieces(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """The text up to each ``}`` without it, in file order within a split; ``file`` is a hash of the path, ``start`` that of the split.

    The text source takes the end of an object for the end of a line, so it splits files anywhere without losing a byte.
    """
    reader = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    at = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size")]
    return reader.text(root).select(F.col("value").cast("binary").alias("value"), *at)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """The numbers of a split and its text, with the ``}`` again, in chunks."""
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = [column.to_numpy() for column in batch.columns[1:]]
        changes = np.flatnonzero(np.logical_or.reduce([column[1:] != column[:-1] for column in numbers[:2]])) + 1
        edges = [0, *changes.tolist(), batch.num_rows]
        for first, last in zip(edges, edges[1:]):
            values = batch.column(0).slice(first, last - first).to_pylist()
            yield tuple(int(column[first]) for column in numbers), b"}".join(values) + b"}"


def _states(text: bytes, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes without what is escaped, and for each whether it is within a string that begins or goes on, given whether the text begins in one."""
    code = np.frombuffer(ESCAPED.sub(b"  ", text) if b"\\" in text else text, np.uint8)
    return code, np.bitwise_xor.accumulate(code == QUOTE) ^ bool(inside)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: its quotes (odd or even), what it adds to the depth if it begins outside a string and if inside, its bytes, its first byte that is not blank."""
    found: dict[tuple, list[int]] = {}
    for (file, start, size), text in _runs(batches):
        one = found.setdefault((file, start, size), [0, 0, 0, 0, 0])
        code, within = _states(text, one[0])
        depth = DEPTH[code]
        one[1] += int(depth[~within].sum())
        one[2] += int(depth[within].sum())
        one[0] = int(within[-1])
        one[3] += len(text)
        head = text.removeprefix(b"\xef\xbb\xbf").lstrip()
        one[4] = one[4] or (head[0] if head else 0)
    rows = [(*split, *one) for split, one in found.items()]
    if rows:
        names = ["file", "start", "size", "quotes", "outside", "inside", "bytes", "first"]
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], names=names)


def _beginnings(pieces: DataFrame) -> DataFrame:
    """Per split: whether it begins in a string, at which depth, the depth around documents, and the bytes it has. A row per split, in the shared folder."""
    sums = pieces.mapInArrow(_summed, f"{SPLIT}, size bigint, quotes bigint, outside bigint, inside bigint, bytes bigint, first bigint")
    whole, before = Window.partitionBy("file"), Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.withColumn("begins_inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    added = F.when(F.col("begins_inside") == 1, F.col("inside")).otherwise(F.col("outside"))
    begun = begun.withColumn("depth", F.coalesce(F.sum(added).over(before), F.lit(0)))
    # the last text of a file was given a closing bracket that the file may not have
    added_end = (F.sum("bytes").over(whole) == F.col("size") + 1) & (F.col("start") == F.max("start").over(whole))
    root = F.min_by("first", F.when(F.col("first") > 0, F.col("start"))).over(whole)
    return staged(begun.select(
        "file", "start", F.col("begins_inside").alias("inside"), "depth", F.when(root == ord("["), 1).otherwise(0).cast("bigint").alias("base"),
        (F.col("bytes") - added_end.cast("bigint")).alias("bytes"),
    ))


def _cut(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Documents that lie in one split, or the parts of those that do not, with their place: split, number, whether the document begins there."""
    split, rows = None, []

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["file", "start", "number", "begins", "value"])

    def ended() -> None:
        if split is not None and opened and not whole:
            rows.append((*split, 1, begins, b"".join(opened)))

    for (file, start, _, starts_inside, starts_deep, base, size), text in _runs(batches):
        if (file, start) != split:
            ended()
            split, inside, depth, left = (file, start), starts_inside, starts_deep, size
            opened, begins = ([b""], False) if depth > base else ([], True)
        text = text[:left]
        left -= len(text)
        if not text:
            continue
        code, within = _states(text, inside)
        depths = depth + np.cumsum(np.where(within, 0, DEPTH[code]))
        first = np.flatnonzero(~within & (code == OPEN) & (depths == base + 1)).tolist()
        last = np.flatnonzero(~within & (code == CLOSE) & (depths == base)).tolist()
        if opened and last:
            document = b"".join([*opened, text[: last[0] + 1]])
            if begins == whole:
                rows.append((*split, 0, begins, document))
            opened, begins, last = [], True, last[1:]
        elif opened:
            opened.append(text)
        if whole:
            rows.extend((*split, 0, True, text[a : b + 1]) for a, b in zip(first, last))
        if len(first) > len(last):
            opened, begins = [text[first[-1] :]], True
        inside, depth = int(within[-1]), int(depths[-1])
        if len(rows) >= 5000:
            yield batch()
            rows = []
    ended()
    if rows:
        yield batch()


def json_documents(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """``value``: the text of every document in the files below ``root``, each an array of documents or one document. Runs a job.

    A file is read in as many ranges as the scan splits it into (``spark.sql.files.maxPartitionBytes``). It is scanned three times: for the sums, for documents within a
    range, and for parts of those across ranges, which alone are shuffled. Items of the array that are not objects are left out; a
    document that the file breaks off in is given as far as it goes.
    """
    pieces = _pieces(spark, root, pattern)
    beginnings = _beginnings(pieces)
    if beginnings.count() <= BROADCAST_SPLITS:
        placed = pieces.join(F.broadcast(beginnings), ["file", "start"])
    else:
        numbered = pieces.withColumn("_row", F.monotonically_increasing_id())
        placed = numbered.join(beginnings, ["file", "start"]).sortWithinPartitions("file", "start", "_row")
    placed = placed.select("value", "file", "start", "size", "inside", "depth", "base", "bytes")
    kind = f"{SPLIT}, number bigint, begins boolean, value binary"
    within = placed.mapInArrow(lambda batches: _cut(batches, True), kind).select(F.col("value").cast("string").alias("value"))
    parts = placed.mapInArrow(lambda batches: _cut(batches, False), kind)
    order = Window.partitionBy("file").orderBy("start", "number").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("document", F.sum(F.col("begins").cast("int")).over(order))
    pieces_of = F.array_sort(F.collect_list(F.struct("start", "number", F.col("value").cast("string").alias("value"))))
    across = parts.groupBy("file", "document").agg(pieces_of.alias("parts")).select(F.array_join("parts.value", "").alias("value"))
    return within.unionByName(across)


def json_rows(spark: SparkSession, root: str, schema: StructType | str, pattern: str = "*.json") -> DataFrame:
    """The documents as rows of ``schema``; what does not parse is NULL."""
    return json_documents(spark, root, pattern).select(F.from_json("value", schema).alias("row")).select("row.*")
