"""SimHash near-duplicates: fingerprints of word shingles, linked through pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aljibe.llm.components import components
from aljibe.llm.names import unused
from aljibe.session import staged

SHINGLE, BITS, SEED = 4, 4, 42
GROUP = 4096  # members of a bucket that one task compares
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text: bit i is set if more than half of the shingle hashes have it.

    A-Z are lower-cased; words are separated by ASCII white space; with fewer words than ``shingle`` all of them are one
    shingle; without words the fingerprint is 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    starts = stops - sizes
    take = min(shingle, len(words)) - 1
    begin, end = starts[:len(words) - take].tolist(), stops[take:].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(begin), 65536):
        hashes = b"".join([digest(joined[i:j], SEED) for i, j in zip(begin[at:at + 65536], end[at:at + 65536])])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(begin)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed long) per row. NULL texts are empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(cell.as_buffer().to_pybytes(), shingle) for cell in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], schema=schema)

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        rows, "doc_id bigint, text_hash bigint, fp bigint")


def segments(bits: int) -> list[tuple[int, int]]:
    """Offset and width of bits + 1 consecutive segments of 64 bits, as even as possible."""
    m = bits + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def chain_masks(bits: int) -> np.ndarray:
    """[start, length - 1]: the bits of the chain of so many consecutive segments, around the ring."""
    parts = [((1 << w) - 1) << o for o, w in segments(bits)]
    m = len(parts)
    return np.array([[sum(parts[(r + k) % m] for k in range(n)) for n in range(1, m + 1)] for r in range(m)], np.uint64)


def _bucket_rows(fps: DataFrame, bits: int) -> DataFrame:
    """``base``, ``key``, ``ring`` and ``fp``: a key per start of a chain and per bit in which its second segment may differ.

    bits + 1 segments hold at most ``bits`` differing bits, so some chain begins with an equal segment and has at most one
    differing bit in its first two (n segments: at most n * bits / (bits + 1)). Both fingerprints then share the key
    in which that bit is cleared.
    """
    parts, fp = segments(bits), F.col("fp")
    cut = lambda at: F.shiftrightunsigned(fp, at[0]).bitwiseAND(F.lit((1 << at[1]) - 1))
    rows, number = [], 0
    for ring, first in enumerate(parts):
        second = parts[(ring + 1) % len(parts)]
        base = F.call_function("shiftleft", cut(first), F.lit(second[1])).bitwiseOR(cut(second))
        for bit in range(second[1]):
            key = base.bitwiseAND(F.lit(~(1 << bit))).bitwiseOR(F.lit(number << 48))
            rows.append(F.struct(base.bitwiseOR(F.lit(ring << 48)).alias("base"), key.alias("key"), F.lit(ring).cast("tinyint").alias("ring")))
            number += 1
    return fps.select(F.explode(F.array(*rows)).alias("k"), "fp").select("k.base", "k.key", "k.ring", "fp")


def near_pairs(points: np.ndarray, ring: int, masks: np.ndarray, bits: int) -> tuple[list[int], list[int]]:
    """Links that join up all near members of a bucket: a spanning forest, not all pairs."""
    label, found = np.arange(len(points)), ([], [])
    for at in range(len(points) - 1):
        other = np.flatnonzero(_near(points[at], points[at + 1:], np.int64(ring), masks, bits)) + at + 1
        if not len(other):
            continue
        new, first = np.unique(label[other], return_index=True)
        for value, i in zip(new.tolist(), other[first].tolist()):
            if value != label[at]:
                found[0].append(int(points[at]))
                found[1].append(int(points[i]))
                label[label == value] = label[at]
    return found


def _near(a: np.ndarray, b: np.ndarray, ring: np.ndarray, masks: np.ndarray, bits: int) -> np.ndarray:
    """Whether pairs stay within the budget of every chain from ``ring`` on, and then in all 64 bits."""
    differ = (a ^ b).view(np.uint64)
    good = np.ones(differ.shape, bool)
    for n in range(2, bits + 2):
        good &= np.bitwise_count(differ & masks[ring, n - 1]) <= n * bits // (bits + 1)
    return good


def _links_within(bits: int):
    """Function over batches of (bucket, ring, fp), sorted by bucket: links between near members of a bucket."""
    masks = chain_masks(bits)

    def whole_buckets(keys: np.ndarray, rings: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        sizes = np.diff(edges)
        for start, size in zip(edges[:-1][sizes > 8].tolist(), sizes[sizes > 8].tolist()):
            left, right = near_pairs(points[start:start + size], int(rings[start]), masks, bits)
            a.append(np.array(left, np.int64))
            b.append(np.array(right, np.int64))
        member = np.repeat(sizes, sizes)
        member = np.where(member > 8, 0, member)
        for step in range(1, 8):
            at = np.flatnonzero(member[:-step] > step)
            at = at[keys[at] == keys[at + step]]
            near = at[_near(points[at], points[at + step], rings[at], masks, bits)]
            a.append(points[near])
            b.append(points[near + step])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=LINKS)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 3
        for batch in batches:
            now = [np.concatenate([k, batch.column(i).to_numpy().astype(np.int64)]) for i, k in enumerate(kept)]
            last = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0  # the last bucket may go on
            if last:
                yield whole_buckets(*[c[:last] for c in now])
            kept = [c[last:] for c in now]
        if len(kept[0]):
            yield whole_buckets(*kept)

    return links


def near_links(fps: DataFrame, bits: int = BITS, group: int = GROUP) -> DataFrame:
    """Links ``a``, ``b`` that join up all fingerprints (``fp``, distinct) at most ``bits`` apart. Runs jobs.

    Buckets with more than ``group`` members are split into blocks, and every two blocks of a bucket meet in a bucket of their
    own, so none is compared in one task and no link is lost.
    """
    rows = _bucket_rows(fps, bits)
    hot = staged(_base_counts(fps, bits).filter(F.col("members") > group // 2))
    if hot.isEmpty():
        dealt = rows.select(F.col("key").alias("bucket"), "ring", "fp")
    else:
        keys = staged(_hot_keys(hot, bits, group))
        known = rows.join(keys, "key", "left")
        block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        split = known.filter("blocks > 1").select("key", "ring", "fp", block.alias("own"), each.alias("other"))
        dealt = known.filter("blocks is null or blocks = 1").select(F.col("key").alias("bucket"), "ring", "fp").union(
            split.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")), "ring", "fp"))
    found = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_links_within(bits), "a bigint, b bigint")
    return found.distinct()


def _base_counts(fps: DataFrame, bits: int) -> DataFrame:
    """How many fingerprints share the first two segments of a chain, per start."""
    parts, fp = segments(bits), F.col("fp")
    rows = []
    for ring, (offset, width) in enumerate(parts):
        second = parts[(ring + 1) % len(parts)]
        first = F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1))
        after = F.shiftrightunsigned(fp, second[0]).bitwiseAND(F.lit((1 << second[1]) - 1))
        rows.append(F.call_function("shiftleft", first, F.lit(second[1])).bitwiseOR(after).bitwiseOR(F.lit(ring << 48)))
    return fps.select(F.explode(F.array(*rows)).alias("base")).groupBy("base").agg(F.count(F.lit(1)).alias("members"))


def _hot_keys(hot: DataFrame, bits: int, group: int) -> DataFrame:
    """Keys of crowded bases and the blocks they need. A key gathers two bases; the crowd of the larger one, twice, bounds it."""
    parts, rows, number = segments(bits), [], 0
    ring, base = F.shiftright("base", 48), F.col("base").bitwiseAND(F.lit((1 << 48) - 1))
    for start in range(len(parts)):
        for bit in range(parts[(start + 1) % len(parts)][1]):
            key = base.bitwiseAND(F.lit(~(1 << bit))).bitwiseOR(F.lit(number << 48))
            rows.append(F.when(ring == start, key))
            number += 1
    keys = hot.select(F.explode(F.filter(F.array(*rows), lambda k: k.isNotNull())).alias("key"), "members")
    return keys.groupBy("key").agg(F.ceil(2 * F.max("members") / F.lit(group)).cast("bigint").alias("blocks"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id, text_hash, group_fp. Runs jobs.

    ``component_id`` is the smallest doc_id that links of at most ``bits`` differing bits reach; NULL only if all ids of the
    component are NULL. ``group_fp`` names the component by a fingerprint. NULL and empty texts have fingerprint zero and are
    linked like others; repeated rows are in the same component. Other columns are not read.

    Copies meet once, as one fingerprint; links are looked for between distinct fingerprints and need not name every pair.
    """
    own = staged(fingerprints(docs, shingle, id_col, text_col))
    distinct = staged(own.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")))
    linked = staged(components(near_links(distinct.select("fp"), bits)))
    grouped = linked.join(distinct, linked.node == distinct.fp).select("component", "first", "node")
    names = staged(grouped.groupBy("component").agg(F.min("first").alias("component_id")))
    of_links = linked.join(names, "component").select(F.col("node").alias("fp"), "component_id", F.col("component").alias("group_fp"))
    copies = distinct.filter("rows > 1").join(linked, distinct.fp == linked.node, "left_anti").select(
        "fp", F.col("first").alias("component_id"), F.col("fp").alias("group_fp"))
    lookup = staged(of_links.union(copies))
    joined = own.join(lookup, "fp", "left")
    alone = F.col("group_fp").isNull()
    return joined.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash", F.coalesce("group_fp", "fp").alias("group_fp"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that stand for their component, all columns as they are. Runs jobs.

    The smallest id stays; of a component without ids, or of rows that repeat the id, one row stays.
    """
    marked = staged(near_duplicates(docs, shingle, bits, id_col, text_col))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    a, b = unused(docs, "_gone_id"), unused(docs, "_gone_hash")
    gone = staged(marked.filter(~stays & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(a), F.col("text_hash").alias(b)).distinct())
    key, text = F.col(id_col).cast("bigint"), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    named = docs.filter(key.isNotNull()).join(gone, (key == F.col(a)) & (text == F.col(b)), "left_anti")
    crowd = staged(marked.filter(stays & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(F.col("doc_id").alias(a)))
    if not crowd.isEmpty():
        named = named.join(crowd, key == F.col(a), "left_anti").unionByName(named.join(crowd, key == F.col(a), "left_semi").dropDuplicates([id_col]))
    nameless = marked.filter("doc_id is null and component_id is null").groupBy("group_fp").agg(F.min("text_hash").alias(b)).select(b)
    if nameless.isEmpty():
        return named
    lone = docs.filter(key.isNull()).withColumn(a, text).join(nameless, F.col(a) == F.col(b), "left_semi")
    return named.unionByName(lone.dropDuplicates([a]).drop(a))
