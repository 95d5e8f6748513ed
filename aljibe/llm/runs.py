"""Periodic runs of words: dyadic catchers find squares, squares merge into runs, and repeated stretches are collapsed."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12  # words of the shortest run
SLICE_WORDS = 1 << 19  # words whose comparisons are advanced together; a longer document is a slice of its own
ALONE = -1


def lags(size: int) -> tuple[int, int]:
    """Distances, first and last, at which a block of ``size`` words is compared with what is appended after it.

    Words that agree with those ``p`` before them fill at least ``max(LEAST - p, p)`` places of a run of period ``p``, and a stretch of
    2 * size - 1 places holds a whole aligned block. So every run is caught by blocks of 4 up to period 14 (6 words agree at
    period 6, which takes blocks of 2), of 8 up to 30, of 16 up to 62, and so on.
    """
    return {1: (1, 0), 2: (6, 6), 4: (1, 14)}.get(size, (2 * size - 1, 4 * size - 2))


@dataclass
class Runs:
    """Maximal runs of a row of words, by start and then by period. ``stop`` is exclusive."""

    start: np.ndarray
    stop: np.ndarray
    period: np.ndarray


def _names(first: np.ndarray, second: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """A number for each pair that occurs twice or more, at its places of ``n``; ALONE elsewhere."""
    out = np.full(n, ALONE, np.int64)
    if len(places):
        key = first * np.int64(second.max() + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)
        often = sizes[group] > 1
        out[places[order[often]]] = group[often]
    return out


def _agree(name: np.ndarray, at: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Whether the block at ``at`` is the block ``lag`` later; blocks beyond either end are not."""
    inside = (at >= 0) & (at + lag < len(name))
    here = name[np.where(inside, at, 0)]
    return inside & (here != ALONE) & (here == name[np.where(inside, at + lag, 0)])


def _caught(name: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Aligned blocks and the lags at which an appended word completes the same block again.

    Each catcher is a completed block. The suffix that an appended word completes is compared with the catchers whose lag it
    reaches: a look-up of its name among the later places of that name.
    """
    least, most = lags(size)
    places = np.flatnonzero(name != ALONE)
    if least > most or not len(places):
        return places[:0], places[:0]
    n = np.int64(len(name) + most + 1)
    ordered = np.sort(name[places] * n + places)
    blocks = places[places % size == 0]
    first = np.searchsorted(ordered, name[blocks] * n + blocks + least)
    last = np.searchsorted(ordered, name[blocks] * n + blocks + most, side="right")
    found = np.maximum(last - first, 0)
    block = np.repeat(blocks, found)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(found) - found, found)
    return block, ordered[np.repeat(first, found) + nth] % n - block


def runs_of(words: np.ndarray, owner: np.ndarray) -> Runs:
    """The runs of ``words`` (numbers, equal for equal words), none across two values of ``owner``, which ascends.

    Blocks of 1, 2, 4 .. words are named by pairs of named halves, and only those that occur twice in one document keep a name: what
    is left thins out quickly, and the levels end when no block recurs. Squares caught by neighbouring blocks at one lag are one
    stretch, which is extended by less than a block at both ends, halving the step. O(n log n) names and comparisons.
    """
    n = len(words)
    levels = [_names(owner.astype(np.int64), words.astype(np.int64), np.arange(n), n)]
    starts, stops, periods, size = [], [], [], 1
    while True:
        name = levels[-1]
        block, lag = _caught(name, size)
        if len(block):
            order = np.lexsort((block, lag))
            block, lag = block[order], lag[order]
            new = np.concatenate(([True], (lag[1:] != lag[:-1]) | (block[1:] != block[:-1] + size)))
            left, p = block[new], lag[new]
            right = block[np.concatenate((new[1:], [True]))] + size
            for half in range(len(levels) - 2, -1, -1):
                step = 1 << half
                right = right + step * _agree(levels[half], right, p)
                left = left - step * _agree(levels[half], left - step, p)
            square = right - left >= np.maximum(LEAST - p, p)
            starts.append(left[square])
            stops.append((right + p)[square])
            periods.append(p[square])
        places = np.flatnonzero(name[: max(n - size, 0)] != ALONE)
        places = places[name[places + size] != ALONE]
        if not len(places):
            break
        levels.append(_names(name[places], name[places + size], places, n))
        size *= 2
    start, stop, period = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, stops, periods)]
    # a run is caught at multiples of its period too, over the same words: the smallest is its period
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    first = np.concatenate(([True], (start[1:] != start[:-1]) | (stop[1:] != stop[:-1]))) if len(start) else np.zeros(0, bool)
    start, stop, period = start[first], stop[first], period[first]
    order = np.lexsort((period, start))
    return Runs(start[order], stop[order], period[order])


def repeated(n: int, found: Runs) -> np.ndarray:
    """Whether each of ``n`` words lies in a run after the first period of it."""
    change = np.bincount(found.start + found.period, minlength=n + 1) - np.bincount(found.stop, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def looped(n: int, doc_id: int | None) -> np.ndarray:
    """Which original word stands at each of the ``n`` places: in a tenth of the documents, by the CRC of the id, the end becomes periodic."""
    at = np.arange(n)
    if doc_id is None or n == 0:
        return at
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return at
    g = h // 10
    a = g % n
    return np.where(at < a, at, a + (at - a) % (1 + (n - a) // (3 + g % 8)))


def _described(doc_id: int | None, words: list[bytes], found: Runs, dropped: np.ndarray) -> tuple:
    start, length, period = found.start.tolist(), (found.stop - found.start).tolist(), found.period.tolist()
    lines = "".join([f"{s},{n},{q}\n" for s, n, q in zip(start, length, period)])
    kept = [w for w, gone in zip(words, dropped.tolist()) if not gone] if start else words
    most = min(zip([-n for n in length], start, period), default=None)
    longest = (most[1], -most[0], most[2], 1000 * -most[0] // most[2]) if most else (None,) * 4
    return (doc_id, len(start), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def described(ids: list[int | None], texts: list[bytes], loop: bool = True) -> list[tuple]:
    """The rows of ``periodic_runs`` for documents whose words are advanced together."""
    number, words, numbers, owner = {}, [], [], []
    for place, (doc_id, text) in enumerate(zip(ids, texts)):
        own = text.split()  # splits bytes at exactly the six characters of white space
        own_numbers = np.array([number.setdefault(w, len(number)) for w in own], np.int64)
        if loop:
            at = looped(len(own), doc_id)
            own, own_numbers = [own[i] for i in at.tolist()], own_numbers[at]
        words.append(own)
        numbers.append(own_numbers)
        owner.append(np.full(len(own), place, np.int64))
    ends = np.cumsum([0, *map(len, words)])
    found = runs_of(np.concatenate(numbers), np.concatenate(owner))
    dropped, edges = repeated(int(ends[-1]), found), np.searchsorted(found.start, ends)
    rows = []
    for i, doc_id in enumerate(ids):
        own = slice(edges[i], edges[i + 1])
        mine = Runs(found.start[own] - ends[i], found.stop[own] - ends[i], found.period[own])
        rows.append(_described(doc_id, words[i], mine, dropped[ends[i] : ends[i + 1]]))
    return rows


COLUMNS = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loop: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256.

    ``loop`` first makes the end of a tenth of the documents periodic (``looped``), to have runs to find; a row without id is left alone.
    NULL texts have no words; without a run the four columns of the longest are NULL. Repeated rows and NULL ids are read like any other;
    other columns are not read. No shuffle: a document is searched in the task that reads it, in memory that grows with its words.
    """
    schema = pa.schema([pa.field(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in COLUMNS.split(", ")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, at = batch.column(0).to_pylist(), batch.column(1), 0
            while at < len(ids):
                taken, size, stop = [], 0, at
                while stop < len(ids) and size < 6 * SLICE_WORDS:
                    taken.append(texts[stop].as_py())
                    size += len(taken[-1])
                    stop += 1
                found = described(ids[at:stop], taken, loop)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
                at = stop

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).mapInArrow(rows, COLUMNS)
