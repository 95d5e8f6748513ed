"""Byte-level BPE: boundaries by a transition-function scan over character classes, cached pair merging, exact decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Character classes. White space is split by what follows it; apostrophes by the length of the contraction they begin.
LETTER, NUMBER, OTHER, SPACE, SPACE_LAST, WHITE, WHITE_LAST, SHORT, LONG, END = range(10)
#: States: what the character before belongs to.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, AFTER_WHITE, ONE_LEFT, TWO_LEFT = range(8)
BLOCK = 512
CACHE_WORDS = 500_000
SHORT_SUFFIXES, LONG_SUFFIXES = "stmd", ("re", "ve", "ll")


@cache
def class_table() -> np.ndarray:
    """Class of every code point: letter, number, space, other white space, other."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LN":
            table[point] = LETTER if kind == "L" else NUMBER
        elif kind == "Z" or 9 <= point <= 13 or point == 0x85:
            table[point] = WHITE
    table[ord(" ")] = SPACE
    return table


@cache
def transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a token begins here", both indexed by class * 8 + state."""
    after, begins = np.zeros(80, np.uint8), np.zeros(80, bool)
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    for kind in range(10):
        for state in range(8):
            at = kind * 8 + state
            if kind == END:
                after[at], begins[at] = START, True
            elif state in (ONE_LEFT, TWO_LEFT):
                after[at] = ONE_LEFT if state == TWO_LEFT else START
            elif kind in run:
                after[at], begins[at] = run[kind], state not in (run[kind], AFTER_SPACE)
            elif kind in (SHORT, LONG):
                joined = state in (IN_OTHERS, AFTER_SPACE)
                after[at], begins[at] = (IN_OTHERS, False) if joined else (ONE_LEFT if kind == SHORT else TWO_LEFT, True)
            else:  # white space: a run is one token, but its last character stands alone before other text
                after[at] = AFTER_SPACE if kind in (SPACE, SPACE_LAST) else AFTER_WHITE
                begins[at] = state not in (AFTER_SPACE, AFTER_WHITE) or kind in (SPACE_LAST, WHITE_LAST)
    return after, begins


def classes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of each code point of texts in one array; ``ends`` holds the positions of the separators after each text."""
    kinds = class_table()[points]
    kinds[ends] = END
    following = np.empty_like(kinds)
    following[:-1], following[-1:] = kinds[1:], END
    white = (kinds == SPACE) | (kinds == WHITE)
    last = white & (following != SPACE) & (following != WHITE) & (following != END)
    quotes = np.flatnonzero((points == ord("'")) & (kinds == OTHER))
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        inside = np.concatenate([kinds, np.full(2, END, np.uint8)])
        whole = [(one == ord(a)) & (two == ord(b)) & (inside[quotes + 2] != END) for a, b in LONG_SUFFIXES]
        kinds[quotes[np.logical_or.reduce(whole)]] = LONG
        kinds[quotes[np.isin(one, [ord(c) for c in SHORT_SUFFIXES]) & (inside[quotes + 1] != END)]] = SHORT
    kinds[last] += 1  # SPACE to SPACE_LAST, WHITE to WHITE_LAST
    return kinds


def token_starts(kinds: np.ndarray) -> np.ndarray:
    """Positions at which a token (or a separator) begins.

    Each character is a function from state to state. Functions compose associatively, so blocks of
    characters are composed side by side, the block functions are combined by doubling, and with the
    state before each block known all blocks are walked side by side once more.
    """
    after, begins = transitions()
    n = len(kinds)
    rows = max(1, -(-n // BLOCK))
    padded = np.full(rows * BLOCK, END, np.uint8)
    padded[:n] = kinds
    steps = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    function = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for step in steps:
        function = after[step[:, None] * np.uint8(8) + function]
    width = 1
    while width < rows:  # inclusive scan: later function after earlier function
        function[width:] = np.take_along_axis(function[width:], function[:-width].astype(np.intp), 1)
        width *= 2
    state = np.full(rows, START, np.uint8)
    state[1:] = function[:-1, START]
    found = np.empty((BLOCK, rows), bool)
    for i, step in enumerate(steps):
        at = step * np.uint8(8) + state
        found[i], state = begins[at], after[at]
    return np.flatnonzero(found.T.reshape(-1)[:n])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the pair of lowest rank is merged first, of equal ranks the leftmost. O(n log n)."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 64:
        parts = [piece[i:i + 1] for i in range(n)]
        pairs = [ranks.get(piece[i:i + 2], n_ranks) for i in range(n - 1)] if (n_ranks := len(ranks) + 1) else []
        while pairs and (low := min(pairs)) < n_ranks:
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], n_ranks)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], n_ranks)
        return [ranks[p] for p in parts]
    stop, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(ranks[piece[i:i + 2]], i, i + 2) for i in range(n - 1) if piece[i:i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if j >= n or stop[j] != end or not alive[j]:
            continue  # one of the two has been merged meanwhile
        stop[i], right[i], alive[j] = end, right[j], False
        if right[i] < n:
            left[right[i]] = i
            pair = piece[i:stop[right[i]]]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], i, stop[right[i]]))
        if left[i] >= 0:
            pair = piece[left[i]:end]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], left[i], end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:stop[i]]])
        i = right[i]
    return ids


class Pieces(dict):
    """Piece -> (ids, ids as text, their bytes); filled when asked, emptied when it holds CACHE_WORDS pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}

    def __missing__(self, piece: str) -> tuple[list[int], bytes, bytes]:
        ids = merge(piece.encode(), self.ranks)
        found = ids, ",".join(map(str, ids)).encode(), b"".join([self.tokens[i] for i in ids])
        if len(piece) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[piece] = found
        return found


@cache
def pieces(path: str) -> Pieces:
    return Pieces(read_ranks(path))


def split(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Pieces of all texts in one list, and after how many of them each text ends."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = token_starts(classes(points, ends))
    edges = starts.tolist()
    found = [joined[a:b] for a, b in zip(edges, edges[1:])]  # separators are pieces of their own, the last has no edge
    return found, np.searchsorted(starts, ends)


def encode(text: str, path: str) -> list[int]:
    """Ids of one text."""
    own, _ = split([text])
    known = pieces(path)
    return [i for piece in own for i in known[piece][0]]


def decode(ids: list[int], path: str) -> bytes:
    tokens = pieces(path).tokens
    return b"".join([tokens[i] for i in ids])


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, if asked).

    ``decoded_sha256`` is taken from the bytes that the ids stand for. NULL texts are empty; repeated rows and NULL ids are
    encoded like any other; other columns are not read. No shuffle: each batch of texts is one array of code points.
    ``path`` names a file of ranks that every executor can open.
    """
    schema = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(schema + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path)
        for batch in batches:
            texts, names, at = batch.column(1).to_pylist(), batch.column(0).to_pylist(), 0
            while at < len(texts):  # a slice holds about a million characters, or one long text
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) < 1 << 20):
                    size += len(texts[stop])
                    stop += 1
                found, ends = split(texts[at:stop])
                counts, hashes, decodes, ids, begin = [], [], [], [], 0
                for end in ends.tolist():
                    infos = [known[piece] for piece in found[begin:end]]
                    csv = b",".join([x[1] for x in infos])
                    counts.append(csv.count(b",") + 1 if csv else 0)
                    hashes.append(hashlib.sha256(csv).hexdigest())
                    decodes.append(hashlib.sha256(b"".join([x[2] for x in infos])).hexdigest())
                    if with_ids:
                        ids.append([i for x in infos for i in x[0]])
                    begin = end + 1
                out = [pa.array(names[at:stop], pa.int64()), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decodes)]
                yield pa.RecordBatch.from_arrays(out + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), schema=schema)
                at = stop

    kind = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(rows, kind)
