"""Packing of documents into sequences: order-preserving dynamic programming over document and sentence boundaries."""

from __future__ import annotations

import re
import struct
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LENGTH = 2048
END_ID = 1
SENTENCE_PENALTY = 2.0  # a cut at the end of a sentence inside a document, in tokens of padding
WORD_PENALTY = 16.0  # a cut inside a sentence
CHUNK_TOKENS = 1 << 19
CACHE_WORDS = 400_000  # words of a generation
ENDS = (".", "!", "?", "。")
SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
BYTE_LETTERS = {}


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: printable bytes stand for themselves, others follow from 256."""
    if not BYTE_LETTERS:
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        BYTE_LETTERS.update({b: chr(b if b in own else next(rest)) for b in range(256)})
    return BYTE_LETTERS


PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


def packed_ids(ids: list[int]) -> bytes:
    return PACK[len(ids)](*ids) if len(ids) < len(PACK) else struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Word between ASCII white space, A-Z as small letters -> its ids, 4 bytes each; filled when asked.

    The tokenizer drops white space, never looks across it and turns capitals small, so words can be encoded on their own. Words of Latin
    letters with an optional full stop or comma go straight to its merges, without the stop; all others through the whole tokenizer.
    ``renew`` begins a new generation and keeps the last one to take words from, so a word in use is never encoded again, and no more
    than two generations are held. ``closes`` tells of each id whether a word that ends with it may end a sentence.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        letters = byte_letters()
        ends = tuple("".join(letters[b] for b in end.encode()) for end in ENDS)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.removesuffix(self.tokenizer.model.end_of_word_suffix or "").endswith(ends)]] = True
        self.renew()

    def renew(self) -> None:
        self.last = dict(self)
        self.clear()

    def merged(self, letters: str) -> bytes:
        return packed_ids([t.id for t in self.tokenizer.model.tokenize(letters)])

    def encoded(self, raw: bytes) -> bytes:
        if raw.isalpha():
            return self.merged(raw.decode())
        if raw.endswith((b".", b",")) and raw[:-1].isalpha():
            return self[raw[:-1]] + self[raw[-1:]]
        word = raw.decode()
        simple = SIMPLE.fullmatch(word)
        if simple and simple[2]:
            return self[simple[1].encode()] + self[simple[2].encode()]
        if simple:
            return self.merged(word.lower().encode().decode("latin-1").translate(byte_letters()))
        return packed_ids(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def __missing__(self, raw: bytes) -> bytes:
        found = self.last.get(raw)
        if found is None:
            found = self.encoded(raw)
        self[raw] = found
        return found


@cache
def words(path: str) -> Words:
    return Words(path)


def tokenized(text: bytes, known: Words, cache_words: int | None = None) -> tuple[bytes, np.ndarray]:
    """Ids of a UTF-8 text as little-endian bytes, and after how many of them its sentences end.

    ``bytes.split`` cuts at ASCII white space alone; other white space stays inside words, for the tokenizer to drop.
    """
    if len(known) > (cache_words or CACHE_WORDS):
        known.renew()
    found = list(map(known.__getitem__, text.lower().split()))
    ids = b"".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) >> 2
    ends = ends[ends > 0]
    return ids, np.unique(ends[known.closes[np.frombuffer(ids, "<u4")[ends - 1]]])


def cuts(boundaries: np.ndarray, penalties: np.ndarray, length: int = LENGTH) -> list[int]:
    """Positions to cut at: the cheapest way to a boundary at most ``length`` before the last one.

    ``boundaries`` are increasing positions after 0, at most ``length`` apart; ``penalties`` what a cut there costs. A window
    of n tokens costs length - n tokens of padding, or nothing if n is a power of two. Dynamic programming: to reach position p
    from start s costs cost[s] + length - (p - s), so the best start has the least cost[s] + s and a monotone queue holds it;
    starts a power of two back are looked up.
    """
    at = np.concatenate([[0], boundaries]).astype(np.int64)
    n = len(at)
    place = np.full(int(at[-1]) + 1, -1, np.int64)
    place[at] = np.arange(n)
    reached, starts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    power = length
    while power:
        first = int(np.searchsorted(at, power))
        start = place[at[first:] - power]
        hits = np.flatnonzero(start >= 0)
        reached.append(hits + first)
        starts.append(start[hits])
        power >>= 1
    of = np.concatenate(reached)
    order = np.argsort(of, kind="stable")
    exact, upto = np.concatenate(starts)[order].tolist(), np.searchsorted(of[order], np.arange(n), "right").tolist()
    position, extra = at.tolist(), [0.0, *penalties.tolist()]
    cost, best = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, n):
        here = position[j]
        while position[queue[0][1]] < here - length:
            queue.popleft()
        low, start = queue[0]
        low += length - here
        for i in exact[upto[j - 1]:upto[j]]:
            if cost[i] < low:
                low, start = cost[i], i
        low += extra[j]
        cost[j], best[j] = low, start
        low += here
        while queue and queue[-1][0] > low:
            queue.pop()
        queue.append((low, j))
    j = min((k for k in range(n) if position[k] >= position[-1] - length), key=lambda k: (cost[k], -position[k]))
    found = []
    while j:
        found.append(position[j])
        j = best[j]
    return found[::-1]


def with_hard_cuts(ends: list[int], sentence_ends: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries of a run of documents and their penalties. Where boundaries are further apart than a quarter of
    ``length``, cuts inside the sentence are offered that far apart."""
    every = np.concatenate([np.array(ends, np.int64), *sentence_ends])
    price = np.concatenate([np.zeros(len(ends)), np.full(len(every) - len(ends), SENTENCE_PENALTY)])
    order = np.lexsort((price, every))
    every, price = every[order], price[order]
    first = np.concatenate([[True], every[1:] != every[:-1]]) & (every > 0)
    every, price = every[first], price[first]
    step = max(1, length // 4)
    gaps = np.diff(np.concatenate([[0], every]))
    wide = np.flatnonzero(gaps > step)
    if len(wide):
        added = np.concatenate([np.arange(every[i] - gaps[i] + step, every[i], step) for i in wide])
        every, price = np.concatenate([every, added]), np.concatenate([price, np.full(len(added), WORD_PENALTY)])
        order = np.argsort(every, kind="stable")
        every, price = every[order], price[order]
    return every, price


def tail(left: int, length: int) -> list[int]:
    """Lengths for the last tokens of a task: powers of two, so that none is padded."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if left >> b & 1]


class Packer:
    """Takes documents in order and gives their pieces; keeps at most CHUNK_TOKENS tokens and one document."""

    def __init__(self, first_sequence: int, length: int):
        self.sequence, self.length = first_sequence, length
        self.docs: list[tuple] = []  # doc_id, ids, tokens packed already, ends of sentences
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes, sentence_ends: np.ndarray) -> Iterator[tuple]:
        ids += END_ID.to_bytes(4, "little")
        self.docs.append((doc_id, ids, 0, sentence_ends))
        self.size += len(ids) // 4
        if self.size >= CHUNK_TOKENS:
            yield from self.flush(False)

    def flush(self, closed: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        lengths = [len(ids) // 4 - done for _, ids, done, _ in self.docs]
        ends = np.cumsum(lengths)
        inner = [stops[stops > done] - done + end - size for (_, _, done, stops), end, size in zip(self.docs, ends.tolist(), lengths)]
        at = cuts(*with_hard_cuts(ends.tolist(), inner, self.length), self.length)
        if closed:
            for size in tail(int(ends[-1]) - (at[-1] if at else 0), self.length):
                at.append((at[-1] if at else 0) + size)
        yield from self.pieces(at, ends)
        packed = at[-1] if at else 0
        kept = int(np.searchsorted(ends, packed, "right"))
        self.docs = self.docs[kept:]
        if self.docs:
            doc_id, ids, done, stops = self.docs[0]
            self.docs[0] = doc_id, ids, done + lengths[kept] - int(ends[kept] - packed), stops
        self.size = int(ends[-1]) - packed

    def pieces(self, at: list[int], ends: np.ndarray) -> Iterator[tuple]:
        doc, start = 0, 0
        for stop in at:
            offset = 0
            while start < stop:
                doc_id, ids, done, _ = self.docs[doc]
                end = int(ends[doc])
                size = min(stop, end) - start
                begin = len(ids) // 4 - (end - start)
                part = ids[4 * begin:4 * (begin + size)]
                yield doc_id, begin, size, zlib.crc32(part), len(ids) // 4, self.sequence, offset, part
                offset, start = offset + size, start + size
                doc += start == end
            self.sequence += 1


COLUMNS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
           ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]


def packed(docs: DataFrame, path: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", cache_words: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian, 32 bits each).

    Documents keep their order within an input split and fill windows of at most ``length`` tokens (a power of two), cut at the
    boundaries that make padding plus cutting cheapest; the last tokens of a split go into windows of powers of two, which need
    no padding. NULL and empty texts are the end id alone. Repeated rows and NULL ids are packed like any other row.
    Other columns are not read. No shuffle; a task keeps at most CHUNK_TOKENS tokens and one document, a worker two generations of
    ``cache_words`` words (CACHE_WORDS if not given); fewer take less memory and more time, the pieces are the same.
    ``sequence_id`` is the task's partition times 2^33 plus a running number. ``path`` names a tokenizer file on every executor.
    """
    schema = pa.schema(COLUMNS)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = words(path), []
        packer = Packer(TaskContext.get().partitionId() << 33, length)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                out.extend(packer.add(doc_id, *tokenized(text.as_buffer().to_pybytes(), known, cache_words)))
                if len(out) >= 2000:
                    yield table(out)
                    out = []
        out.extend(packer.flush(True))
        if out:
            yield table(out)

    kind = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(rows, kind)
