import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from aljibe.llm import runs


def brute(words):
    """All maximal runs (start, length, period) by comparing every word with every word before it."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def brute_row(doc_id, text, loop=True):
    words = [w for w in text.translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if loop and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    power = None if not found else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, power, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def of(words):
    found = runs.runs_of(np.array(words, np.int64), np.zeros(len(words), np.int64))
    return [(s, e - s, q) for s, e, q in zip(found.start.tolist(), found.stop.tolist(), found.period.tolist())]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90))
def test_runs_of_few_words_equal_brute_force(words):
    assert of(words) == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 5), st.integers(0, 30)), max_size=5))
def test_planted_powers_equal_brute_force(parts):
    words = [w for root, times, extra in parts for w in (root * (times + 1))[: len(root) * times + extra]]
    assert of(words) == brute(words)


def test_every_period_is_caught_at_every_place():
    for q in range(1, 80):
        for before in range(0, 40, 7):
            root = list(range(100, 100 + q))
            words = [*range(before), *(root * 13)[: max(12, 2 * q)], 7]
            assert of(words) == [(before, max(12, 2 * q), q)]
            short = [*range(before), *(root * 13)[: max(12, 2 * q) - 1], 7]
            assert of(short) == []


def test_runs_end_with_the_document():
    words, owner = np.zeros(30, np.int64), np.repeat([0, 1], [11, 19])
    found = runs.runs_of(words, owner)
    assert (found.start.tolist(), found.stop.tolist(), found.period.tolist()) == ([11], [30], [1])


def test_comparisons_grow_by_n_log_n(monkeypatch):
    """One word over and over has squares of all periods: the pairs that are looked at stay within 2 n per level."""
    seen, caught = [], runs._caught
    monkeypatch.setattr(runs, "_caught", lambda name, size: seen.append(len((pair := caught(name, size))[0])) or pair)
    n = 1 << 14
    assert of([5] * n) == [(0, n, 1)]
    assert max(seen) <= 4 * n and len(seen) <= 16


def test_rows_of_odd_documents(spark, rows, with_clashes):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    loops = [(i, " ".join(f"w{j * j % 97}" for j in range(20 + 13 * i % 211))) for i in ids]
    plain = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a " * 12), (4, "a " * 12), (None, "b c " * 9), (None, "x y\x1cz " * 20), (5, "é\x0bè\x0c" * 30), (6, "one two"),
        (7, "word " * 30_000 + "end"), (9_000_000_000, "a b c d e f g h i j k l m n o p " * 3),
    ]
    docs = with_clashes(spark.createDataFrame(loops + plain, "doc_id long, text string")).withColumn("start", docs_column())
    assert rows(runs.periodic_runs(docs, loop=True)) == sorted([expected(*d) for d in loops + plain], key=repr)
    assert runs.periodic_runs(docs.limit(0), loop=True).collect() == []


def docs_column():
    from pyspark.sql import functions as F

    return F.lit("clash")


def expected(doc_id, text):
    if doc_id == 7:  # too long for brute force: one run, then a word
        row = brute_row(doc_id, "word " * 40 + "end", loop=False)
        return (7, 1, 0, 30_000, 1, 30_000_000, hashlib.sha256(b"0,30000,1\n").hexdigest(), row[-1])
    return brute_row(doc_id, text or "")
