import random
import re

import numpy as np
import pytest
import xxhash

from aljibe.llm import simhash
from aljibe.llm.components import components


def plain_fingerprint(text, shingle=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints():
    for text in ["", " \n", "one", "A b C", "a b c d", "a b c d e", "İ é\u00a0É x Y z", "w " * 1000, " ".join(map(str, range(70_000)))]:
        assert simhash.fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)


def test_equals_brute_force(spark, rows, with_clashes):
    dice = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(40):
        text = [dice.choice(words) for _ in range(dice.choice([3, 60, 400]))]
        for _ in range(dice.choice([1, 1, 6])):
            docs.append(" ".join(w if dice.random() > 0.01 else dice.choice(words) for w in text))
    docs += [None, "", " \t", docs[0], docs[0].upper()]
    data = list(enumerate(docs, 10)) + [(None, docs[0]), (None, "nobody else"), (10, docs[0])]
    got = simhash.near_duplicates(with_clashes(spark.createDataFrame(data, "doc_id long, text string")))
    prints = [plain_fingerprint(t) for _, t in data]
    links = [(i, j) for i in range(len(data)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    of = groups(range(len(data)), links)
    smallest = {}
    for place, (i, _) in enumerate(data):
        smallest[of[place]] = min((x for x in (smallest.get(of[place]), i) if x is not None), default=None)
    want = [(i, f"{prints[place]:016x}", smallest[of[place]]) for place, (i, _) in enumerate(data)]
    assert rows(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)


@pytest.mark.parametrize("group", [2, 16, 4096])
def test_crowded_buckets_lose_no_component(spark, group):
    dice = random.Random(group)
    centre = dice.getrandbits(64)
    points = {dice.getrandbits(64) for _ in range(200)}
    for _ in range(250):  # a crowd around one fingerprint, and chains away from it
        near = centre
        for _ in range(dice.choice([1, 2, 5, 9])):
            near ^= 1 << dice.randrange(64)
        points.add(near)
    points = sorted(points)
    signed = [p - 2**64 if p >> 63 else p for p in points]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4, group).collect()
    table = np.array(points, np.uint64)
    all_links = [(i, j) for i in range(len(points)) for j in range(i) if (points[i] ^ points[j]).bit_count() <= 4]
    place = {p: i for i, p in enumerate(signed)}
    found = [(place[a], place[b]) for a, b in links]
    assert all(int(np.bitwise_count(table[a] ^ table[b])) <= 4 for a, b in found)
    assert groups(range(len(points)), found) == groups(range(len(points)), all_links)
    if group == 4096:
        assert len(found) < len(all_links)  # a spanning forest, not all pairs


def test_components(spark, rows):
    dice = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(dice.randrange(60), dice.randrange(60)) for _ in range(40)] + [(7, 7)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert rows(got) == sorted(groups(nodes, [(a, b) for a, b in links if a != b]).items(), key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(spark, rows, with_clashes):
    text = " ".join(f"w{i}" for i in range(500))
    near = text.replace("w7 ", "W7x ")
    data = [(5, text), (3, near), (9, "something else"), (9, "something else"), (None, text), (None, "nobody"), (None, "nobody"), (4, None)]
    docs = with_clashes(spark.createDataFrame(data, "doc_id long, text string"))
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    assert rows(got, "doc_id", "text") == sorted([(3, near), (9, "something else"), (None, "nobody"), (4, None)], key=repr)
    assert simhash.one_of_each(docs.where("false")).count() == 0
