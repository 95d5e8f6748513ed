import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aljibe.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def padding(size, length):
    return 0 if size & (size - 1) == 0 else length - size


def least_cost(boundaries, penalties, length):
    """Cheapest cost to each boundary, by trying all pairs."""
    at, cost = [0, *boundaries], [0.0]
    for j in range(1, len(at)):
        cost.append(min(cost[i] + padding(at[j] - at[i], length) for i in range(j) if at[j] - at[i] <= length) + penalties[j - 1])
    return at, cost


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_cheapest(seed):
    dice = random.Random(seed)
    length = dice.choice([8, 16, 64])
    boundaries = np.cumsum([dice.randint(1, length // 2) for _ in range(dice.randint(1, 120))])
    penalties = np.array([dice.choice([0.0, 2.0, 16.0]) for _ in boundaries])
    found = packing.cuts(boundaries, penalties, length)
    at, cost = least_cost(boundaries.tolist(), penalties.tolist(), length)
    price = dict(zip(boundaries.tolist(), penalties.tolist()))
    spent = sum(padding(b - a, length) + price[b] for a, b in zip([0, *found], found))
    assert spent == min(c for a, c in zip(at, cost) if a >= at[-1] - length)


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_cheapest_with_all_powers_of_two(seed):
    dice = random.Random(seed)
    length = dice.choice([16, 64, 256])
    boundaries = np.cumsum([dice.randint(1, length // 4) for _ in range(dice.randint(1, 120))])
    penalties = np.array([dice.choice([0.0, 2.0, 16.0]) for _ in boundaries])
    at, cost = [0, *boundaries.tolist()], [0.0]
    for j in range(1, len(at)):
        cost.append(min(cost[i] + padding(at[j] - at[i], length) for i in range(j) if at[j] - at[i] <= length) + penalties[j - 1])
    found, price = packing.cuts(boundaries, penalties, length), dict(zip(boundaries.tolist(), penalties.tolist()))
    spent = sum(padding(b - a, length) + price[b] for a, b in zip([0, *found], found))
    assert spent == min(c for a, c in zip(at, cost) if a >= at[-1] - length)


def test_packer_uses_short_windows_that_need_no_padding():
    packer = packing.Packer(0, 64)
    sizes = [3, 60, 7, 61, 1, 63]  # with the end ids 4 + 61, 8 + 62, 2 + 64
    found = [p for i, n in enumerate(sizes) for p in packer.add(i, np.arange(n, dtype="<u4").tobytes(), np.empty(0, np.int64))]
    found += packer.flush(True)
    windows = np.bincount([p[5] for p in found], [p[2] for p in found]).astype(int).tolist()
    ends = np.cumsum([n + 1 for n in sizes])
    inner, price = packing.with_hard_cuts(ends.tolist(), [np.empty(0, np.int64)], 64)
    want = packing.cuts(inner, price, 64)
    assert np.cumsum(windows).tolist()[:len(want)] == want and min(windows[:len(want)]) < 8


def test_words_are_encoded_as_whole_texts():
    known, tokenizer = packing.Words(PATH), Tokenizer.from_file(PATH)
    texts = ["", "Plain words, here.", "L'été à Œuvre ÀÉß don't  it's\n3.14 x_y", "a\u00a0b\u2003c <|endoftext|> İI ΣΑΣ e\u0301", "\x1c x\x1fy \x85", "漢字 😀!", "w" * 3000]
    for text in texts:
        ids, _ = packing.tokenized(text.encode(), known)
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_in_use_outlive_a_generation(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    known, encoded = packing.Words(PATH), []
    encode = known.encoded
    known.encoded = lambda raw: encoded.append(raw) or encode(raw)
    texts = [" ".join(["The", "end,", *[f"{'abcdefghij'[i % 10]}{'klmno'[j % 5] * (j + 1)}." for j in range(20)]]) for i in range(30)]
    tokenizer = Tokenizer.from_file(PATH)
    for text in texts * 2:
        ids, ends = packing.tokenized(text.encode(), known)
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids and len(ends) == 20
        assert len(known) + len(known.last) <= 2 * (50 + 44)
    assert encoded.count(b"the") == encoded.count(b"end,") == encoded.count(b"end") == 1


def test_sentences_end_where_words_end():
    known = packing.Words(PATH)
    for text in ("One two. 3.14 is e.g. five! six?) no, (yes.) 終わり。 x \x1c y ...", "", "\x1c", "a. \x1c b."):
        _, ends = packing.tokenized(text.encode(), known)
        want, at = set(), 0
        for word in text.encode().split():
            at += len(known[word.lower()]) // 4
            if word.decode().endswith((".", "!", "?", "。")):
                want.add(at)
        assert ends.tolist() == sorted(want)


@pytest.mark.parametrize("length", [16, 2048])
def test_every_id_lies_in_one_piece(spark, with_clashes, length, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_TOKENS", 700)
    dice = random.Random(length)
    texts = [None, "", "one", "no end " * 4000] + [" ".join(dice.choice(["Word", "two.", "three,", "été"]) for _ in range(dice.randint(1, 900))) for _ in range(60)]
    docs = with_clashes(spark.createDataFrame(list(enumerate(texts)) + [(1, "again")], "doc_id long, text string").coalesce(2))
    pieces = packing.packed(docs, PATH, length).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts) if i != 1}
    for i, ids in want.items():
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert b"".join(p.ids for p in own) == np.array(ids, "<u4").tobytes()
        assert all(p.ids_crc32 == zlib.crc32(p.ids) and p.doc_tokens == len(ids) for p in own)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    total = padded = 0
    for members in sequences.values():
        members.sort(key=lambda p: p.offset)
        assert [p.offset for p in members] == np.cumsum([0, *[p.length for p in members]])[:-1].tolist()
        size = sum(p.length for p in members)
        assert size <= length
        total, padded = total + size, padded + padding(size, length)
    assert padded < (0.05 if length > 16 else 0.15) * total
    assert packing.packed(docs.where("false"), PATH).count() == 0
