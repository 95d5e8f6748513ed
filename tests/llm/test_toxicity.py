import random
import zlib

import numpy as np
import pytest

from aljibe.llm import toxicity

CLEAN = "the of and river stone light paper garden window summer table yellow morning walk".split()
STEMS = ("grumblo", "snarfi", "vexato")
ENDINGS = "n ra ste mi lu ko dan pel vi tor".split()


def text(dice, toxic, words=60, endings=ENDINGS[:6]):
    out = [dice.choice(CLEAN) for _ in range(words)]
    for _ in range(2 if toxic else 0):
        out[dice.randrange(words)] = dice.choice(STEMS) + dice.choice(endings)
    return " ".join(out)


@pytest.fixture(scope="module")
def model():
    dice = random.Random(1)
    kinds = [i % 4 == 0 for i in range(600)]
    others = [i % 2 == 0 for i in range(100)]
    own = toxicity.Model().fit([text(dice, k) for k in kinds], np.array(kinds))
    return own.calibrate([text(dice, k, endings=ENDINGS[4:]) for k in others], np.array(others))


def test_unseen_endings_are_caught(model):
    dice = random.Random(2)
    kinds = [i % 2 == 0 for i in range(200)]
    scores, toxic = model.scorer().score([text(dice, k, endings=ENDINGS[6:]) for k in kinds]), np.array(kinds)
    assert np.mean(scores[toxic][:, None] > scores[~toxic]) > 0.97  # pairs in the right order
    assert np.mean(scores[~toxic] < 0.5) > 0.97


def test_unseen_endings_are_predicted(model):
    dice = random.Random(2)
    kinds = np.array([i % 2 == 0 for i in range(200)])
    predicted = model.scorer().score([text(dice, k, endings=ENDINGS[6:]) for k in kinds]) >= 0.5
    assert np.mean(predicted == kinds) > 0.95 and np.mean(predicted[kinds]) > 0.9


def test_length_does_not_dilute_or_add_up(model):
    dice = random.Random(3)
    long = text(dice, False, 20_000)
    low, high = model.scorer().score([long, long + " grumblora snarfimi"])
    assert low < 0.5 <= high


@pytest.mark.parametrize("glue", [",", "_", "/", "-"])
def test_words_without_white_space_are_scored(model, glue):
    dice = random.Random(5)
    clean = [glue.join(text(dice, False, 40).split()) for _ in range(40)]
    bad = [glue.join([c, dice.choice(STEMS) + "ra", dice.choice(STEMS) + "mi", c]) for c in clean]
    low, high = model.scorer().logits(clean), model.scorer().logits(bad)
    assert (high > low).all() and np.mean(high[:, None] > low) > 0.9
    assert np.mean(model.scorer().score(bad) >= 0.5) > 0.95 and np.mean(model.scorer().score(clean) < 0.5) > 0.95
    assert all(len(w) <= toxicity.LONGEST for c in bad for w in toxicity.words_of(c))


def test_pieces_hold_every_character():
    for size in (63, 64, 71, 72, 73, 1000):
        whole = "".join(chr(0x4E00 + i) for i in range(size))
        pieces = toxicity.words_of(f"a {whole} b")
        assert pieces[0] == "a" and pieces[-1] == "b" and set("".join(pieces[1:-1])) == set(whole)
        assert all(any(whole[i:i + 8] in p for p in pieces) for i in range(size - 7))
    assert toxicity.words_of("a " + "x" * 62) == ["a", "x" * 62] and toxicity.words_of(" ") == [""]


def test_verdicts_do_not_hang_on_window_borders(model):
    clean, phrase = "river stone light paper".split(), ["grumblora", "snarfimi"]
    for at in range(3, 40):
        words = [clean[i % 4] for i in range(60)]
        words[at:at] = phrase
        starts, left, right, _ = toxicity.window_bounds(np.array([len(words)]))
        sums = toxicity.window_sums(np.array([w in phrase for w in words], float), starts, left, right)
        assert sums.max() == 2
        assert model.scorer().score([" ".join(words)])[0] >= 0.5


def test_windows_of_many_texts():
    dice = random.Random(6)
    sizes = np.array([dice.randint(1, 30) for _ in range(50)] + [1, 4, 5, 8, 9])
    values = np.arange(sizes.sum(), dtype=float)
    starts, left, right, text_starts = toxicity.window_bounds(sizes)
    want, first, at = [], [], 0
    for size in sizes.tolist():
        first.append(len(want))
        want += [values[at + i:at + min(i + 8, size)].sum() for i in range(0, max(size - 4, 1), 4)]
        at += size
    assert toxicity.window_sums(values, starts, left, right).tolist() == want and text_starts.tolist() == first


def test_every_text_has_a_score(model):
    scores = model.scorer().score(["", " ", "\u00a0", "...", "x" * 100_000, "grumblon " * 5000])
    assert ((scores >= 0) & (scores <= 1)).all() and scores[0] < 0.5
    assert model.scorer().score([]).tolist() == []


def plain_buckets(word):
    """Buckets of a word, one n-gram at a time in whole numbers: 32 bits per character and n-gram, 64 for sums and the last mixing."""
    bits, wide = (1 << 32) - 1, (1 << 64) - 1
    own = "<" + (word.lower().strip(toxicity.EDGES) or word) + ">"
    mixed = [(ord(c) + 0x9E37) * 0x85EBCA6B & bits for c in own]
    hashes = [sum((m ^ m >> 13) * (2 * i * i + 3 * i + 1) & bits for i, m in enumerate(mixed))]
    for n in toxicity.GRAMS:
        for at in range(len(own) - n + 1):
            rolling = mixed[at]
            for m in mixed[at + 1:at + n]:
                rolling = (rolling * 0x01000193 & bits) ^ m
            hashes.append(rolling + n & bits)
    spread = [(h ^ h >> 15) * 0x2C1B3C6D & wide for h in hashes]
    return [(h ^ h >> 16) % toxicity.BUCKETS for h in spread]


def plain_score(model, text):
    """Average the vectors of the n-grams of each word, then those of each window of words; softmax; the highest chance of a window."""
    words = toxicity.words_of(text)
    vectors = []
    for i, word in enumerate(words):
        held = [model.embeddings[b].astype(float) for b in plain_buckets(word)]
        shown = sum(v.any() for v in held)
        repeated = i > 0 and plain_buckets(word) == plain_buckets(words[i - 1])
        vectors.append(sum(held) / max(shown, len(held) / 2) * (not repeated))
    best = 0.0
    for at in range(0, max(len(words) - toxicity.WINDOW // 2, 1), toxicity.WINDOW // 2):
        window = sum(vectors[at:at + toxicity.WINDOW]) / toxicity.WINDOW
        low, high = window @ model.weights + model.bias
        best = max(best, 1 / (1 + np.exp(low - high)))
    return best


def test_scores_equal_a_plain_computation(model):
    dice = random.Random(8)
    texts = ["", " ", "...", "Grumblora grumblora, GRUMBLORA snarfimi", "\u4e00\u4e8c\U0001f600", "x" * 200, "river", "grumblon river " * 9]
    texts += [text(dice, i % 2 == 0, dice.randint(1, 40)) for i in range(60)]
    texts += ["_".join(text(dice, True, 12).split()) for _ in range(5)]
    dice.shuffle(texts)
    got = model.scorer().score(texts)
    assert got == pytest.approx([plain_score(model, x) for x in texts], abs=1e-5)
    assert got.min() < 0.1 and got.max() > 0.9


def test_grams_share_misspellings():
    buckets, owner = toxicity.grams(["grumblora", "grumblorra", "table"])
    one, two, three = (set(buckets[owner == i].tolist()) for i in range(3))
    assert len(one & two) > 8 and len(one & three) < 2


def test_rows_and_held_out_labels(spark, rows, with_clashes):
    dice = random.Random(4)
    data = [(i, text(dice, i % 3 == 0)) for i in range(400)] + [(None, "grumblora"), (900, None), (901, ""), (0, "again")]
    docs = with_clashes(spark.createDataFrame(data, "doc_id long, text string"))
    held = {i for i, _ in data if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    # held-out labels are all wrong: they must not matter
    labels = [(i, int(i % 3 == 0) if i not in held else int(i % 3 != 0)) for i in range(400)] + [(None, 1), (900, None)]
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.judged(docs, model).collect()
    assert len(got) == len(data) and {r.doc_id for r in got if r.held_out} == held | {None}
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    seen = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in seen]) > 0.95
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.judged(docs, model).first()["predicted"] == 0
    assert toxicity.judged(docs.where("false"), model).count() == 0
