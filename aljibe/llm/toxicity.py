"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aljibe.llm.names import unused
from aljibe.session import staged

BUCKETS, WIDTH, GRAMS, WINDOW = 1 << 17, 4, (3, 4, 5), 8
SAMPLE_DOCS = {1: 2000, 0: 4000}  # labelled documents of each class that are learnt from, at most
SAMPLE_CHARS = 3_000  # longer documents are scored, but not learnt from
ROUNDS, RATE, DECAY = 40, 0.12, 1e-6
CALIBRATION_DOCS, CALIBRATION_CHARS, CLEAN_WEIGHT = {1: 400, 0: 2000}, 40_000, 3.0  # of any length up to this one
CACHE_WORDS = 250_000
LONGEST, PIECE = 62, 16  # longer strings without white space are read as pieces that overlap by half
EDGES = ".,;:!?\"'()[]|"


def words_of(text: str) -> list[str]:
    """The words of a text; each of the overlapping pieces of a string of more than LONGEST characters is one, so that every character counts."""
    found = text.split()
    if max(map(len, found), default=0) <= LONGEST:
        return found or [""]
    out: list[str] = []
    for word in found:
        if len(word) <= LONGEST:
            out.append(word)
        else:
            out += [word[at:at + PIECE] for at in range(0, len(word) - PIECE // 2, PIECE // 2)]
    return out or [""]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of all words and of the words themselves, borders marked; and the word each belongs to."""
    marked = ["<" + (w.lower().strip(EDGES) or w) + ">" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    begin = np.cumsum(sizes) - sizes
    left = np.repeat(begin + sizes, sizes) - np.arange(len(points))  # characters up to the end of the word
    mixed = (points + np.uint32(0x9E37)) * np.uint32(0x85EBCA6B)
    place = np.arange(len(points), dtype=np.uint32) - np.repeat(begin, sizes).astype(np.uint32)
    whole = np.add.reduceat((mixed ^ (mixed >> 13)) * (2 * place * place + 3 * place + 1), begin)
    found, owners = [whole], [np.arange(len(words), dtype=np.int32)]
    owner, rolling = np.repeat(owners[0], sizes), mixed.copy()
    for n in range(2, max(GRAMS) + 1):
        rolling = rolling[:-1] * np.uint32(0x01000193) ^ mixed[n - 1:] if len(rolling) > 1 else rolling[:0]
        if n in GRAMS:
            fits = left[:len(rolling)] >= n
            found.append(rolling[fits] + np.uint32(n))
            owners.append(owner[:len(rolling)][fits])
    hashed, owners = np.concatenate(found), np.concatenate(owners)
    hashed = (hashed ^ (hashed >> 15)) * np.uint32(0x2C1B3C6D)
    return ((hashed ^ (hashed >> 16)) % BUCKETS).astype(np.int32), owners


class Model:
    """Embeddings of the buckets and a softmax over two classes."""

    def __init__(self, seed: int = 7):
        random = np.random.default_rng(seed)
        self.embeddings = random.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
        self.weights = random.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
        self.bias = np.array([4.0, 0.0], np.float32)  # few windows are toxic

    def fit(self, texts: list[str], toxic: np.ndarray, rounds: int = ROUNDS) -> Model:
        """Gradient descent (Adam) over all texts in each round.

        The vectors of the n-grams of a word are averaged, the vectors of WINDOW words too (windows overlap by half, a short last
        one is filled with zeros); the softmax gives each window a probability, and a text is toxic if any window is: long texts do not dilute a few words.
        """
        if not toxic.any() or toxic.all():
            return self
        names: dict[str, int] = {}
        words, sizes = [], []
        for text in texts:
            own = [names.setdefault(w, len(names)) for w in words_of(text)]
            words.append(np.array(own, np.int32))
            sizes.append(len(own))
        listed, step = list(names), 50_000
        bags = [grams(listed[at:at + step]) for at in range(0, len(listed), step)]
        parts = np.concatenate([bag for bag, _ in bags])
        owner = np.concatenate([of + np.int32(i * step) for i, (_, of) in enumerate(bags)])
        del bags
        bag_sizes = np.bincount(owner)
        sizes = np.array(sizes)
        words, (starts, left, right, text_starts) = np.concatenate(words), window_bounds(sizes)
        once = first_of_run(words, np.cumsum(sizes) - sizes)
        of_half = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(words))))
        of_text = np.repeat(np.arange(len(texts)), np.diff(np.append(text_starts, len(left))))
        want = toxic.astype(np.float64)
        model = [self.embeddings, self.weights, self.bias]
        first, second = [np.zeros_like(x) for x in model], [np.zeros_like(x) for x in model]
        for step in range(1, rounds + 1):
            vectors, w, b = model
            direction = w[:, 1] - w[:, 0]
            of_parts = vectors @ direction  # averaging is linear: the dot products of buckets are averaged instead of their vectors
            of_words = added_up(owner, of_parts, parts, len(names)) / bag_sizes
            logit = window_sums(of_words[words] * once, starts, left, right) / WINDOW + (b[1] - b[0])
            chance = 1 / (1 + np.exp(-np.clip(logit, -30, 15)))
            whole = -np.expm1(np.add.reduceat(np.log1p(-chance), text_starts))
            pull = chance * (1 - want / np.maximum(whole, 1e-9))[of_text] / len(texts)
            both = np.bincount(left, pull, len(starts)) + np.bincount(right[right >= 0], pull[right >= 0], len(starts))
            per_word = np.bincount(words, (both / WINDOW)[of_half] * once, len(names)) / bag_sizes
            slope_parts = added_up(parts, per_word, owner, BUCKETS).astype(np.float32)
            slope_w = slope_parts @ vectors
            slopes = [slope_parts[:, None] * direction + DECAY * vectors, np.stack([-slope_w, slope_w], 1) + DECAY * w,
                      np.array([-pull.sum(), pull.sum()], np.float32)]
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.99 * second[i] + 0.01 * slope ** 2
                model[i] = model[i] - RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
        self.embeddings, self.weights, self.bias = model
        self.embeddings[np.bincount(parts, minlength=BUCKETS) == 0] = 0  # what no text has shown says nothing
        return self

    def calibrate(self, texts: list[str], toxic: np.ndarray) -> Model:
        """Move the bias so that 0.5 tells texts apart best that were not learnt from; a clean text called toxic counts CLEAN_WEIGHT times."""
        if toxic.any() and not toxic.all():
            scorer = self.scorer()
            logits = np.concatenate([scorer.logits(part) for part in slices(texts)])
            edges = np.unique(logits)
            limits = np.concatenate([[edges[0] - 1], (edges[1:] + edges[:-1]) / 2, [edges[-1] + 1]])
            wrong = np.array([np.mean(logits[toxic] < limit) + CLEAN_WEIGHT * np.mean(logits[~toxic] >= limit) for limit in limits])
            best = limits[wrong <= wrong.min() + 1e-9]
            self.bias[1] = min(self.bias[1] - (best[0] + best[-1]) / 2, self.bias[0] - 0.5)  # no words, not toxic
        return self

    def scorer(self) -> Scorer:
        return Scorer(self.embeddings @ (self.weights[:, 1] - self.weights[:, 0]), float(self.bias[1] - self.bias[0]))


def window_bounds(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows that overlap by half, of texts of so many words (at least 1 each).

    Gives the starts of the half windows; the left and the right half of each window (-1 where a text has one half only); and the first
    window of each text.
    """
    half = WINDOW // 2
    halves = -(-sizes // half)
    first = np.cumsum(halves) - halves
    starts = np.repeat(np.cumsum(sizes) - sizes, halves) + (np.arange(halves.sum()) - np.repeat(first, halves)) * half
    counts = np.maximum(halves - 1, 1)
    text_starts = np.cumsum(counts) - counts
    left = np.arange(counts.sum()) - np.repeat(text_starts - first, counts)
    right = np.where(np.repeat(halves, counts) > 1, left + 1, -1)
    return starts, left, right, text_starts


def window_sums(values: np.ndarray, starts: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sums of the values of the words of each window."""
    halves = np.append(np.add.reduceat(values, starts), 0)  # the last one stands for a half that is not there
    return halves[left] + halves[right]


def slices(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, a few million characters at a time, or one long text."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < 1 << 21):
            size += len(texts[stop])
            stop += 1
        yield texts[at:stop]
        at = stop


def added_up(groups: np.ndarray, values: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """Sums of ``values[at]`` per group, in slices that keep copies small."""
    out, step = np.zeros(count), 1 << 21
    for i in range(0, len(groups), step):
        out += np.bincount(groups[i:i + step], values[at[i:i + step]], count)
    return out


def first_of_run(words: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """1 for each word but 0 where it repeats the word before it in its text: a repeated word counts once."""
    once = np.ones(len(words), np.float32)
    once[1:] = words[1:] != words[:-1]
    once[text_starts] = 1
    return once


class Scorer(dict):
    """Word -> what it adds to the logit, from the average of its n-gram vectors; words are added as texts bring them.

    N-grams that no learnt text has shown are left out of the average as long as half of the word's are known: an unseen
    ending does not weaken a known stem, and a single known n-gram does not stand for a whole word.
    """

    def __init__(self, buckets: np.ndarray, bias: float):
        super().__init__()
        self.buckets, self.bias = buckets.astype(np.float64), bias

    def __reduce__(self):
        return Scorer, (self.buckets, self.bias)

    def learn(self, words: set[str]) -> None:
        """Add the values of words that are not held yet."""
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(words)
        for at in range(0, len(new), 100_000):
            part = new[at:at + 100_000]
            buckets, owner = grams(part)
            told, size = self.buckets[buckets], np.bincount(owner, minlength=len(part))
            shown = np.bincount(owner, told != 0, len(part))
            values = np.bincount(owner, told, len(part)) / np.maximum(shown, size / 2)
            self.update(zip(part, values.tolist()))

    def logits(self, texts: list[str]) -> np.ndarray:
        """Logit of the most toxic window of each text; a text without words is one empty window.

        Unlike "any window", on which short texts are fitted, it does not grow with the mere length of a text.
        """
        words, sizes = [], []
        for text in texts:
            own = words_of(text)
            words += own
            sizes.append(len(own))
        self.learn(set(words))
        sizes = np.array(sizes)
        starts, left, right, text_starts = window_bounds(sizes)
        values = np.fromiter(map(self.__getitem__, words), np.float64, len(words))
        logit = window_sums(values * first_of_run(values, np.cumsum(sizes) - sizes), starts, left, right) / WINDOW + self.bias
        return np.maximum.reduceat(logit, text_starts)

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability that each text is toxic."""
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30))) if texts else np.empty(0)


def is_held_out(doc_id: Column) -> Column:
    """Documents that no label may be learnt from: crc32 of the id as text, modulo 5, is 0. A NULL id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("bigint").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on SAMPLE_DOCS short documents of each class, calibrate on CALIBRATION_DOCS others of any usual length. Runs jobs.

    Documents are chosen by the hash of their id. Ids with differing labels and held-out ids are not learnt from. The driver gets
    at most SAMPLE_CHARS characters of each learnt and CALIBRATION_CHARS of each other document. Without both classes the model scores everything low.
    """
    label = labels.filter(F.col(label_col).isin(0, 1) & ~is_held_out(F.col(id_col))).select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).alias("_toxic"))
    agreed = label.groupBy("_id").agg(F.min("_toxic").alias("toxic"), F.max("_toxic").alias("most")).filter("toxic = most").drop("most")
    rows = docs.filter(F.length(F.col(text_col)) <= CALIBRATION_CHARS).select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("text"))
    known = staged(rows.select("_id", F.length("text").alias("size")).groupBy("_id").agg(F.max("size").alias("size")).join(agreed, "_id"))
    parts = []
    for kind in (1, 0):
        for use, few, longest in (("fit", SAMPLE_DOCS[kind], SAMPLE_CHARS), ("calibrate", CALIBRATION_DOCS[kind], CALIBRATION_CHARS)):
            of_use = (F.pmod(F.xxhash64("_id", F.lit("use")), F.lit(5)) == 0) == (use == "calibrate")
            fits = known.filter((F.col("toxic") == kind) & (F.col("size") <= longest) & of_use)
            parts.append(fits.orderBy(F.xxhash64("_id"), "_id").limit(few).withColumn("use", F.lit(use)))
    chosen = staged(reduce(DataFrame.union, parts))
    found = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "toxic", "use").agg(F.min("text").alias("text")).orderBy("_id").collect()
    sets = {use: ([r.text for r in found if r.use == use], np.array([r.toxic == 1 for r in found if r.use == use], bool)) for use in ("fit", "calibrate")}
    return Model().fit(*sets["fit"]).calibrate(*sets["calibrate"])


def score_column(model: Model, text: Column) -> Column:
    """Probability that ``text`` is toxic. NULL texts are empty."""
    shared = model.scorer()

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = [shared.score(part) for part in slices(texts.tolist())]
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    return score(F.coalesce(text, F.lit("")))


def judged(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. Repeated rows are scored alike; other columns are not read."""
    scored = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), score_column(model, F.col(text_col)).alias("score"))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below 0.5, all columns as they are."""
    columns, score = docs.columns, unused(docs, "_score")
    return docs.withColumn(score, score_column(model, F.col(text_col))).filter(F.col(score) < 0.5).select(*[F.col(f"`{c}`") for c in columns])
