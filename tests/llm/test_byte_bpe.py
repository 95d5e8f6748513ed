import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from aljibe.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_any_text_is_encoded_as_by_the_library(reference):
    dice = random.Random(1)
    parts = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "a", "B", "é", "1", "²", "½", "!", "''", "😀", "\x1c", "漢", "\u0301", "'S", "\x85", "\r\n", "\0"]
    for _ in range(5000):
        text = "".join(dice.choice(parts) for _ in range(dice.randrange(15)))
        assert byte_bpe.encode(text, PATH) == reference.encode_ordinary(text), repr(text)
        assert byte_bpe.decode(byte_bpe.encode(text, PATH), PATH).decode() == text


def test_long_pieces(reference):
    dice = random.Random(2)
    for text in ["x" * 5000, "ab" * 3000, "é" * 700, "1234567890" * 300, "".join(dice.choice("abcdefgh") for _ in range(4000)), " " * 3000]:
        assert byte_bpe.encode(text, PATH) == reference.encode_ordinary(text)


def test_blocks_do_not_show(reference, monkeypatch):
    text = "it's  a 'test' of 12 blocks\n\n we'll see; " * 40
    for block in (1, 3, 64):
        monkeypatch.setattr(byte_bpe, "BLOCK", block)
        assert byte_bpe.encode(text, PATH) == reference.encode_ordinary(text)


def test_rows(spark, reference, with_clashes):
    texts = [None, "", " ", "plain words", "l'été 2024", "w" * 100_000, "plain words"]
    docs = with_clashes(spark.createDataFrame(list(enumerate(texts)) + [(None, "x")], "doc_id long, text string"))
    got = {r.doc_id: r for r in byte_bpe.encoded(docs, PATH, with_ids=True).collect()}
    for i, text in [*enumerate(texts), (None, "x")]:
        ids = reference.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids, got[i].ids_sha256) == (len(ids), ids, digest)
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.encoded(docs.where("false"), PATH).count() == 0
