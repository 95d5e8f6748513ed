import hashlib
import struct
from types import SimpleNamespace

import pytest
import zstandard

from aljibe.llm import warc

LONG = "<p>é</p>" * 200
PAGES = [(1, "http://a/", LONG), (2, None, LONG), (3, "http://b\r\nX: y", LONG), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, "u", LONG), (8, "u", "x" * 300_000), (3, "again", LONG)]


def expected(pages):
    best = {}
    for i, _, t in pages:
        b = (t or "").encode()
        if len(b) >= 1000 and i is not None:
            best[b] = max(best.get(b, i), i)
    out = []
    for i, _, t in pages:
        b = (t or "").encode()
        target = best.get(b)
        revisit = target is not None and target != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, rows, with_clashes):
    pages = with_clashes(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    got = warc.archived(pages).cache()
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected(PAGES)
    payloads = {(r.page_id, r.payload_digest): r.payload for r in got.collect() if r.record_type == "response"}
    assert bytes(payloads[8, hashlib.sha1(b"x" * 300_000).hexdigest()]) == b"x" * 300_000
    assert {r.url for r in got.where("page_id = 3").collect()} == {"http://b%0D%0AX:%20y", "again"}


def test_the_dictionary_leads_every_archive(spark, tmp_path, rows):
    pages = [(i, f"http://h/{i}", "<html><head><title>news</title></head><body>" + f"<p>page {i} " * 30) for i in range(400)]
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), str(tmp_path / "w"))
    files = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    for file in files:
        data = file.read_bytes()
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8:8 + size])
        plain = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data[8 + size:], read_across_frames=True).read()
        assert plain == b"".join(warc.frames(data)) and plain.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    read = warc.read_archives(spark, str(tmp_path / "w"))
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in read.collect()) == [(i, t) for i, _, t in pages]


def test_damage_is_noticed():
    raw = warc.record(1, "u", b"payload", None)
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw.replace(b"payload\r", b"pAyload\r"))


def test_an_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_frames_are_cut_out_one_by_one(monkeypatch):
    """Every byte of an archive is given to the decompressor once; frames of raw, repeated and several blocks, with checksums or without size."""
    data = [b"", b"a", b"x" * 400_000, bytes(range(256)) * 2000, hashlib.sha512(b"1").digest() * 4000, b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(9000))]
    archive = struct.pack("<II", 0x184D2A53, 3) + b"any"
    for i, one in enumerate(data * 2):
        archive += zstandard.ZstdCompressor(level=1 + i, write_checksum=i % 2 == 0, write_content_size=i % 3 > 0).compress(one)
        archive += warc.SEPARATOR.encode()
    given, make = [], zstandard.ZstdDecompressor

    def counting(**kwargs):
        plain = make(**kwargs)
        return SimpleNamespace(decompressobj=lambda: SimpleNamespace(decompress=lambda part: given.append(len(part)) or plain.decompressobj().decompress(part)))

    monkeypatch.setattr(warc.zstandard, "ZstdDecompressor", counting)
    assert list(warc.frames(archive)) == data * 2
    assert sum(given) == len(archive) - 11 - 8 * len(data) * 2
