"""WARC archives of individually compressed records with an embedded Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aljibe.session import shared_folder, staged

DICTIONARY_MAGIC = 0x184D2A5D  # skippable frame that holds the dictionary
SEPARATOR = "P*M\x18\x00\x00\x00\x00"  # an empty skippable frame: what Spark's text writer puts between records
DATE = "2024-01-01T00:00:00Z"
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 512, 8192, 65536
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = pa.schema([("frame", pa.binary())])
READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header only."""
    digest = hashlib.sha1(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id, digest.hex())}", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    lines += [] if url is None else [f"WARC-Target-URI: {_header_value(url)}"]
    lines += [] if page_id is None else [f"X-Page-Id: {page_id}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest.hex())}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record; raises ValueError if a length or a digest does not hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if rest[len(block):] != b"\r\n\r\n" or fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("X-Page-Id"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"),
            "payload": payload if fields["WARC-Type"] == "response" else None}


def frame_end(view: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends: after its header, its blocks, whose headers tell their sizes, and its checksum."""
    head = view[at : at + 18]
    end = at + zstandard.frame_header_size(head)
    while True:
        block = int.from_bytes(view[end : end + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        end += 3 + (1 if kind == 1 else size)  # kind 1 repeats one byte
        if last:
            return end + 4 * zstandard.get_frame_parameters(head).has_checksum


def frames(archive: bytes) -> Iterator[bytes]:
    """Decompressed records of an archive; the dictionary is taken from its leading frame. Linear: each frame is cut out before it is read."""
    view, at, dictionary = memoryview(archive), 0, None
    reader = zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC and dictionary is None:
                dictionary = zstandard.ZstdCompressionDict(bytes(view[at + 8:at + 8 + size]))
                reader = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
            continue
        end = frame_end(view, at)
        yield reader.decompressobj().decompress(view[at:end])
        at = end


def train_dictionary(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> bytes:
    """Dictionary built from the first SAMPLE_BYTES bytes of SAMPLE_RECORDS records, chosen by the hash of their id.

    Runs jobs. Rows are first thinned out by the hash to a few times the sample, so that tasks send the driver little
    more than it needs (4 MB). The sample only affects the size of the archives. Empty if there is too little to learn from.
    """
    share = min(1.0, 8 * SAMPLE_RECORDS / max(1, pages.count()))
    hashed = F.xxhash64(id_col, F.length(html_col))
    chosen = (pages.select(hashed.alias("at"), F.col(id_col).alias("page_id"), F.substring(F.encode(html_col, "UTF-8"), 1, SAMPLE_BYTES).alias("start"))
              .filter((F.pmod("at", F.lit(1 << 30)) < int(share * (1 << 30))) & (F.octet_length("start") > 0))
              .orderBy("at", "page_id").limit(SAMPLE_RECORDS).collect())
    samples = [record(r.page_id, None, bytes(r.start), None) for r in chosen]
    if sum(map(len, samples)) < 16 * 1024 or len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # all samples alike
        return b""


def revisits(pages: DataFrame, least: int, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``digest`` and ``target`` of the payloads of at least ``least`` bytes that several rows share. Runs a job.

    Only digests are shuffled, counted per task first.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    digests = pages.filter(F.octet_length(payload) >= least).select(F.unhex(F.sha1(payload)).alias("digest"), F.col(id_col).alias("page_id"))
    return staged(digests.groupBy("digest").agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("rows"))
                  .filter("rows > 1 and target is not null").select("digest", "target"))


def write_archives(pages: DataFrame, path: str, least: int = 1000, level: int = 3,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a record per row of ``pages`` to archives below ``path``, one archive per task. Runs jobs.

    Each archive begins with a skippable frame that holds the dictionary; each record is a frame of its own.
    Of equal payloads of at least ``least`` bytes, the row with the largest id is the response (repeated
    rows of that id are responses too) and the others are revisits of it. NULL payloads are empty; a NULL id is never
    referred to; a NULL URL has no header line. Other columns are not read.

    Spark's text writer commits the files, so a task that is run again leaves no traces; the line separator
    it writes after each record is an empty skippable frame, which decoders pass over. An archive is as large
    as the input split of its task, at most.
    """
    dictionary = train_dictionary(pages, id_col, html_col)
    shared = revisits(pages, least, id_col, html_col)
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.when(F.octet_length(payload) >= least, F.unhex(F.sha1(payload))).alias("own"))
    joined = rows.join(shared, F.col("own") == F.col("digest"), "left")
    refers = F.when(F.col("target") != F.coalesce("page_id", F.col("target") - 1), F.col("target"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=True)
        lead = [struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary] if dictionary else []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            out = lead + [writer.compress(record(i, u, p, t)) for i, u, p, t in zip(*columns)]
            lead = []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=WRITTEN)

    framed = joined.select("page_id", "url", "payload", refers.alias("refers_to")).mapInArrow(archive, "frame binary")
    framed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (NULL for revisits). A damaged record raises."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                found = []
                for raw in frames(cell.as_buffer().to_pybytes()):
                    found.append(parse(raw))
                    if len(found) == 500:
                        yield pa.RecordBatch.from_pylist(found, schema=READ)
                        found = []
                yield pa.RecordBatch.from_pylist(found, schema=READ)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(
        records, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")


def archived(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write archives of ``pages`` to the shared folder and read them back: the columns of ``read_archives``. Runs jobs."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least)
    return read_archives(spark, path)
