"""Dictionary-compressed WARC archives (.warc.zst) written and read by Spark.

An archive starts with a skippable frame that holds a Zstandard dictionary;
every record is one frame compressed with it, so records can be read alone.
The dictionary is built from records of the same table: a bounded sample by
hash. Between frames stands an empty skippable frame, which any Zstandard
reader passes over; as its eight bytes are plain text, Spark's text writer puts
it there as the line separator, so archives go through Spark's own output
commit to any file system, and a lost task leaves no half-written file.

Payloads of at least ``REVISIT_FROM`` bytes that occur more than once are
stored once, under the largest page_id; the others become revisit records.
"""

from __future__ import annotations

import hashlib
import struct
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store

REVISIT_FROM = 1000
#: bytes of payload in an archive, about
ARCHIVE_BYTES = 16 << 20
#: records that the dictionary is built from, and the bytes read of each
SAMPLE, SAMPLE_BYTES = 400, 1 << 14
DICTIONARY_BYTES = 1 << 16
LEVEL = 6
#: records that a task holds at once
ROWS_AT_ONCE = 64
#: bytes of an archive that the reader decompresses at once
PIECE = 1 << 14
#: fixed values of the formats
DICTIONARY_MAGIC = 0x184D2A5D
GAP = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
DATE = "2026-01-01T00:00:00Z"


def payloads(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn(
        "payload_bytes", F.length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))


def plan(pages: DataFrame, parts: int) -> DataFrame:
    """Each page with payload, payload_bytes, payload_digest, record_type and
    refers_to, dealt over ``parts`` partitions.

    The revisits are found on ids and digests alone; payloads move once, dealt
    by digest and page so that copies of one payload spread over all parts."""
    known = payloads(pages)
    keys = ["payload_digest", "payload_bytes"]
    large = known.filter(F.col("payload_bytes") >= REVISIT_FROM).select(*keys, "page_id")
    last = large.groupBy(*keys).agg(F.max("page_id").alias("last"), F.min("page_id").alias("least")).filter(
        "least < last").drop("least")
    again = store(large.join(last, keys).filter("page_id < last").distinct(), "revisits")
    # a null id is dealt by its url; it matches nothing that is used below
    at = [*keys, "at"]
    pages = known.withColumn("at", F.coalesce("page_id", F.xxhash64("url"))).repartition(parts, *at)
    again = again.withColumnRenamed("page_id", "at").repartition(parts, *at)
    revisit = F.col("last").isNotNull() & F.col("page_id").isNotNull()
    return pages.join(again, at, "left").select(
        "page_id", "url", "payload", *keys, F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last")).alias("refers_to"))


def dictionary(pages: DataFrame) -> bytes:
    """A dictionary from the payloads with the smallest hashes; raw content
    where there is too little to build one from. The hashes are chosen first,
    so that no more than the sample comes to the driver."""
    rows = payloads(pages).select(F.xxhash64(F.lit("warc"), "payload_digest").alias("key"), "payload")
    keys = [r.key for r in rows.select("key").distinct().orderBy("key").limit(SAMPLE).collect()]
    found = rows.filter(F.col("key").isin(keys)).groupBy("key").agg(F.min(F.substring("payload", 1, SAMPLE_BYTES)).alias("part"))
    parts = [bytes(r.part) for r in sorted(found.collect(), key=lambda r: r.key)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record(row: dict) -> bytes:
    """One WARC/1.1 record."""
    payload = bytes(row["payload"])
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http if row["record_type"] == "revisit" else http + payload
    page = "" if row["page_id"] is None else str(row["page_id"])
    url = "".join(c for c in row["url"] or "" if c not in "\r\n")
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Date: {DATE}",
        f"WARC-Record-ID: <urn:x-page:{page}:{hashlib.sha1((row['payload_digest'] + '|' + page + '|' + url).encode('utf-8', 'surrogatepass')).hexdigest()}>",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", f"X-Page-ID: {page}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if row["record_type"] == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page: {row['refers_to']}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one record; the payload's length and digest are taken
    from the payload itself where the record holds it."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or len(body) != int(fields["Content-Length"]) or rest[len(body):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = body.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("a payload differs from its digest")
    page, to = fields.get("X-Page-ID", ""), fields.get("X-Refers-To-Page", "")
    return {"page_id": int(page) if page else None, "url": fields["WARC-Target-URI"], "record_type": kind,
            "payload_bytes": int(fields["X-Payload-Length"]) if payload is None else len(payload),
            "payload_digest": digest, "refers_to": int(to) if to else None, "payload": payload}


def write(pages: DataFrame, path: str) -> None:
    """Write the records as archives of about ``ARCHIVE_BYTES`` under path."""
    total = payloads(pages).agg(F.sum(F.col("payload_bytes") + 500)).first()[0] or 0
    archives = max(1, -(-total // ARCHIVE_BYTES))
    words = dictionary(pages)

    def frames(batches):
        known = zstandard.ZstdCompressionDict(words) if words else None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        lead = struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words
        for batch in batches:
            columns = [batch.column(c) for c in batch.schema.names]
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = [c.slice(a, ROWS_AT_ONCE).to_pylist() for c in columns]
                out = [pack.compress(record(dict(zip(batch.schema.names, row)))) for row in zip(*part)]
                out[0], lead = lead + out[0], b""
                yield pa.RecordBatch.from_pydict({"frame": pa.array(out, type=pa.binary())})

    plan(pages, archives).mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option(
        "lineSep", GAP).option("compression", "none").text(path)


def records(data: bytes):
    """The decompressed records of one archive, in order."""
    data = memoryview(data)
    at, unpack = 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at) if len(data) - at >= 8 else (0, 0)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC and size:
                unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[at + 8:at + 8 + size])))
            at += 8 + size
            continue
        # fed in pieces, as what follows the frame is handed back as a copy
        one, parts = unpack.decompressobj(), []
        while not one.eof:
            if at >= len(data):
                raise ValueError("an archive is cut off")
            piece = data[at:at + PIECE]
            parts.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(parts)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives under path: page_id, url, record_type,
    payload_bytes, payload_digest, refers_to, payload. Every payload is checked
    against its digest; ``payload=False`` leaves the column null."""
    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                found = (parse(raw) for raw in records(content.as_buffer()))
                if not payload:
                    found = (fields | {"payload": None} for fields in found)
                while part := list(islice(found, ROWS_AT_ONCE)):
                    yield pa.RecordBatch.from_pylist(part, schema=_FIELDS)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, "
                            "payload_digest string, refers_to long, payload binary")


_FIELDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages (page_id, url, html)`` as archives under path and read
    them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    * null html: an empty payload; null url: an empty target;
    * null page_id: written as its own response, refers to nothing;
    * repeated rows: rows of one page_id and payload are each a response, as
      none has a smaller id than the largest;
    * equal payloads under 1000 bytes are each a response; extra columns are
      not read; an empty table gives an empty result.
    """
    write(pages, path)
    return read(pages.sparkSession, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
