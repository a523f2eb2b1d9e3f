"""WARC archives compressed record by record with a shared Zstandard dictionary.

The dictionary is built from records to be archived and opens every file in a skippable frame, as readers of
compressed archives expect it; each record is a frame of its own, so it can be read alone. Files are written
and committed by the engine's text writer, so a lost task leaves nothing behind and any store the engine
reaches will do: a record is a "line", and the line end is an empty skippable frame, which decoders pass over.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.keys import group
from ledgerline.session import new_folder

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)  # bytes below 128, so it can be a line end
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2024-01-01T00:00:00Z"
LEVEL = 3
# The dictionary is fitted on about so many records, each at most so long.
SAMPLE_ROWS = 1500
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """A response record, or a revisit record without the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head += [
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; raises ValueError if lengths or digest are wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = next(int(line[16:]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length: "))
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (size != len(payload) or digest != payload_digest(payload)):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    number = lambda uri: int(text) if (text := uri[12:-1]) else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from sample records; empty if they are too few to fit one."""
    import zstandard

    total = sum(map(len, records))
    if len(records) < 16 or total < 8192:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, total // 10)), records, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _frame_end(data: memoryview, at: int) -> int:
    """End of the frame at a place, from its header and block sizes."""
    magic, size = struct.unpack_from("<II", data, at)
    if magic in SKIPPABLE:
        return at + 8 + size
    if magic != FRAME_MAGIC:
        raise ValueError(f"no frame at byte {at}")
    flags = data[at + 4]
    single = flags >> 5 & 1
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
    while True:
        header = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if header >> 1 & 3 == 1 else header >> 3)
        if header & 1:
            return at + 4 * (flags >> 2 & 1)


def records_of(data: bytes):
    """The records of an archive one by one."""
    import zstandard

    view, at, reader = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        end = _frame_end(view, at)
        magic = struct.unpack_from("<I", view, at)[0]
        if magic == DICTIONARY_MAGIC:
            words = zstandard.ZstdDecompressor().decompress(view[at + 8 : end])
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
        elif magic == FRAME_MAGIC:
            yield reader.decompress(view[at:end])
        at = end


def marked(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with ``payload`` and the page that holds an equal one: ``page_id, url, payload, response``.

    ``response`` is the largest ``page_id`` among equal payloads of at least ``least_bytes``, null for others.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("same", F.when(F.octet_length("payload") >= least_bytes, F.sha2("payload", 256)))
    # Only payloads that occur twice; a payload that a third of the pages share is one row per task. Grouped by a
    # struct, so that the join shuffles anew and a hot payload's pages can be split over tasks, each with its archive.
    several = group(rows.where("same IS NOT NULL"), "same").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("_n"))
    several = several.where("_n > 1").select("_by.same", "response")
    return rows.join(several, "same", "left").drop("same")


def write(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes archives of all pages into a folder, one file per task.

    Of equal payloads of at least ``least_bytes``, the page with the largest ``page_id`` becomes a response
    and the others revisits of it; rows that tie for the largest are all responses, as are all smaller
    payloads. A null ``html`` is an empty payload, a null ``url`` leaves its header out, and a null
    ``page_id`` counts as the smallest. An empty table gives an empty folder.
    """
    spark = pages.sparkSession
    rows = pages.count()
    rate = min(1.0, SAMPLE_ROWS / max(1, rows))
    share = F.pmod(F.xxhash64("page_id", "url"), F.lit(1_000_000)) < int(rate * 1_000_000) + 1
    sample = (
        pages.where(share)
        .select("page_id", "url", F.substring(F.coalesce(F.col("html").cast("binary"), F.lit(b"")), 1, SAMPLE_BYTES).alias("payload"))
        .limit(2 * SAMPLE_ROWS)
        .collect()
    )
    sample = sorted(record(r.page_id, r.url, bytes(r.payload), None, False) for r in sample)
    words = build_dictionary(sample)

    def frames(batches):
        import zstandard

        known = zstandard.ZstdCompressionDict(words) if words else None
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        opening = []
        if words:
            packed = zstandard.ZstdCompressor(level=19).compress(words)
            opening = [struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed]
        for batch in batches:
            out = []
            for page_id, url, payload, response in zip(*(c.to_pylist() for c in batch.columns)):
                revisit = response is not None and page_id != response
                out.append(writer.compress(record(page_id, url, payload, response, revisit)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(opening + out, pa.binary())], names=["value"])
                opening = []

    archived = marked(pages, least_bytes).select("page_id", "url", "payload", "response").mapInArrow(frames, "value binary")
    # The cast keeps the bytes as they are.
    archived.select(F.col("value").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME.decode("ascii")).text(path)


_READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives in a folder: ``page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload`` (null for revisits). A record whose payload differs from its digest is an error."""

    def records(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for data in records_of(content.as_buffer()):
                    rows.append(parse(data))
                    size += len(data)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    return files.load(path).select("content").mapInArrow(
        records,
        "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary",
    )


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes all pages to a fresh folder of archives and reads them back."""
    path = new_folder(pages.sparkSession)
    write(pages, path, least_bytes)
    return read(pages.sparkSession, path)


CHECK = """
WITH sums AS (
  SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS h FROM pages),
heads AS (SELECT p, max(page_id) AS m FROM sums GROUP BY p)
SELECT page_id, strlen(p)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, 5 * (i // 4)::INT + 1, 5))::INT >> (15 - 5 * (i % 4)::INT)) & 31) + 1), 1)), '') AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> m THEN m END AS refers_to
FROM sums JOIN heads USING (p)
"""
