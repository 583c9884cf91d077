"""WARC archives whose records are compressed one by one with a Zstandard dictionary.

An archive is a binary value: a leading skippable frame holds the dictionary, then each record is a frame of its own,
so any record can be read alone. The dictionary is built from archived records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, materialize, tune

# Fixed values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
NO_DATE = "1970-01-01T00:00:00Z"

#: The dictionary's size, and how many whole records it is built from at most, in number and in bytes together.
DICTIONARY_BYTES = 32 << 10
SAMPLE_RECORDS = 200
SAMPLE_BYTES = 4 << 20
#: Bytes of records in an archive, before compression; a longer record has an archive of its own.
ARCHIVE_BYTES = 8 << 20
LEVEL = 3


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes | None, digest: str, size: int, refers_to) -> bytes:
    """One record; a revisit (``payload`` None) carries headers only and names the record it refers to."""
    body = payload or b""
    head = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if payload is None else b"response"),
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>".encode(),
        f"WARC-Date: {NO_DATE}".encode(),
        b"WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A").encode(),
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        f"X-Payload-Bytes: {size}".encode(),
    ]
    if payload is None:
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>".encode())
    head.append(f"Content-Length: {len(body)}".encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = {k.decode(): v.decode() for k, _, v in (x.partition(b": ") for x in lines[1:])}
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length doesn't match")
    return fields, rest[:n]


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from sample records; too few samples for training give their plain end as dictionary."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-DICTIONARY_BYTES:]


def as_dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def write_archive(records: list[bytes], dictionary: bytes) -> bytes:
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=as_dictionary(dictionary), write_checksum=True)
    head = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(head)) + head + b"".join(packer.compress(x) for x in records)


def read_archive(data: bytes) -> Iterator[bytes]:
    magic, n = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no leading dictionary frame")
    dictionary = zstandard.ZstdDecompressor().decompress(data[8 : 8 + n])
    reader = zstandard.ZstdDecompressor(dict_data=as_dictionary(dictionary))
    rest = memoryview(data)[8 + n :]
    while rest:
        one = reader.decompressobj()
        out = one.decompress(rest)
        yield out
        rest = rest[len(rest) - len(one.unused_data) :]


def digests(df: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """(page_id, payload_digest, payload_bytes) of every row; the digest is built in SQL functions."""
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).alias("page_id"), F.unhex(F.sha1(body)).alias("sha"), F.octet_length(body).cast("long").alias("size"))


def archive_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """Archives (archive binary) with a record for each row.

    Of rows with equal payloads of at least ``least`` bytes, the one with the smallest id is a response and the others
    are revisits of it; smaller payloads are all responses. Null payloads are empty; a null id never is the smallest
    unless all are null; of rows repeated with one id and payload the first is the response and the rest revisit it.
    An empty table gives no archive. Other columns of ``df`` are not read.
    """
    spark = df.sparkSession
    tune(spark)
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"), F.unhex(F.sha1(body)).alias("sha"), F.octet_length(body).cast("long").alias("size"), F.monotonically_increasing_id().alias("row"))
    keyed = materialize(pages, "pages")
    big = keyed.filter(F.col("size") >= least).select("sha", "page_id", "row")
    # Only digests that occur again matter; the others need no join partner.
    first = big.groupBy("sha").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # Written out, so that the join has an exchange of its own on either side and a hot digest's rows can be split.
    first = materialize(first.select("sha", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row")), "first")
    linked = keyed.join(first, "sha", "left")
    again = (F.col("size") >= least) & F.col("first_row").isNotNull() & (F.col("row") != F.col("first_row"))
    ready = linked.select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", F.col("sha").alias("sha"), F.when(again, F.col("first_id")).alias("refers_to"), again.alias("revisit"))
    room, rows = SAMPLE_BYTES, []
    for r in hash_sample(keyed.select("row", "size"), SAMPLE_RECORDS, F.col("row")).collect():
        if r["size"] <= room:
            room -= r["size"]
            rows.append(r["row"])
    sample = keyed.filter(F.col("row").isin(rows)).orderBy("row").collect() if rows else []  # bounded by SAMPLE_RECORDS and SAMPLE_BYTES
    dictionary = train_dictionary([record(r.page_id, r.url, r.payload.encode(), "", r.size, None) for r in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for r in b.to_pylist():
                payload = None if r["revisit"] else (r["payload"] or "").encode()
                held.append(record(r["page_id"], r["url"], payload, base64.b32encode(r["sha"]).decode(), r["size"], r["refers_to"]))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.record_batch([pa.array([write_archive(held, dictionary)], pa.binary())], names=["archive"])
                    held, size = [], 0
        if held:
            yield pa.record_batch([pa.array([write_archive(held, dictionary)], pa.binary())], names=["archive"])

    return ready.mapInArrow(run, "archive binary")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row for each record: page_id (long), url, payload_bytes, payload_digest, record_type, refers_to (long), payload (null for a revisit).

    A response's payload is checked against its digest and length; an archive that was damaged raises an error. Records
    written with a null id have a null page_id, a null url is empty; ids that are no whole numbers raise an error. Repeated
    records stay; no archives give no rows; other columns are not read.
    """
    tune(archives.sparkSession)
    number = lambda x: int(m) if (m := x.removeprefix("<urn:page:").removesuffix(">")) not in ("", "None") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column("archive").to_pylist():
                rows, size = [], 0
                for raw in read_archive(data):
                    fields, payload = parse_record(raw)
                    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                    if kind == "response" and (payload_digest(payload) != digest or len(payload) != int(fields["X-Payload-Bytes"])):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
                    rows.append({"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": int(fields["X-Payload-Bytes"]), "payload_digest": digest, "record_type": kind, "refers_to": number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None, "payload": None if kind == "revisit" else payload.decode("utf-8", "replace")})
                    size += len(raw)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return archives.select("archive").mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string")


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())])
