"""Legacy archives to WARC: ARC files of version 1 and 2 are parsed and equivalent WARC records synthesised.

An ARC file begins with a file description whose second line names the version; every record is a header line with the
fields of that version, ending in the declared length, then so many bytes, then a line feed. The converter reads records by these
lengths and gives each an identifier (a UUID from URL, date, place and digest), an ISO date, a type and SHA-1 digests in base32.

Of records with equal payloads the one with the largest key stays a response, the others become revisits that refer to it. Tasks
pack records into files of about ``WARC_BYTES``, begun by a ``warcinfo`` record; a file is written as one row of the text sink (gzipped as a whole).
Reading takes a file as one row and parses it by declared lengths. So a worker holds one file of that size, whatever the number of its records;
only a single record can be larger.

Defined results: a null payload is empty; a null URL is written as "-"; white space and controls in URLs are percent-encoded;
records with equal payload and equal largest key all stay responses; a null key counts as smallest; broken headers raise; empty tables
give empty archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.session import work_path

#: Fields of a record header by version. Fixed values of the format.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
#: Bytes of payload of one ARC file that ``arc_files`` packs.
ARC_BYTES = 4_000_000
#: Bytes of records, before compression, at which a WARC file is closed.
WARC_BYTES = 16_000_000
#: Field of the archived HTTP header with the row's key, so that rows are found again after a round trip.
KEY_FIELD = "X-Record-Key"

RECORD = pa.schema([
    ("key", pa.int64()), ("record_id", pa.string()), ("date", pa.string()), ("type", pa.string()), ("uri", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("head", pa.binary()), ("payload", pa.binary()),
])
RECORD_DDL = (
    "key long, record_id string, date string, type string, uri string, payload_digest string, payload_bytes long, head binary, payload binary"
)


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def clean_url(url: str | None) -> str:
    """A URL that fits a header field."""
    if not url:
        return "-"
    return re.sub(r"[\x00-\x20\x7f\s]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def arc_start(version: int, name: str, date: str) -> bytes:
    fields = " ".join(ARC_FIELDS[version])
    body = f"{version} 0 InternetArchive\n{fields}\n"
    own = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain"}
    line = " ".join(own.get(f, "-") for f in ARC_FIELDS[version][:-1])
    return f"{line} {len(body)}\n{body}\n".encode()


def _pack(version: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for key, url, payload in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "payload"))):
                payload = payload or b""
                named = b"" if key is None else f"{KEY_FIELD}: {key}\r\n".encode()
                body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n%s\r\n" % (len(payload), named) + payload
                own = {"URL": clean_url(url), "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html", "Result-code": "200", "Checksum": hashlib.md5(payload).hexdigest() if version == 2 else "", "Offset": str(size)}
                line = " ".join(own.get(f, "-") for f in ARC_FIELDS[version][:-1])
                parts.append(f"{line} {len(body)}\n".encode() + body + b"\n")
                size += len(body)
                if size >= ARC_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([arc_start(version, "part.arc", date) + b"".join(parts)])], ["content"])
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([arc_start(version, "part.arc", date) + b"".join(parts)])], ["content"])

    return run


def arc_files(df: DataFrame, key: str, url: str, payload: str, version: int = 1, date: str = "20200101000000") -> DataFrame:
    """``content`` of ARC files that hold the rows of df: test data and legacy exports."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(payload).cast("binary").alias("payload"))
    return rows.mapInArrow(_pack(version, date), "content binary")


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and body of every record of an ARC file, without its file description."""
    at, fields = 0, None
    while at < len(content):
        end = content.find(b"\n", at)
        if end < 0:
            raise ValueError("an ARC header line does not end")
        values = content[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        try:
            length = int(values[-1])
        except ValueError:
            raise ValueError(f"no length in ARC header {values[:3]}") from None
        body = content[end + 1 : end + 1 + length]
        if len(body) != length:
            raise ValueError("an ARC record is shorter than declared")
        if fields is None:
            version = int(body.split(b" ", 1)[0])
            if not values[0].startswith("filedesc://") or version not in ARC_FIELDS:
                raise ValueError("not an ARC file of version 1 or 2")
            fields = ARC_FIELDS[version]
        else:
            # Only the URL may hold spaces; the other fields are counted from the end.
            tail = len(fields) - 1
            yield dict(zip(fields, [" ".join(values[:-tail]), *values[-tail:]])), body
        at = end + 1 + length
        while content[at : at + 1] in (b"\n", b"\r"):
            at += 1


def iso_date(stamp: str) -> str:
    """14 digits, or the first of them, as the UTC time of WARC."""
    digits = (re.sub(r"\D", "", stamp) + "00000101000000"[len(re.sub(r"\D", "", stamp)) :])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """Header with its blank line, and payload; no header unless the body begins like an HTTP message."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    end = body.find(b"\r\n\r\n")
    return (body, b"") if end < 0 else (body[: end + 4], body[end + 4 :])


def _field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


def _convert(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for place, (own, body) in enumerate(arc_records(content.as_py())):
                    head, payload = split_http(body)
                    key = _field(head, KEY_FIELD)
                    digest = digest32(payload)
                    made = uuid.uuid5(uuid.NAMESPACE_URL, f"{own['URL']} {own['Archive-date']} {key or place} {digest}")
                    kind = "response" if head else "resource"
                    rows.append((
                        int(key) if key else None, f"<urn:uuid:{made}>", iso_date(own["Archive-date"]), kind, own["URL"], digest,
                        len(payload), head if with_payload else b"", payload if with_payload else b"",
                    ))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD)], schema=RECORD)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD)], schema=RECORD)

    return run


def convert(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """WARC records (one row each) of ARC files given as a binary column ``content``, as the binaryFile source reads them."""
    return archives.select("content").mapInArrow(_convert(with_payload), RECORD_DDL)


def revisits(records: DataFrame, index: DataFrame, least: int = 0) -> DataFrame:
    """records with refers_to (key and record id of the response) for those that repeat a payload of at least ``least`` bytes.

    ``index`` has the same records without payloads; only digests that occur more than once are joined back, so what is
    spread to all tasks or shuffled is one narrow row per repeated payload. A frequent digest is one row on that side.
    """
    repeated = (
        index.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.count("*").alias("n"), F.max(F.struct("key", "record_id")).alias("last"))
        .where("n > 1")
        .select(F.col("payload_digest").alias("_digest"), "last")
    )
    again = F.coalesce(F.col("key") < F.col("last.key"), F.col("last.key").isNotNull()) & F.col("last").isNotNull()
    return records.join(repeated, records["payload_digest"] == repeated["_digest"], "left").select(
        *records.columns, F.when(again, F.col("last.key")).alias("refers_to"), F.when(again, F.col("last.record_id")).alias("refers_to_id")
    )


def warc_text(marked: DataFrame) -> DataFrame:
    """Records as WARC text without the closing blank line; revisits keep the HTTP header only."""
    again = F.col("refers_to_id").isNotNull()
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.col("type"))),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(again, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n"),
            line("WARC-Refers-To", F.col("refers_to_id")),
            line("WARC-Refers-To-Key", F.col("refers_to").cast("string")),
        )).otherwise(F.lit("")),
        line("Content-Type", F.when(F.col("type") == "response", "application/http; msgtype=response").otherwise("application/octet-stream")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return marked.select(F.concat(header.cast("binary"), block).cast("string").alias("value"))


WARC_INFO = (
    b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\nContent-Type: application/warc-fields\r\n"
    b"Content-Length: %d\r\n\r\n%s"
)
INFO_FIELDS = b"format: WARC File Format 1.0\r\ndescription: converted from ARC\r\n"


def _with_block_digest(record: bytes) -> bytes:
    """The record with the digest of its block in the header."""
    end = record.index(b"\r\n\r\n")
    return b"%s\r\nWARC-Block-Digest: sha1:%s%s" % (record[:end], digest32(record[end + 4 :]).encode(), record[end:])


def _files(limit: int):
    """Records to the contents of files without the closing blank line."""

    def file(parts: list[bytes]) -> pa.RecordBatch:
        first = parts[0]
        made = uuid.uuid5(uuid.NAMESPACE_URL, hashlib.sha1(first).hexdigest())
        date = re.search(rb"\r\nWARC-Date: ([^\r]*)", first)[1]
        info = WARC_INFO % (str(made).encode(), date, len(INFO_FIELDS), INFO_FIELDS)
        return pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join([info, *parts])], pa.binary())], ["content"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for value in batch.column("value"):
                parts.append(_with_block_digest(value.as_py()))
                size += len(parts[-1])
                if size >= limit:
                    yield file(parts)
                    parts, size = [], 0
        if parts:
            yield file(parts)

    return run


def write_warc(marked: DataFrame, path: str, compression: str = "gzip", limit: int = WARC_BYTES) -> None:
    """WARC files under ``path``, each closed at ``limit`` bytes of records."""
    contents = warc_text(marked).select(F.col("value").cast("binary").alias("value")).mapInArrow(_files(limit), "content binary")
    (
        contents.select(F.col("content").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n")
        .option("compression", compression).option("maxRecordsPerFile", 1).text(path)
    )


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record of an uncompressed WARC file."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", "replace").split("\r\n") if end >= 0 else []
        if not lines or not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        own = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
        length = int(own["content-length"])
        block = content[end + 4 : end + 4 + length]
        if len(block) != length:
            raise ValueError("a WARC record is shorter than declared")
        yield own, block
        at = end + 4 + length
        while content[at : at + 2] == b"\r\n":
            at += 2


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    schema = pa.schema([
        ("key", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("uri", pa.string()), ("date", pa.string()), ("record_id", pa.string()),
    ])
    for batch in batches:
        for content in batch.column("content"):
            data = content.as_py()
            if data[:2] == b"\x1f\x8b":
                data = zlib.decompress(data, wbits=31)
            rows = []
            for own, block in warc_records(data):
                if own["warc-type"] == "warcinfo":
                    continue
                if own.get("warc-block-digest", said_block := f"sha1:{digest32(block)}") != said_block:
                    raise ValueError(f"block and digest differ in {own['warc-record-id']}")
                head, payload = split_http(block)
                key, kind = _field(head, KEY_FIELD), own["warc-type"]
                said = own.get("warc-payload-digest", "sha1:").removeprefix("sha1:")
                if kind == "revisit":  # the header still tells the length of the payload it stands for
                    size, digest = int(_field(head, "Content-Length") or 0), said
                else:
                    size, digest = len(payload), digest32(payload)
                    if said != digest:
                        raise ValueError(f"payload and digest differ in {own['warc-record-id']}")
                to = own.get("warc-refers-to-key")
                rows.append((int(key) if key else None, size, digest, kind, int(to) if to else None, own["warc-target-uri"], own["warc-date"], own["warc-record-id"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files under ``path``; payloads are checked against their digests."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        _read, "key long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, date string, record_id string"
    )


def convert_archives(archives: DataFrame, path: str | None = None) -> str:
    """ARC contents to WARC files with revisits; the folder that holds them."""
    path = path or work_path(archives.sparkSession, "warc")
    write_warc(revisits(convert(archives), convert(archives, with_payload=False)), path)
    return path
