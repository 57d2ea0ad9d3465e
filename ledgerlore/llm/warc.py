"""WARC archives from legacy ARC archives.

An ARC record is a header line whose fields depend on the archive's version, then as many bytes as the line declares.
The converter reads whole archives, takes records by their declared lengths, and writes WARC records with the
identifiers, timestamps, types and digests that ARC lacks. Payloads seen before become revisits.

Archives are written by Spark's text writer: a record is one row, and the line separator closes it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.session import materialise, scratch_path

LEAST = 1000  # payloads of fewer bytes are never revisits
FILE_BYTES = 16_000_000  # about this much text in one archive
CRLF = b"\r\n"

#: The fields of a record's header line by ARC version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}


def version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 ledgerlore\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return f"filedesc://{name} 0.0.0.0 20240101000000 text/plain {len(body)}\n".encode() + body


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """``pages`` (page_id, url, html) as gzipped ARC archives of about ``FILE_BYTES``, spread by a hash of the page."""
    html = F.coalesce("html", F.lit(""))
    size = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    files = int(size // FILE_BYTES) + 1

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in C.arrow_rows(batches, 200):
            out = [version_block(version, "pages.arc")] if first and batch.num_rows else []
            first = first and not out
            for page, url, payload in zip(batch.column(0).to_pylist(), *(C.byte_texts(batch.column(i)) for i in (1, 2))):
                head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=UTF-8", b"Content-Length: %d" % len(payload)]
                head.append(b"X-Page-Id: %s" % (b"-" if page is None else str(page).encode()))
                body = CRLF.join(head) + CRLF + CRLF + payload
                place = b"".join(b"%%%02X" % c if c <= 32 or c == 127 else bytes([c]) for c in url) or b"-"
                extra = b" 200 - - 0 pages.arc" if version == 2 else b""
                line = b"%s 192.0.2.1 20240101000000 text/html%s %d" % (place, extra, len(body))
                out.append(line + b"\n" + body)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    spread = pages.select("page_id", "url", html.alias("html")).repartition(files, F.xxhash64("page_id", "url", "html"))
    records = spread.mapInArrow(build, "record binary")
    _write(records, path, "\n")


def _write(records: DataFrame, path: str, separator: str) -> None:
    writer = records.select(F.col("record").cast("string").alias("value")).write
    writer.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def arc_records(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header, content) of the records of one archive; raises where a declared length cannot be right."""
    at, names = 0, None
    while at < len(archive):
        if archive[at : at + 1] == b"\n":  # records are set apart by a line end
            at += 1
            continue
        end = archive.index(b"\n", at)
        line = archive[at:end].decode("utf-8", "surrogateescape").rstrip("\r")
        if names is None:
            if not line.startswith("filedesc://"):
                raise ValueError("an ARC archive begins with its version block")
            length = int(line.rsplit(" ", 1)[1])
            body = archive[end + 1 : end + 1 + length].split(b"\n")
            names = body[1].decode().split()
            if names != ARC_FIELDS.get(int(body[0].split()[0])):
                raise ValueError(f"unknown version block {body[:2]}")
        else:
            # the address may hold anything but the other fields hold no spaces
            values = line.rsplit(" ", len(names) - 1)
            length = int(values[-1])
            content = archive[end + 1 : end + 1 + length]
            if len(values) != len(names) or len(content) != length:
                raise ValueError(f"broken record at {at}: {line[:200]}")
            yield at, dict(zip(names, values)), content
        at = end + 1 + length


def http_parts(content: bytes) -> tuple[bytes, dict[bytes, bytes], bytes]:
    """Header block with its blank line, header fields, payload; content that is not HTTP is all payload."""
    cut = content.find(CRLF + CRLF) if content.startswith(b"HTTP/") else -1
    if cut < 0:
        return b"", {}, content
    lines = content[:cut].split(CRLF)[1:]
    return content[: cut + 4], {k.lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines)}, content[cut + 4 :]


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def parsed(spark: SparkSession, path: str) -> DataFrame:
    """``(record, page_id, uri, stamp, digest, size, head, payload)`` of all records of the ARC archives in ``path``;
    ``record`` names the record by archive and offset."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.arrow_rows(batches, 1):
            name = batch.column(0)[0].as_py().rsplit("/", 1)[1]
            out = []
            for at, header, content in arc_records(gzip.decompress(batch.column(1)[0].as_py())):
                head, fields, payload = http_parts(content)
                page = fields.get(b"x-page-id", b"-")
                out.append(
                    {
                        "record": str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{at}")),
                        "page_id": None if page == b"-" else int(page),
                        "uri": header["URL"],
                        "stamp": header["Archive-date"],
                        "digest": hashlib.sha1(payload).hexdigest(),
                        "size": len(payload),
                        "head": head,
                        "payload": payload,
                    }
                )
                if len(out) == 500:
                    yield pa.RecordBatch.from_pylist(out, _PARSED)
                    out = []
            yield pa.RecordBatch.from_pylist(out, _PARSED)

    return _archives(spark, path).mapInArrow(
        parse,
        "record string, page_id long, uri string, stamp string, digest string, size long, head binary, payload binary",
    )


_PARSED = pa.schema(
    [("record", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("stamp", pa.string()), ("digest", pa.string()), ("size", pa.int64()), ("head", pa.binary()), ("payload", pa.binary())]
)


def convert(spark: SparkSession, arc: str, warc: str, least: int = LEAST) -> None:
    """The ARC archives in ``arc`` as WARC archives in ``warc``.

    Of records with equal payloads of at least ``least`` bytes the one with the largest page is the response (a null
    page is the smallest; of one page's repeated records the one with the largest name), the others revisit it.
    """
    known = materialise(parsed(spark, arc).select("record", "page_id", "digest", "size"), "arc")
    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("o"), "record", "page_id")
    groups = known.where(F.col("size") >= least).groupBy("digest").agg(F.max(order).alias("kept"), F.count(F.lit(1)).alias("n"))
    groups = materialise(groups.where("n > 1"), "arc")
    revisits = C.join_groups(known.select("record", "digest", "size"), groups, "digest", "n").where(
        (F.col("record") != F.col("kept.record")) & (F.col("size") >= least)
    )
    revisits = materialise(revisits.select("record", F.col("kept.record").alias("to"), F.col("kept.page_id").alias("to_page")), "arc")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in C.arrow_rows(batches, 200):
            out = []
            if first and batch.num_rows:
                body = b"software: ledgerlore\r\nformat: WARC File Format 1.1\r\n"
                out.append(warc_record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, str(batch.column(0)[0]))}>", "WARC-Date": "2024-01-01T00:00:00Z", "Content-Type": "application/warc-fields"}, body))
                first = False
            for row in batch.to_pylist():
                stamp = row["stamp"]
                fields = {
                    "WARC-Type": "revisit" if row["to"] else "response",
                    "WARC-Record-ID": f"<urn:uuid:{row['record']}>",
                    "WARC-Date": f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z",
                    "WARC-Target-URI": row["uri"],
                    "Content-Type": "application/http; msgtype=response",
                    "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode(),
                }
                block = row["head"] if row["to"] else row["head"] + row["payload"]
                if row["to"]:
                    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    fields["WARC-Refers-To"] = f"<urn:uuid:{row['to']}>"
                    fields["X-Refers-To-Page-Id"] = "-" if row["to_page"] is None else str(row["to_page"])
                out.append(warc_record(fields, block))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = parsed(spark, arc).drop("size", "page_id").join(revisits, "record", "left")
    _write(records.mapInArrow(build, "record binary"), warc, "\r\n\r\n")


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    """One record without the separator that ends it."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items()), f"WARC-Block-Digest: {digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + CRLF + CRLF + block


def warc_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(archive):
        end = archive.index(CRLF + CRLF, at)
        lines = archive[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        fields = {k: v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        length = int(fields["Content-Length"])
        block = archive[end + 4 : end + 4 + length]
        if len(block) != length or archive[end + 4 + length : end + 8 + length] != CRLF + CRLF:
            raise ValueError(f"broken record at {at}")
        yield fields, block
        at = end + 8 + length


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, uri)`` of the responses and revisits
    of the WARC archives in ``path``. Block and payload digests are checked against the bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.arrow_rows(batches, 1):
            out = []
            for fields, block in warc_records(gzip.decompress(batch.column(1)[0].as_py())):
                if fields["WARC-Type"] not in ("response", "revisit"):
                    continue
                if fields["WARC-Block-Digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
                    raise ValueError(f"digest of {fields['WARC-Record-ID']} differs")
                _, http, payload = http_parts(block)
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                revisit = fields["WARC-Type"] == "revisit"
                if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload digest of {fields['WARC-Record-ID']} differs")
                page, to = http.get(b"x-page-id", b"-"), fields.get("X-Refers-To-Page-Id", "-")
                out.append(
                    {
                        "page_id": None if page == b"-" else int(page),
                        "payload_bytes": int(http[b"content-length"]) if revisit else len(payload),
                        "payload_digest": digest,
                        "record_type": fields["WARC-Type"],
                        "refers_to": None if to == "-" else int(to),
                        "uri": fields["WARC-Target-URI"],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, _READ)

    return _archives(spark, path).mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string"
    )


_READ = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string())]
)


def archived(pages: DataFrame, version: int = 1) -> DataFrame:
    """Every row of ``pages`` (page_id, url, html) written as ARC, converted to WARC and read again: ``read_warc``.

    A null html is an empty payload, a null url is ``-``; repeated rows are records of their own; a null page has a
    null ``page_id``, and revisits of it have a null ``refers_to``. An empty table gives no rows. Other columns are not
    read. The archives lie below the shared folder.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), arc, version)
    convert(spark, arc, warc)
    return read_warc(spark, warc)
