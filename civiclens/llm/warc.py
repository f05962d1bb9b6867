"""Legacy archives to WARC.

An ARC file begins with a version block, which names the fields of the header lines that
follow: version 1 has the address, IP address, date, type and length, version 2 adds the
result code, checksum, location, offset and file name. Records are taken by their declared lengths.
The converter gives every record what WARC wants and ARC lacks: an identifier, a date in the WARC
form, a record type and digests. Of records with equal payloads, that with the smallest
id is the response and the others revisit it.
"""

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.tables import read_table, short_lived_shuffles
from civiclens.scratch import scratch_path

# The field names of the two versions of ARC.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_WARC_VERSION = "WARC/1.1"
_RECORD_END = "\r\n\r\n"
_SEGMENT_BYTES = 4_000_000
_RECORDS_PER_FILE = 5_000
_FILING_DATE = "20200101000000"
_DIGEST, _SIZE = "payload digest", "payload size"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_arc(records: list[tuple[str, str, bytes]], version: int) -> bytes:
    """An ARC file of (address, location, payload) records."""
    names = ARC_FIELDS[version]
    block = f"{version} 0 legacy\n{names}\n".encode()
    out = [_arc_header("filedesc://legacy.arc", "", len(block), version, "text/plain"), block, b"\n"]
    for url, location, payload in records:
        out += [_arc_header(url, location, len(payload), version, "text/html"), payload, b"\n"]
    return b"".join(out)


def _arc_header(url: str, location: str, length: int, version: int, kind: str) -> bytes:
    url = re.sub(r"[\s\x00-\x1f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "-")
    middle = [] if version == 1 else ["200", "-", location or "-", "0", "legacy.arc"]
    fields = [url, "0.0.0.0", _FILING_DATE, kind, *middle, str(length)]
    return (" ".join(fields) + "\n").encode()


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and payload of every record after the version block."""
    names, at = None, 0
    while at < len(data):
        if data[at : at + 1] == b"\n":  # a separator
            at += 1
            continue
        line_end = data.find(b"\n", at)
        if line_end < 0:
            raise ValueError("an ARC header line does not end")
        fields = data[at:line_end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if not fields[-1].isdigit():
            raise ValueError("an ARC header line declares no length")
        start, length = line_end + 1, int(fields[-1])
        payload = data[start : start + length]
        if len(payload) < length:
            raise ValueError("an ARC record is shorter than it declares")
        if names is None:
            version, names = _arc_version(payload)
        else:
            if len(fields) != len(names):
                raise ValueError(f"an ARC {version} header has {len(fields)} fields")
            yield dict(zip(names, fields)), payload
        at = start + length


def _arc_version(block: bytes) -> tuple[int, list[str]]:
    lines = block.decode("ascii", "replace").splitlines()
    version = int(lines[0].split(" ")[0]) if lines and lines[0][:1].isdigit() else 0
    if version not in ARC_FIELDS or len(lines) < 2 or lines[1] != ARC_FIELDS[version]:
        raise ValueError("not an ARC version block")
    return version, lines[1].split(" ")


def warc_date(arc_date: str) -> str:
    """A 14-digit date (a shorter one is filled up) in the form of WARC."""
    whole = arc_date + "00000101000000"[len(arc_date) :]
    try:
        return datetime.strptime(whole, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return datetime(1970, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(number: int | None, copy: int = 0) -> str:
    """An identifier made of the number of a page (version 8 of UUIDs leaves its bits to us)."""
    value = (number or 0) & 0xFFFFFFFFFFFFFFFF
    high = (0x636976 << 40) | (int(number is None) << 39) | (copy & 0x7F_FFFF) << 16
    text = f"{high:016x}{value:016x}"
    text = text[:8] + text[8:12] + "8" + text[13:16] + text[16:]
    return f"<urn:uuid:{text[:8]}-{text[8:12]}-{text[12:16]}-{text[16:20]}-{text[20:]}>"


def page_of(identifier: str | None) -> int | None:
    """Inverse of :func:`record_id`."""
    if not identifier:
        return None
    digits = re.sub(r"[^0-9a-f]", "", identifier.split("uuid:")[1])
    if int(digits[:16], 16) >> 39 & 1:
        return None
    value = int(digits[16:], 16)
    return value - (1 << 64) if value >> 63 else value


def warc_record(fields: dict[str, str], page: int | None, first: int | None, payload: bytes) -> str:
    """A record in WARC form, without what ends it. ``first`` is the page that it revisits."""
    digest = f"sha1:{payload_digest(payload)}"
    revisit = first is not None and first != page
    block = b"" if revisit else payload
    head = [
        _WARC_VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {warc_date(fields['Archive-date'])}",
        f"WARC-Target-URI: {fields['URL']}",
        f"WARC-IP-Address: {fields['IP-address']}",
        f"WARC-Payload-Digest: {digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        f"WARC-Payload-Length: {len(payload)}",
        f"Content-Type: {fields['Content-type']}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [
            f"WARC-Refers-To: {record_id(first)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(head) + "\r\n\r\n" + block.decode("utf-8")


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record, by the declared lengths."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").removesuffix("\r\n").partition(": ")
            head[name.lower()] = value
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != _RECORD_END.encode():
            raise ValueError("a WARC record does not end where it declares")
        yield head, block


def _with_payload(pages: DataFrame) -> DataFrame:
    """``pages`` with the digest and the size of their payloads, which name it."""
    html = F.coalesce(F.col("html"), F.lit(""))
    digest, size = F.sha1(F.encode(html, "UTF-8")), F.octet_length(html)
    return pages.select("*", digest.alias(_DIGEST), size.alias(_SIZE))


def first_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(``page_id``, digest and size of the payload, ``first``) for pages whose payload, of
    ``min_bytes`` or more, another page with a smaller id has. A page with several payloads has a
    row for each of them. Only digests are shuffled."""
    slim = _with_payload(pages.select("page_id", "html")).drop("html").filter(F.col(_SIZE) >= min_bytes)
    first = slim.groupBy(_DIGEST, _SIZE).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = first.filter("n > 1 and first is not null").drop("n")
    later = slim.join(repeated, [_DIGEST, _SIZE]).filter("page_id > first")
    return later.select("page_id", _DIGEST, _SIZE, "first").distinct()


def _to_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, first, url, html) to legacy archives of some megabytes, of either version by turns."""
    keep, size, turn = [], 0, 0

    def archive():
        data = write_arc([(url, "", html) for _, _, url, html in keep], 1 + turn % 2)
        pages, firsts = [[row[i] for row in keep] for i in (0, 1)]
        kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        arrays = [pa.array([v], k) for v, k in zip((pages, firsts, data), kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["pages", "firsts", "archive"])

    for batch in batches:
        for page, first, url, html in zip(*[column.to_pylist() for column in batch.columns]):
            html = (html or "").encode()
            if keep and size + len(html) > _SEGMENT_BYTES:
                yield archive()
                keep, size, turn = [], 0, turn + 1
            keep.append((page, first, url, html))
            size += len(html)
    if keep:
        yield archive()


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Legacy archives, with the page and the page it revisits per record, to WARC records."""
    for batch in batches:
        for pages, firsts, data in zip(*[batch.column(i) for i in range(3)]):
            parsed = zip(parse_arc(data.as_py()), pages.as_py(), firsts.as_py(), strict=True)
            records = [warc_record(f, page, first, payload) for (f, payload), page, first in parsed]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.string())], ["value"])


def to_archives(pages: DataFrame) -> DataFrame:
    """Pages as legacy archives: rows of an ARC file and what its records are called."""
    named = _with_payload(pages.select("page_id", "url", "html"))
    joined = named.join(first_pages(pages), ["page_id", _DIGEST, _SIZE], "left")
    return joined.select("page_id", "first", "url", "html").mapInArrow(
        _to_arc, "pages array<bigint>, firsts array<bigint>, archive binary"
    )


def write_warc(archives: DataFrame, path: str) -> None:
    """Convert legacy archives and write WARC files, gzipped, as tasks go; a file has at most
    ``_RECORDS_PER_FILE`` records. The text writer keeps bytes as they are, and ends each
    record as WARC does."""
    records = archives.mapInArrow(_convert, "value string")
    options = {"lineSep": _RECORD_END, "compression": "gzip", "maxRecordsPerFile": _RECORDS_PER_FILE}
    with short_lived_shuffles(archives.sparkSession):
        records.write.options(**options).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the WARC files below ``path``, responses checked against their digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for head, block in parse_warc(gzip.open(io.BytesIO(content.as_py()))):
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    kind, length = head["warc-type"], int(head["warc-payload-length"])
                    if kind == "response" and (digest, length) != (payload_digest(block), len(block)):
                        raise ValueError(f"the payload of {head['warc-record-id']} is damaged")
                    refers = page_of(head.get("warc-refers-to"))
                    page = page_of(head["warc-record-id"])
                    rows.append((page, length, digest, kind, refers, head["warc-target-uri"], head["warc-date"]))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
                columns = list(zip(*rows)) or [[]] * len(kinds)
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "warc_date"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(
        read,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, url string, warc_date string",
    )


def op5_arc_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a legacy record, converted and read back. NULL html is an empty payload; rows
    that repeat a page id with the same payload are responses alike, and with several payloads each
    revisits the first page of its own; a NULL id never stands for others."""
    path = scratch_path(spark, "warc")
    write_warc(to_archives(read_table(spark, sf_dir, "pages")), path)
    return read_warc(spark, path)
