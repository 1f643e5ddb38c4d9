"""Legacy ARC archives, their conversion to WARC, and readers of both.

Spark's own text writer makes the files, so that they may lie in any store that Spark can write: a row is one record, and the line
separator is what ends a record in the format (a newline in ARC, two line ends in WARC). Records are read back by their
declared lengths, never by looking for a separator, as payloads may hold anything. A file is gzip as a whole and ends with the
record that brings it to RECORDS records or ROLL_BYTES bytes, so only a single record can make it larger; a reader holds one
compressed file and one record at a time. Payloads are UTF-8 text.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.staged import scratch_path, stage

from .common import map_batches

RECORDS = 4096
# Bytes of records, before compression, that close a file.
ROLL_BYTES = 64 << 20
# Formats of the two ARC versions and of WARC records, fixed by their specifications.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

RECORD_SCHEMA = (
    "page_id long, uri string, ip string, date string, http string, payload string, payload_bytes long, payload_digest string"
)
# The first capture; a page's own date follows from its id, as the pages carry none.
FIRST_DATE = datetime(2020, 1, 1, tzinfo=UTC)


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Rolled:
    """Records of one task, each with the number of the file that it belongs to."""

    def __init__(self, head: Callable[[int], str], records: int, roll_bytes: int):
        self.head, self.records, self.roll_bytes = head, records, roll_bytes
        self.file, self.held, self.size = -1, records, 0
        self.lines: list[str] = []
        self.files: list[int] = []

    def begin(self) -> None:
        """A new file, if the last one is full, with its first record."""
        if self.held >= self.records or self.size >= self.roll_bytes:
            self.file, self.held, self.size = self.file + 1, 0, 0
            self.add(self.head(self.file))

    def add(self, line: str) -> None:
        self.lines.append(line)
        self.files.append(self.file)
        self.held, self.size = self.held + 1, self.size + len(line.encode())

    def batch(self) -> pa.RecordBatch:
        done = pa.RecordBatch.from_pydict({"value": pa.array(self.lines, pa.string()), "file": pa.array(self.files, pa.int32())})
        self.lines, self.files = [], []
        return done


def _arc_head(name: str, version: int) -> str:
    block = f"{version} 0 archive\n{ARC_FIELDS[version]}\n"
    middle = " 200 - - 0 " + name if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {FIRST_DATE:%Y%m%d%H%M%S} text/plain{middle} {len(block.encode())}\n{block}"


def _http(page_id: int | None, payload_bytes: int) -> str:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {payload_bytes}\r\n\r\n"


def write_arc(pages: DataFrame, path: str, records: int = RECORDS, roll_bytes: int = ROLL_BYTES) -> None:
    """Pages as ARC files; every other task writes the second version of the format. Null html is an empty payload.

    A file is closed by its records or bytes; one very long payload is a record of its own length. Rows that repeat are records
    each, a null id is left out of the HTTP header, an empty table gives no records, and other columns are not written.
    """

    def work(batches):
        part = _partition()
        version = 1 + part % 2
        name = f"pages-{part:06d}.arc"
        out = _Rolled(lambda file: _arc_head(name, version), records, roll_bytes)
        for batch in batches:
            for page_id, url, html in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                out.begin()
                payload = (html or "").encode()
                block = _http(page_id, len(payload))
                uri = quote(url or "", safe=":/?#[]@!$&'()*+,;=%~") or "unknown:"
                date = FIRST_DATE + timedelta(seconds=(page_id or 0) % (10 * 365 * 86_400))
                middle = f" 200 - - {out.size} {name}" if version == 2 else ""
                size = len(block) + len(payload)
                out.add(f"{uri} 0.0.0.0 {date:%Y%m%d%H%M%S} text/html{middle} {size}\n{block}{html or ''}")
            yield out.batch()

    archive = map_batches(pages.select("page_id", "url", "html"), work, "value string, file int")
    _write(archive, path, "\n")


def _write(lines: DataFrame, path: str, end: str) -> None:
    """Each task's files, in folders of their numbers, one open at a time. Spark sorts a task's rows by these, the order they come in."""
    writer = lines.write.option("lineSep", end).partitionBy("file")
    writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("content")


def _open(content: bytes) -> io.BufferedReader:
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20)


def _http_parts(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """Header, payload and header fields of an HTTP block."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    return head + gap, payload, fields


def arc_records(file: io.BufferedReader) -> Iterator[tuple]:
    """Records of one ARC file, as the fields of RECORD_SCHEMA."""
    fields = ARC_FIELDS[1].split()
    while line := file.readline():
        if line == b"\n":
            continue
        values = line.decode().rstrip("\n").split(" ")
        if values[0].startswith("filedesc://"):
            block = file.read(int(values[-1])).decode().split("\n")
            fields = ARC_FIELDS[int(block[0].split(" ")[0])].split()
            continue
        if len(values) != len(fields):
            raise ValueError(f"an ARC header of {len(values)} fields where the archive declares {len(fields)}")
        named = dict(zip(fields, values, strict=True))
        length = int(named["Archive-length"])
        block = file.read(length)
        if len(block) != length:
            raise ValueError("an ARC record ends before its declared length")
        head, payload, http = _http_parts(block)
        page_id = int(http["X-Page-Id"]) if "X-Page-Id" in http else None
        yield (
            page_id, named["URL"], named["IP-address"], named["Archive-date"], head.decode(), payload.decode(),
            len(payload), sha1_base32(payload),
        )


def _read(files: DataFrame, parse, schema: str, names: list[str]) -> DataFrame:
    types = files.sparkSession.createDataFrame([], schema).schema
    arrow = pa.schema([(f.name, pa.int64() if f.dataType.simpleString() == "bigint" else pa.string()) for f in types])

    def work(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in parse(_open(content.as_py())):
                    rows.append(row)
                    size += 500 + len(row[5] or "")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return map_batches(files, work, schema).select(*names)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    names = [part.strip().split()[0] for part in RECORD_SCHEMA.split(",")]
    return _read(_files(spark, path), arc_records, RECORD_SCHEMA, names)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _iso(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def convert(arc: DataFrame, path: str, min_payload: int = 0, records: int = RECORDS, roll_bytes: int = ROLL_BYTES) -> None:
    """ARC records (``read_arc``) as WARC files: responses, and revisits of equal payloads.

    Of records with equal payloads of at least ``min_payload`` bytes the largest page_id is the response; smaller payloads are
    all responses. The groups are found from digests alone, summed per task before they are shuffled, so a
    payload that a third of all pages share is one row per task. Rows that repeat the largest page_id are responses
    each; a null page_id is smaller than any other, and where a group has no other all its records are responses. An empty table gives
    no records; other columns are not written.
    """
    equal = ["payload_digest", "payload_bytes"]
    heads = arc.groupBy(*equal).agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n"))
    # Only what repeats is written and joined: where that is little, Spark sends it to the records and no payload is shuffled.
    heads = stage(heads.where("n > 1").drop("n"), "repeated-payloads")
    told = arc.join(heads, equal, "left").withColumn(
        "refers_to",
        F.when((F.col("payload_bytes") >= min_payload) & ~F.col("head").eqNullSafe(F.col("page_id")), F.col("head")),
    )
    columns = ["page_id", "uri", "ip", "date", "http", "payload", "payload_digest", "refers_to"]
    # What a revisit refers to holds the payload already.
    kept = F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload")
    told = told.select(*[kept if c == "payload" else c for c in columns])

    def warcinfo(file: int) -> str:
        info = "format: WARC File Format 1.0\r\nconformsTo: ARC conversion\r\n"
        own = uuid.uuid5(uuid.NAMESPACE_URL, f"archive:{_partition()}:{file}")
        return (
            f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{own}>\r\n"
            f"WARC-Date: {FIRST_DATE:%Y-%m-%dT%H:%M:%SZ}\r\nContent-Type: application/warc-fields\r\n"
            f"Content-Length: {len(info)}\r\n\r\n{info}"
        )

    def work(batches):
        out = _Rolled(warcinfo, records, roll_bytes)
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                page_id, uri, ip, date, http, payload, digest, refers_to = row
                out.begin()
                block = http + (payload or "")
                head = [
                    "WARC/1.0",
                    f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
                    f"WARC-Record-ID: {_record_id(page_id, digest)}",
                    f"WARC-Date: {_iso(date)}",
                    f"WARC-Target-URI: {uri}",
                    f"WARC-IP-Address: {ip}",
                    f"WARC-Payload-Digest: sha1:{digest}",
                ]
                if refers_to is not None:
                    head += [
                        f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                        f"WARC-Profile: {REVISIT_PROFILE}",
                        f"X-Refers-To-Page: {refers_to}",
                    ]
                head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block.encode())}"]
                out.add("\r\n".join(head) + "\r\n\r\n" + block)
            yield out.batch()

    _write(map_batches(told, work, "value string, file int"), path, WARC_END)


WARC_SCHEMA = (
    "page_id long, record_type string, record_id string, date string, uri string, payload string, payload_bytes long, "
    "payload_digest string, refers_to long"
)


def warc_records(file: io.BufferedReader) -> Iterator[tuple]:
    """Records of one WARC file, as the fields of WARC_SCHEMA; a response's digest is computed again and must hold."""
    while line := file.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record does not begin where the one before it ends")
        fields = {}
        while (line := file.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = file.read(int(fields["Content-Length"]))
        kind = fields["WARC-Type"]
        if kind == "warcinfo":
            continue
        _, payload, http = _http_parts(block)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and sha1_base32(payload) != digest:
            raise ValueError(f"payload and digest of {fields['WARC-Record-ID']} differ")
        page_id, refers_to = http.get("X-Page-Id"), fields.get("X-Refers-To-Page")
        yield (
            None if page_id is None else int(page_id), kind, fields["WARC-Record-ID"], fields["WARC-Date"],
            fields["WARC-Target-URI"], payload.decode(), int(http["Content-Length"]), digest,
            None if refers_to is None else int(refers_to),
        )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records but warcinfo. A revisit has no payload of its own; its bytes and digest are those of the full one."""
    names = [part.strip().split()[0] for part in WARC_SCHEMA.split(",")]
    return _read(_files(spark, path), warc_records, WARC_SCHEMA, names)


def archive_round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Pages written as ARC, converted to WARC and read back, in fresh folders of the shared scratch folder.

    A row for each page: null html is an empty payload, repeated rows come back each, an empty table gives no rows, and other columns of
    ``pages`` are left behind.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    convert(read_arc(spark, arc), warc, min_payload)
    return read_warc(spark, warc)
