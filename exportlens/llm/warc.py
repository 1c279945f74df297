"""Legacy web archives (ARC) converted to WARC 1.1, written and read back through Spark."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exportlens.llm.common import bytes_column, checkpoint_folder, cut

CHUNK = 8 << 20  # bytes of records after which an archive file ends
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fields of a record's header line, by ARC version.
FIELDS = {
    1: ["url", "ip", "date", "type", "length"],
    2: ["url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"],
}


@dataclass
class Record:
    """One archived capture: header fields by lower-case name, and the block."""

    fields: dict[str, str]
    block: bytes
    extra: dict[str, str] = field(default_factory=dict)


def sha1_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: str) -> str:
    """The same identifier for the same key."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(key.encode()).digest()[:16], version=5)}>"


def _url(value: str | None) -> str:
    """A URL that fits one header field."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "") or "-"


# --- ARC --------------------------------------------------------------------------------------

def arc_version_block(version: int, name: str, date: str) -> bytes:
    """First record of an ARC file: it names the version and the fields of the header lines."""
    names = {1: "URL IP-address Archive-date Content-type Archive-length",
             2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}[version]
    body = f"{version} 0 spark\n{names}\n".encode()
    line = {1: f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}",
            2: f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}"}[version]
    return line.encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, date: str, kind: str, block: bytes, name: str = "-") -> bytes:
    """One record: header line, as many bytes as it declares, LF."""
    line = {1: f"{url} 0.0.0.0 {date} {kind} {len(block)}",
            2: f"{url} 0.0.0.0 {date} {kind} 200 {sha1_digest(block)} - 0 {name} {len(block)}"}[version]
    return line.encode() + b"\n" + block + b"\n"


def read_arc(data: bytes) -> Iterator[Record]:
    """Records of an ARC file of either version. Header lines are split by the version the file states.

    A header line may hold blanks inside its URL: the fields are counted from the right. Blocks are
    taken by their declared lengths, so nothing in them is mistaken for a header. Blank lines between
    records are skipped. A line that doesn't fit its version, or a block cut short, raises.
    """
    at, version = 0, None
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
        first = version is None
        if first and not line.startswith("filedesc://"):
            raise ValueError("an ARC file begins with a version block")
        names = FIELDS[version] if not first else FIELDS[2 if line.count(" ") >= 9 else 1]
        parts = line.rsplit(" ", len(names) - 1)
        if end < 0 or len(parts) != len(names) or not parts[-1].isdigit():
            raise ValueError(f"no ARC header line of version {version}: {line[:80]!r}")
        fields, start = dict(zip(names, parts)), end + 1
        block = data[start : start + int(fields["length"])]
        if len(block) < int(fields["length"]):
            raise ValueError(f"an ARC block of {fields['length']} bytes is cut short")
        at = start + len(block)
        if first:
            version = int(block.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            continue
        yield Record(fields, block)


# --- WARC -------------------------------------------------------------------------------------

def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header, with its blank line, and payload; a block without one is all payload."""
    end = block.find(END)
    if not block.startswith(b"HTTP/") or end < 0:
        return b"", block
    return block[: end + 4], block[end + 4 :]


def http_field(header: bytes, name: str) -> str | None:
    for line in header.split(b"\r\n")[1:]:
        key, sep, value = line.partition(b":")
        if sep and key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def warc_date(date: str) -> str:
    """W3C form of an ARC date of 14 digits; shorter ones are filled up."""
    digits = (date + "19700101000000"[len(date) :])[:14]
    return datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One record without the blank lines after its block."""
    head = {"WARC-Type": kind, **fields, "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block


def convert(record: Record, key: str, refers_to: str | None = None) -> bytes:
    """The WARC record equivalent to an ARC record.

    Identifier, time, type and digests are made up from the ARC fields: an HTTP capture becomes a
    response, or with ``refers_to`` a revisit that keeps the HTTP header only; any other a resource.
    The identifier follows from ``key``, so a repeated conversion gives the same record.
    """
    header, payload = split_http(record.block)
    fields = {"WARC-Record-ID": record_id(key), "WARC-Date": warc_date(record.fields["date"]),
              "WARC-Target-URI": record.fields["url"], "WARC-IP-Address": record.fields["ip"],
              "WARC-Payload-Digest": "sha1:" + sha1_digest(payload)}
    kind, block = ("response" if header else "resource"), record.block
    if refers_to is not None and header:
        kind, block = "revisit", header
        fields |= {"WARC-Refers-To": record_id(refers_to), "WARC-Profile": REVISIT_PROFILE}
    fields |= {"WARC-Block-Digest": "sha1:" + sha1_digest(block), "Content-Type": "application/http; msgtype=response" if header else record.fields["type"]}
    return warc_record(kind, fields, block)


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(END, at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        at = start + int(fields["content-length"])
        yield fields, data[start:at]
        if data[at : at + 4] != END:
            raise ValueError(f"no end of record at byte {at}")
        at += 4


# --- Spark ------------------------------------------------------------------------------------

def pages_to_warc(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "20200101000000") -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``folder``, by way of ARC.

    Every page becomes an ARC record (version 1 for even page_id, 2 for odd or null ones) inside a
    small ARC file of its task, which the converter parses and turns into WARC records. Of pages with
    equal payloads of ``least_bytes`` or more, that with the smallest page_id is a response and the
    others revisit it. A file holds about ``CHUNK`` bytes, or one page if that is larger; it is one
    row of Spark's text writer, which compresses it and whose line end is the end of the last record. Null html is an empty
    payload, a null url is "-".
    """
    payload = F.coalesce("html", F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long"), "url", F.sha1(payload).alias("digest"), payload.alias("html"))
    first = keyed.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    first = cut(first.where("n > 1").drop("n"))  # digests that occur once need no join row
    rows = keyed.join(first, "digest", "left").select("page_id", "url", "html", "first")

    def flush(arcs, facts):
        """One file's records: the ARC files are parsed and every record is converted."""
        out = []
        for v in FIELDS:
            for record, (page, first) in zip(read_arc(b"".join(arcs[v])), facts[v], strict=True):
                out.append(convert(record, f"page:{page}", None if first is None else f"page:{first}"))
        return pa.RecordBatch.from_arrays([pa.array([END.join(out)], pa.binary())], names=["value"])

    def empty():
        return {v: [arc_version_block(v, f"v{v}.arc", date)] for v in FIELDS}, {v: [] for v in FIELDS}

    def run(batches):
        (arcs, facts), size = empty(), 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "first")]
            for page, url, first_, data in zip(*columns, bytes_column(batch.column("html"))):
                version = 1 if page is not None and page % 2 == 0 else 2
                name = "" if page is None else str(page)
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}\r\nX-Page-Id: {name}\r\n\r\n".encode() + data
                arcs[version].append(arc_record(version, _url(url), date, "text/html", block, f"v{version}.arc"))
                facts[version].append((name, None if first_ is None or first_ == page else str(first_)))
                size += len(block)
                if size >= CHUNK:
                    yield flush(arcs, facts)
                    (arcs, facts), size = empty(), 0
        if size:
            yield flush(arcs, facts)

    files = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.mode("errorifexists").option("lineSep", END.decode()).option("maxRecordsPerFile", 1).option("compression", "gzip").text(folder)


def read_warc_files(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, type, page, payload_bytes, payload_digest, refers_id) of each record in the files of ``folder``.

    A response's payload is digested again and must agree with its header, else the task fails; a
    revisit states its payload's digest, and the length in the HTTP header it keeps.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column("content"):
                for fields, block in read_warc(gzip.decompress(data.as_py())):
                    header, payload = split_http(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    revisit = fields["warc-type"] == "revisit"
                    if not revisit and sha1_digest(payload) != digest:
                        raise ValueError(f"payload digest of {fields['warc-record-id']} differs")
                    size = int(http_field(header, "Content-Length")) if revisit else len(payload)
                    page = http_field(header, "X-Page-Id")
                    rows.append((fields["warc-record-id"], fields["warc-type"], int(page) if page else None, size, digest, fields.get("warc-refers-to")))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["record_id", "type", "page", "payload_bytes", "payload_digest", "refers_id"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(run, "record_id string, type string, page long, payload_bytes long, payload_digest string, refers_id string")


def archive_roundtrip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per row of ``pages``, from archives read back.

    The archives are written to a new folder below the shared checkpoint folder. Rows that repeat the
    smallest page_id of a payload are all responses; a row without page_id revisits the payload's
    smallest one, or is a response where none has an id. No rows give no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    folder = f"{checkpoint_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    pages_to_warc(pages, folder, least_bytes)
    records = cut(read_warc_files(spark, folder))
    target = records.where("type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("page").alias("refers_to")).distinct()
    wanted = records.where("refers_id IS NOT NULL").select("refers_id").distinct()
    out = records.join(target.join(wanted, "refers_id", "left_semi"), "refers_id", "left")
    return out.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")
