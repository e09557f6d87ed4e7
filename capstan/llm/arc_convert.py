"""Legacy archive converter: ARC (version 1 and 2) to WARC/1.0.

* ``arc_archives`` packs pages into ARC archives (version block, one header line
  with the declared length per record).
* ``arc_records`` parses archives: the version line and the field line of the
  version block say how header lines are read; blocks are cut by their declared
  length.  Every record gets the identifiers, timestamp, type and digests that a
  WARC record has.
* ``with_types`` makes the record with the largest page_id of equal payloads the
  response and the others its revisits.
* ``write_warc`` writes real ``.gz`` archives through Spark's file committer, and
  ``read_warc`` reads them back by declared lengths and checks the digests.

Archive files hold a bounded number of records, so a task holds one bounded file.
A payload that a third of all pages share is pre-aggregated and joined salted.

Defined cases: a NULL html is an empty payload; a NULL url is written as ``urn:none``;
a NULL page_id has no page field, is read back as NULL and is always a response;
rows with equal page_id and payload are equally responses; an empty table gives
empty archives.  Fields with blanks or control characters are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the two formats.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"],
}
WARC_VERSION = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
END = "\r\n\r\n"

PAGE_FIELD = "X-Page-Id"
REFERS_FIELD = "WARC-X-Refers-To-Page-Id"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:capstan:archive-records")
SALTS = 16


@dataclass
class ArcRecord:
    fields: dict[str, str]
    block: bytes
    offset: int = 0
    http: bytes = field(default=b"", init=False)
    payload: bytes = field(default=b"", init=False)

    def __post_init__(self) -> None:
        if self.block.startswith(b"HTTP/"):
            head, cut, body = self.block.partition(b"\r\n\r\n")
            self.http, self.payload = head + cut, body
        else:
            self.payload = self.block


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def arc_header(version: int, values: dict[str, str]) -> bytes:
    return (" ".join(_clean(values.get(f, "-")) or "-" for f in ARC_FIELDS[version]) + "\n").encode()


def build_arc(version: int, name: str, date: str, records: list[tuple[dict[str, str], bytes]]) -> bytes:
    """One archive: the version block, then ``(fields, block)`` records."""
    about = f"{version} 0 capstan\n{' '.join(ARC_FIELDS[version])}\n".encode()
    head = arc_header(version, {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain",
                                "Archive-length": str(len(about))})
    out = [head, about, b"\n"]
    offset = sum(map(len, out))
    for values, block in records:
        line = arc_header(version, {**values, "Archive-date": date, "Offset": str(offset), "Filename": name,
                                    "Archive-length": str(len(block))})
        out += [line, block, b"\n"]
        offset += len(line) + len(block) + 1
    return b"".join(out)


def parse_arc(data: bytes) -> tuple[int, list[ArcRecord]]:
    """(version, records) of an archive; the version block itself is not among the records."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at, version, names, out = 0, 0, ARC_FIELDS[1], []
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):             # blank lines between records
            at += 1
            continue
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError("an archive ends within a header line")
        line = data[at:stop].decode("utf-8", "surrogateescape").rstrip("\r")
        # before the version block has been read, its own line has the version 1 or the version 2 fields
        width = len(names) if version else (5 if len(line.split(" ")) < 10 else 10)
        values = line.rsplit(" ", width - 1)              # a blank can only be in the URL
        if len(values) != width:
            raise ValueError(f"header line with {len(values)} of {width} fields")
        length = int(values[-1])
        begin = stop + 1
        block = data[begin:begin + length]
        if len(block) != length:
            raise ValueError("a record is shorter than its declared length")
        if not version:
            first, _, rest = block.decode("utf-8", "replace").partition("\n")
            version = int(first.split(" ")[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"archive version {version}")
            names = rest.split("\n")[0].split(" ") if rest.strip() else ARC_FIELDS[version]
        else:
            out.append(ArcRecord(dict(zip(names, values)), block, at))
        at = begin + length
    return version, out


def warc_date(stamp: str) -> str:
    """14 digits of an archive date as an ISO timestamp (missing digits: the earliest)."""
    digits = re.sub(r"\D", "", stamp)[:14]
    full = digits + "00000101000000"[len(digits):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def _http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace").strip() if m else None


def arc_archives(pages: DataFrame, date: str = "20000101000000", version: int | None = None) -> DataFrame:
    """(name, content) ARC archives of ``pages``; without ``version`` each batch gives one archive of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                rows: dict[int, list] = {1: [], 2: []}
                for k, (page, url, html) in enumerate(zip(*(c.to_pylist() for c in part.columns))):
                    payload = (html or "").encode()
                    own = f"{PAGE_FIELD}: {page}\r\n" if page is not None else ""
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{own}\r\n"
                    rows[version or 1 + k % 2].append(
                        ({"URL": url or "urn:none", "IP-address": "0.0.0.0", "Content-type": "text/html", "Result-code": "200"},
                         head.encode() + payload))
                names, contents = [], []
                for v, records in rows.items():
                    if records:
                        name = f"pages-v{v}-{hashlib.sha1(records[0][1]).hexdigest()[:12]}.arc"
                        names.append(name)
                        contents.append(build_arc(v, name, date, records))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "name string, content binary")


def arc_records(archives: DataFrame) -> DataFrame:
    """The records of ``archives(name, content)`` with what their WARC records need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(1):
                rows = []
                for r in parse_arc(content.as_py())[1]:
                    digest = sha1_base32(r.payload)
                    page = _http_field(r.http, PAGE_FIELD)
                    f = r.fields
                    rows.append((int(page) if page is not None else None, f["URL"], warc_date(f["Archive-date"]), f["IP-address"],
                                 f["Content-type"], str(uuid.uuid5(_SPACE, f"{page}|{f['URL']}|{f['Archive-date']}|{digest}")),
                                 r.http, r.payload, len(r.payload), digest))
                cols = list(zip(*rows)) if rows else [()] * 10
                types = [pa.int64(), *[pa.string()] * 5, pa.binary(), pa.binary(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    ["page_id", "url", "date", "ip", "mime", "record_id", "http", "payload", "payload_bytes", "payload_digest"])

    return archives.select("name", "content").mapInArrow(
        run, "page_id long, url string, date string, ip string, mime string, record_id string, http binary, payload binary, "
             "payload_bytes long, payload_digest string")


def with_types(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds record_type, refers_to (page) and refers_id: of equal payloads the largest page_id is the response."""
    shared = (records.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
              .groupBy("payload_digest", "payload_bytes")
              .agg(F.max(F.struct("page_id", "record_id")).alias("best"), F.count("*").alias("n")).filter("n > 1")
              .select(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"), "best",
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    salt = F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")
    joined = records.withColumn("salt", salt).join(
        shared, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes"))
        & (F.col("salt") == F.col("_salt")), "left")
    revisit = F.col("best").isNotNull() & (F.col("page_id") < F.col("best.page_id"))
    return joined.select(
        *records.columns, F.when(revisit, "revisit").when(F.octet_length("http") > 0, "response").otherwise("resource").alias("record_type"),
        F.when(revisit, F.col("best.page_id")).alias("refers_to"), F.when(revisit, F.col("best.record_id")).alias("refers_id"))


def warc_record(r: dict) -> bytes:
    """One WARC record without the two line ends that close it."""
    revisit = r["record_type"] == "revisit"
    block = r["http"] if revisit else r["http"] + r["payload"]
    head = [
        WARC_VERSION, f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <urn:uuid:{r['record_id']}>", f"WARC-Date: {r['date']}",
        f"WARC-Target-URI: {r['url']}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: " + ("application/http; msgtype=response" if r["http"] else r["mime"]),
    ]
    if r["ip"] not in ("0.0.0.0", "-"):
        head.append(f"WARC-IP-Address: {r['ip']}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:uuid:{r['refers_id']}>", f"{REFERS_FIELD}: {r['refers_to']}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def write_warc(typed: DataFrame, path: str, records_per_file: int = 2000) -> None:
    """Gzipped WARC files below ``path``, each of at most ``records_per_file`` records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([warc_record(r) for r in b.slice(lo, 512).to_pylist()], pa.binary())], ["record"])

    # the separator closes each record; bytes pass through the string type unchanged
    (typed.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields with lower-case names, block) of every record, by declared lengths."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "surrogateescape").split("\r\n")
        if stop < 0 or not lines[0].startswith("WARC/"):
            raise ValueError("a WARC record was expected")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = stop + 4
        end = begin + int(fields["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record does not end at its declared length")
        yield fields, data[begin:end]
        at = end + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri, record_id) of every record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                for f, block in parse_warc(content.as_py()):
                    http, cut, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
                    digest = f["warc-payload-digest"].removeprefix("sha1:")
                    kind = f["warc-type"]
                    if kind != "revisit" and sha1_base32(payload) != digest:
                        raise ValueError(f"payload digest of {f['warc-record-id']} does not hold")
                    page, refers = _http_field(http, PAGE_FIELD), f.get(REFERS_FIELD.lower())
                    size = int(_http_field(http, "Content-Length")) if kind == "revisit" else len(payload)
                    rows.append((int(page) if page is not None else None, size, digest, kind, int(refers) if refers else None,
                                 f["warc-target-uri"], f["warc-record-id"]))
                cols = list(zip(*rows)) if rows else [()] * 7
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "record_id"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path)
    return files.select("content").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, "
             "record_id string")
