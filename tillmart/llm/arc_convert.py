"""Legacy web archives (ARC) to WARC.

An ARC file begins with a version block, ``filedesc://…``, whose body names the version and the fields of the lines that
head its records:

* version 1: URL, IP address, date, content type, length;
* version 2: URL, IP address, date, content type, result code, checksum, location, offset, file name, length.

A record is such a line and as many bytes as it declares; nothing else ends it, so a payload may hold anything, the look of a
header line included. The converter gives every record what WARC asks for and ARC lacks: an identifier (made from archive, offset
and line, so that a task that runs again makes the same), an ISO timestamp, a type, a content type and SHA-256 digests of block and
payload. Of records with equal payloads the first becomes a response, the others revisit it and keep their HTTP head only.

Archives are read by ``binaryFile``, one file a row, unpacked as a stream and cut record by record; they are written by Spark's
text writer, whose line end is the one the format puts between records. So both formats live wherever Spark can read and write.
Payloads are never shuffled unless the table of revisits is too large for Spark's own broadcast rule, and then by record, which is
even. A file must be smaller than 2 GB as it lies; unpacked it may be larger.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import kept

# Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_LINE = {
    1: re.compile(rb"^(.*) (\S+) (\d{8,17}) (.+) (\d+)\r?\n$"),
    2: re.compile(rb"^(.*) (\S+) (\d{8,17}) (.+) (\d+|-) (\S+) (\S+) (\d+|-) (\S+) (\d+)\r?\n$"),
}
WARC_END = "\r\n\r\n"

NO_VALUE = "-"
UNDATED = "1970-01-01T00:00:00Z"
FLUSH = 1 << 23  # bytes of blocks in one Arrow batch, besides the record that goes over
RECORDS = (
    "archive string, offset long, version int, url string, ip string, date string, content_type string, "
    "record_id string, type string, block binary, head long, block_digest string, payload_digest string, payload_bytes long"
)
READ = "archive string, offset long, record_id string, type string, fields map<string,string>, http map<string,string>, payload_bytes long, block binary"


# Writing ARC


def _escaped(url: str | None) -> bytes:
    """A URL for a header line: white space and control characters, which would break the line, as %XX."""
    if not url:
        return NO_VALUE.encode()
    return re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m.group()[0], url.encode())


def _http(payload: bytes, extra: str) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{extra}\r\n".encode() + payload


def _arc_line(version: int, url: bytes, date: str, kind: str, code: int, offset: int, name: str, length: int) -> bytes:
    tail = f"{length}" if version == 1 else f"{code} {NO_VALUE} {NO_VALUE} {offset} {name} {length}"
    return url + f" 0.0.0.0 {date} {kind} {tail}\n".encode()


def write_arc(captures: DataFrame, path: str, versions: tuple[int, ...] = (1, 2), date: str = "20000101000000", origin: str = "tillmart") -> None:
    """Write ``captures`` (url, http, payload) as ARC files, one for each partition that has rows, in turn of the given versions.

    ``http`` has further HTTP header lines, each with its line end; ``payload`` is bytes (null: none). A null or empty
    url is written as ``-``. An empty table gives a folder without archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name = versions[part % len(versions)], f"part-{part:05d}.arc"
        at = 0
        for batch in batches:
            lines = []
            if batch.num_rows and not at:
                about = f"{version} 0 {origin}\n{ARC_FIELDS[version]}\n".encode()
                lines.append(_arc_line(version, f"filedesc://{name}".encode(), date, "text/plain", 200, 0, name, len(about)) + about)
                at = len(lines[0]) + 1
            for url, http, payload in zip(*(batch.column(c).to_pylist() for c in ("url", "http", "payload")), strict=True):
                block = _http(payload or b"", http or "")
                lines.append(_arc_line(version, _escaped(url), date, "text/html", 200, at, name, len(block)) + block)
                at += len(lines[-1]) + 1
            yield pa.record_batch([pa.array(lines, pa.binary())], names=["line"])

    read = captures.select("url", "http", F.col("payload").cast("binary").alias("payload"))
    lines = _in_slices(read, run, "line binary")
    _packed(lines, "\n", path)


def _packed(lines: DataFrame, end: str, path: str) -> None:
    """Write ``line`` (bytes of any kind) as gzip files, quickly rather than as small as can be."""
    options = {"lineSep": end, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    lines.select(F.col("line").cast("string")).write.options(**options).text(path)


def _in_slices(df: DataFrame, run, schema: str, rows: int = 256) -> DataFrame:
    """``mapInArrow`` that hands ``run`` a task's batches in slices of few rows."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(big.slice(at, rows) for big in batches for at in range(0, big.num_rows, rows))

    return df.mapInArrow(sliced, schema)


# Reading ARC


def _stream(content: bytes) -> io.BufferedIOBase:
    """A file's bytes, unpacked as they are read; gzip members may be whole files or single records."""
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def iso_date(digits: str) -> str | None:
    """The timestamp of an ARC date of 8, 12, 14 or 17 digits; None if it names no time."""
    if len(digits) not in (8, 12, 14, 17):
        return None
    padded = (digits + "000000")[:14]
    year, month, day, hour, minute, second = (int(padded[a:b]) for a, b in ((0, 4), (4, 6), (6, 8), (8, 10), (10, 12), (12, 14)))
    if not (1 <= month <= 12 and 1 <= day <= 31 and hour < 24 and minute < 60 and second < 61):
        return None
    return f"{year:04d}-{month:02d}-{day:02d}T{hour:02d}:{minute:02d}:{second:02d}" + (f".{digits[14:]}Z" if len(digits) == 17 else "Z")


def _head_length(block: bytes) -> int:
    """Bytes of an HTTP message before its payload."""
    ends = [m + len(end) for end in (b"\r\n\r\n", b"\n\n") if (m := block.find(end)) >= 0]
    return min(ends, default=len(block))


def _digest(data: bytes) -> str:
    return f"sha256:{hashlib.sha256(data).hexdigest()}"


def arc_records(archive: str, content: bytes) -> Iterator[dict]:
    """The records of an archive as ``RECORDS``, its version block first. A file that breaks off, or a line of another form, raises."""
    stream, offset, version, default = _stream(content), 0, 1, None
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if not line.strip():
            continue
        found = None
        about = line.startswith(b"filedesc://")
        if about:
            # Of which version the line itself is, only the number of its fields tells.
            found = ARC_LINE[2].match(line) or ARC_LINE[1].match(line)
        found = found or ARC_LINE[version].match(line)
        if not found:
            raise ValueError(f"{archive}: no header line of ARC version {version} at byte {start}")
        url, ip, date, kind, length = (found.group(g).decode("utf-8", "replace") for g in (1, 2, 3, 4, len(found.groups())))
        block = stream.read(int(length))
        if len(block) < int(length):
            raise ValueError(f"{archive}: the record at byte {start} breaks off after {len(block)} of {length} bytes")
        offset += len(block)
        date = iso_date(date)
        head, http = 0, block.startswith(b"HTTP/")
        if about and not http:
            version = int(block.split(None, 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{archive}: ARC version {version} is not known")
            default, what = date, "warcinfo"
        elif http:
            what, kind, head = "response", "application/http; msgtype=response", _head_length(block)
        else:
            what = "resource"
        yield {
            "archive": archive,
            "offset": start,
            "version": version,
            "url": None if url == NO_VALUE else url,
            "ip": None if ip in ("0.0.0.0", NO_VALUE) else ip,
            "date": date or default or UNDATED,
            "content_type": kind,
            "record_id": f"<{uuid.UUID(bytes=hashlib.sha256(f'{archive} {start} '.encode() + line).digest()[:16], version=5).urn}>",
            "type": what,
            "block": block,
            "head": head,
            "block_digest": _digest(block),
            "payload_digest": _digest(block[head:]),
            "payload_bytes": len(block) - head,
        }


def _files(spark: SparkSession, path: str, parse, schema: str) -> DataFrame:
    """What ``parse`` finds in each file under ``path``; batches are bounded by their bytes."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, held = [], 0
                for row in parse(archive.as_py(), content.as_py()):
                    rows.append(row)
                    held += len(row["block"] or b"")
                    if held >= FLUSH:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
                yield _batch(rows, names, kinds)

    kinds = [_ARROW[part.split(None, 1)[1]] for part in schema.split(", ")]
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "map<string,string>": pa.map_(pa.string(), pa.string())}


def _batch(rows: list[dict], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files under ``path``, packed or not: columns as ``RECORDS``."""
    return _files(spark, path, arc_records, RECORDS)


def http_field(block: Column, head: Column, name: str) -> Column:
    """A field of a record's HTTP head as text; null if it has none."""
    text = F.substring(block, F.lit(1), head).cast("string")
    return F.nullif(F.regexp_extract(text, rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1), F.lit(""))


# Writing WARC


def revisits(records: DataFrame, order: list[Column], least_bytes: int) -> DataFrame:
    """(record_id, to_id, to_url, to_date) of the responses that repeat an earlier one's payload of ``least_bytes`` or more.

    The first by ``order`` (nulls last), then by record, is the one they revisit. Only small rows are shuffled, and the
    first of a payload is found by partial aggregates, so a payload that a third of all records have leaves each task once.
    """
    keys = [k for i, c in enumerate(order) for k in (c.isNull().alias(f"none{i}"), c.alias(f"key{i}"))]
    place = F.struct(*keys, "record_id", F.col("url").alias("url"), F.col("date").alias("date"))
    some = records.where((F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes))
    told = kept(some.select("record_id", "payload_digest", place.alias("place")), "arc-places")
    firsts = told.groupBy("payload_digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = told.join(kept(firsts.select("payload_digest", "first"), "arc-firsts"), "payload_digest").where("record_id <> first.record_id")
    return kept(found.select("record_id", F.col("first.record_id").alias("to_id"), F.col("first.url").alias("to_url"), F.col("first.date").alias("to_date")), "arc-revisits")


def _warc_record(r: dict) -> bytes:
    """A record without the two line ends that close it."""
    fields = {"WARC-Type": r["type"], "WARC-Record-ID": r["record_id"], "WARC-Date": r["date"], "WARC-Target-URI": r["url"], "WARC-IP-Address": r["ip"]}
    block, kind = r["block"], r["content_type"]
    if r["type"] == "warcinfo":
        block, kind = f"software: tillmart\r\nformat: WARC File Format 1.1\r\nconverted-from: {r['archive']}\r\narc-version: {r['version']}\r\n".encode(), "application/warc-fields"
        fields["WARC-Target-URI"] = None
        fields["WARC-Block-Digest"] = _digest(block)
    elif r["to_id"]:
        block = block[: r["head"]]
        fields |= {
            "WARC-Type": "revisit",
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": r["to_id"],
            "WARC-Refers-To-Target-URI": r["to_url"],
            "WARC-Refers-To-Date": r["to_date"],
            "WARC-Truncated": "length",
            "WARC-Block-Digest": _digest(block),
            "WARC-Payload-Digest": r["payload_digest"],
        }
    else:
        fields |= {"WARC-Block-Digest": r["block_digest"], "WARC-Payload-Digest": r["payload_digest"]}
    fields |= {"Content-Type": kind, "Content-Length": str(len(block))}
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields.items() if v), "\r\n"]).encode() + block


def write_warc(records: DataFrame, repeats: DataFrame, path: str) -> None:
    """Write ``records`` (as ``RECORDS``) as WARC files; those named in ``repeats`` (see ``revisits``) without payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([_warc_record(r) for r in batch.to_pylist()], pa.binary())], names=["line"])

    lines = _in_slices(records.join(repeats, "record_id", "left"), run, "line binary")
    _packed(lines, WARC_END, path)


def convert(spark: SparkSession, arc_path: str, warc_path: str, order: list[Column] | None = None, least_bytes: int = 100) -> None:
    """Convert all ARC files under ``arc_path``; the archives are read twice, for the digests and for the records.

    ``order`` ranks records of equal payloads by columns of ``read_arc`` (by default their dates); payloads of under
    ``least_bytes`` are always kept. A date that names no time becomes that of its version block, else 1970.
    Versions and packings may be mixed. Without archives nothing but an empty folder is written.
    """
    records = read_arc(spark, arc_path)
    repeats = revisits(records, [F.col("date")] if order is None else order, least_bytes)
    write_warc(records, repeats, warc_path)


# Reading WARC


def _fields(lines: bytes) -> dict[str, str]:
    """Header lines by lower-case name; of a repeated one the last."""
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").splitlines()[1:])
    return {name.strip().lower(): value.strip() for name, mark, value in pairs if mark}


def warc_records(archive: str, content: bytes, blocks: bool = False) -> Iterator[dict]:
    """The records of a WARC file as ``READ``. Payloads are held against their digests; a record that breaks off or differs raises."""
    stream, offset = _stream(content), 0
    while line := stream.readline():
        start, lines = offset, [line]
        offset += len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{archive}: no WARC record at byte {start}")
        while (line := stream.readline()).strip():
            lines.append(line)
            offset += len(line)
        fields = _fields(b"".join(lines))
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"{archive}: the record at byte {start} breaks off after {len(block)} of {length} bytes")
        offset += len(line) + length
        http = fields.get("content-type", "").startswith("application/http")
        head = _head_length(block) if http else 0
        whole = fields["warc-type"] != "revisit"
        wanted = fields.get("warc-payload-digest", "")
        if whole and wanted.startswith("sha256:") and wanted != _digest(block[head:]):
            raise ValueError(f"{archive}: the payload of the record at byte {start} differs from its digest")
        yield {
            "archive": archive,
            "offset": start,
            "record_id": fields["warc-record-id"],
            "type": fields["warc-type"],
            "fields": list(fields.items()),
            "http": list(_fields(block[:head]).items()) if http else None,
            "payload_bytes": length - head if whole else None,
            "block": block if blocks else None,
        }


def read_warc(spark: SparkSession, path: str, blocks: bool = False) -> DataFrame:
    """The records of all WARC files under ``path``: columns as ``READ``; blocks only if asked for.

    ``fields`` and ``http`` have lower-case names. ``payload_bytes`` is null for revisits, whose payload is elsewhere.
    """
    return _files(spark, path, lambda archive, content: warc_records(archive, content, blocks), READ)


def resolved(records: DataFrame, number: str) -> DataFrame:
    """Captures (response or revisit) of ``read_warc``: number, record_type, refers_to (a number), payload_bytes, payload_digest.

    ``number`` is an HTTP field that numbers captures. A revisit takes the size from the response it refers to; the join is
    by record identifier, one small row each, and AQE splits a response with very many revisits. A revisit of
    a record that is in no archive has null size and refers to null.
    """
    told = records.where("type IN ('response', 'revisit')").select(
        "record_id",
        F.col("type").alias("record_type"),
        F.try_element_at("http", F.lit(number)).alias("number"),
        F.try_element_at("fields", F.lit("warc-refers-to")).alias("to_id"),
        F.regexp_replace(F.try_element_at("fields", F.lit("warc-payload-digest")), "^sha256:", "").alias("payload_digest"),
        "payload_bytes",
    )
    told = kept(told, "warc-captures")
    repeats = told.where("record_type = 'revisit'").select(F.col("to_id").alias("wanted")).distinct()
    sources = told.where("record_type = 'response'").join(repeats, F.col("record_id") == F.col("wanted"), "left_semi")
    sources = kept(sources.select(F.col("record_id").alias("to_id"), F.col("number").alias("refers_to"), F.col("payload_bytes").alias("bytes")), "warc-sources")
    found = told.join(sources, "to_id", "left")
    return found.select("number", "record_type", "refers_to", F.coalesce("payload_bytes", "bytes").alias("payload_bytes"), "payload_digest")
