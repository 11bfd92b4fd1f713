"""Legacy archives: both versions, packings, odd payloads, and the round trip through WARC."""

from __future__ import annotations

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import PAGES, plain
from tillmart.llm.arc_convert import ARC_FIELDS, arc_records, convert, iso_date, read_arc, read_warc, warc_records, write_arc
from tillmart.llm.queries import queries

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"


def arc(version: int, *records: tuple[str, str, str, bytes], date: str = "19990131120000") -> bytes:
    """An archive: (url, date, content type, block) of each record."""
    about = f"{version} 0 Somebody\n{ARC_FIELDS[version]}\n".encode()
    out = b""
    for url, when, kind, block in [("filedesc://old.arc", date, "text/plain", about), *records]:
        tail = str(len(block)) if version == 1 else f"200 - - {len(out)} old.arc {len(block)}"
        out += f"{url} 192.0.2.7 {when} {kind} {tail}\n".encode() + block + b"\n"
    return out


RECORDS = [
    ("http://a.example/x", "20010203040506", "text/html", HTTP + b"one\n\nhttp://b.example/ 192.0.2.7 20010203040506 text/html 3\nabc"),
    ("http://a.example/y z", "200102030405", "text/html; charset=utf-8", HTTP + b"\xff\xfe not text \r\n\r\nWARC/1.1\r\n"),
    ("dns:a.example", "20010203", "text/dns", b"a.example 192.0.2.7"),
    ("https://a.example/none", "20019903040506", "text/html", b""),
    ("http://a.example/head", "20010203040506789", "no-type", HTTP),
]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_records_of_both_versions(version, packed):
    content = arc(version, *RECORDS)
    found = list(arc_records("old.arc", gzip.compress(content) if packed else content))
    assert [r["url"] for r in found] == ["filedesc://old.arc"] + [r[0] for r in RECORDS]
    assert [r["block"] for r in found[1:]] == [r[3] for r in RECORDS]
    assert [r["type"] for r in found] == ["warcinfo", "response", "response", "resource", "resource", "response"]
    assert [r["date"] for r in found[1:]] == ["2001-02-03T04:05:06Z", "2001-02-03T04:05:00Z", "2001-02-03T00:00:00Z", "1999-01-31T12:00:00Z", "2001-02-03T04:05:06.789Z"]
    assert found[3]["content_type"] == "text/dns" and found[1]["content_type"].startswith("application/http")
    assert [r["payload_bytes"] for r in found[1:]] == [len(r[3]) - (len(HTTP) if r[3].startswith(HTTP) else 0) for r in RECORDS]
    assert found[1]["payload_digest"] == "sha256:" + hashlib.sha256(RECORDS[0][3][len(HTTP) :]).hexdigest()
    assert len({r["record_id"] for r in found}) == len(found) and {r["version"] for r in found[1:]} == {version}
    assert found == list(arc_records("old.arc", content))


def test_record_by_record_packing():
    """Archives in which every record is a gzip member of its own."""
    content = arc(1, *RECORDS)
    cuts = [0] + [r["offset"] for r in arc_records("old.arc", content)][1:] + [len(content)]
    members = b"".join(gzip.compress(content[a:b]) for a, b in zip(cuts, cuts[1:]))
    assert list(arc_records("old.arc", members)) == list(arc_records("old.arc", content))


def test_broken_archives_raise():
    content = arc(2, *RECORDS[:1])
    with pytest.raises(ValueError, match="breaks off"):
        list(arc_records("old.arc", content[:-20]))
    with pytest.raises(ValueError, match="no header line of ARC version 2"):
        list(arc_records("old.arc", content + b"http://a.example/ 192.0.2.7 20010203040506 text/html 3\nabc\n"))
    with pytest.raises(ValueError, match="version 3"):
        list(arc_records("old.arc", b"filedesc://x 0.0.0.0 20010203040506 text/plain 8\n3 0 Some\n"))
    with pytest.raises(ValueError, match="differs from its digest"):
        body = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
        list(warc_records("new.warc", body))
    assert iso_date("20010229") and iso_date("2001") is None and iso_date("20011301000000") is None


def test_conversion_keeps_every_byte(spark, tmp_path):
    """Mixed versions and packings: blocks, types, dates and identifiers come out of the WARC files as they went in."""
    (tmp_path / "old").mkdir()
    twice = ("http://c.example/", "20010203040506", "text/html", HTTP + b"z" * 300)
    (tmp_path / "old" / "one.arc").write_bytes(arc(1, *RECORDS, twice))
    (tmp_path / "old" / "two.arc.gz").write_bytes(gzip.compress(arc(2, twice, *RECORDS[:2])))
    convert(spark, f"{tmp_path}/old", f"{tmp_path}/new")
    old = {r.record_id: r for r in read_arc(spark, f"{tmp_path}/old").collect()}
    new = {r.record_id: r for r in read_warc(spark, f"{tmp_path}/new", blocks=True).collect()}
    assert old.keys() == new.keys() and len(old) == 11
    for key, was in old.items():
        now = new[key]
        assert now.fields["warc-date"] == was.date
        if was.type == "warcinfo":
            assert now.type == "warcinfo" and bytes(now.block).startswith(b"software:")
        elif now.type == "revisit":
            first = old[now.fields["warc-refers-to"]]
            assert (first.date, first.record_id) < (was.date, was.record_id) and first.payload_digest == was.payload_digest
            assert bytes(now.block) == HTTP and now.fields["warc-refers-to-target-uri"] == first.url and new[first.record_id].type == "response"
        else:
            assert (now.type, bytes(now.block), now.fields.get("warc-target-uri")) == (was.type, bytes(was.block), was.url)
    # Only payloads of 100 bytes or more are worth a revisit.
    assert sum(r.type == "revisit" for r in new.values()) == 1
    convert(spark, f"{tmp_path}/old", f"{tmp_path}/again")
    assert {r.record_id: r.type for r in read_warc(spark, f"{tmp_path}/again").collect()} == {k: r.type for k, r in new.items()}


def brute(rows: list[tuple]) -> list[tuple]:
    first: dict[bytes, int | None] = {}
    for page_id, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault((html or "").encode(), page_id)
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and first[data] != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark, tmp_path):
    """Nulls, empty, small, equal and very long pages, urls that would break a header line, clashing columns."""
    rng = random.Random(5)
    bodies = [None, "", "x" * 99, "x" * 100, "é" * 50, "<p>\r\n\r\nWARC/1.1\r\n\r\n", "a\nb\n" * 60, "long " * 300_000] + [f"<p>{i}</p>" * 40 for i in range(5)]
    urls = [None, "", "http://a.example/ b\n", "http://b.example/é?q=%20", "-", "no scheme", "filedesc://x.arc", "dns:a.example"]
    rows = [(i, urls[i % len(urls)], bodies[rng.randrange(len(bodies))], *["clash"] * 2, 1, "clash", "clash") for i in range(90)]
    rows += [(None, "http://n.example/", "a page without a number " * 9, *["clash"] * 2, 1, "clash", "clash")]
    for n, some in enumerate((rows, [])):
        spark.createDataFrame(some, PAGES).repartition(3).write.parquet(f"{tmp_path}/{n}/pages.parquet")
        got = queries()["op12_arc_convert"](spark, f"{tmp_path}/{n}")
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert plain(got) == brute(some)


def test_rows_that_repeat_a_number(spark, tmp_path):
    """Of rows with equal numbers and payloads one is the response."""
    rows = [(7, "http://a.example/", "same page " * 20)] * 3
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = plain(queries()["op12_arc_convert"](spark, str(tmp_path)).select("page_id", "record_type", "refers_to"))
    assert got == [(7, "response", None), (7, "revisit", 7), (7, "revisit", 7)]


def test_written_archives_are_of_both_versions(spark, tmp_path):
    captures = spark.range(40).repartition(4).select(F.lit("http://a.example/").alias("url"), F.lit(None).cast("string").alias("http"), F.col("id").cast("string").alias("payload"))
    write_arc(captures, f"{tmp_path}/old")
    found = read_arc(spark, f"{tmp_path}/old").where("type = 'response'").groupBy("version").count().collect()
    assert {r.version for r in found} == {1, 2} and sum(r["count"] for r in found) == 40
