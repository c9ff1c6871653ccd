"""Archives: whole-file gzip in, one member per record out."""

import gzip
import hashlib
import zlib
from pathlib import Path

from tellurion.llm import warc

LARGE = "<p>same</p>" * 200
PAGES = [
    (1, "http://a/ b\n", LARGE), (9, None, LARGE), (4, "http://c", LARGE), (None, "http://d", LARGE),
    (5, "u", "short"), (6, "u", "short"), (7, "u", None), (8, "u", ""), (10, "u", "é" * 500), (11, "u", "é" * 500),
    (12, "u", "x" * 999), (13, "u", "x" * 999), (20, "u", "a\r\n\r\nWARC/1.1\r\n\r\n"), (21, "u", "z" * 3_000_000),
]


def test_round_trip(spark, tmp_path):
    rows = [(i, u, t, "extra") for i, u, t in PAGES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(3)
    archives = warc.write_archives(warc.records(pages), f"file://{tmp_path}/whole", archive_bytes=5000)
    members = warc.index(archives, f"file://{tmp_path}/members")
    got = {r.record_id: r for r in warc.read_records(members).collect()}
    assert set(got) == {i for i, _, _ in PAGES}
    for i, _, text in PAGES:
        data = (text or "").encode()
        same = [j for j, _, t in PAGES if (t or "") == (text or "") and j is not None]
        revisit = len(data) >= 1000 and i != max(same)
        row = got[i]
        assert (row.record_type, row.refers_to) == (("revisit", max(same)) if revisit else ("response", None))
        assert (row.payload_bytes, row.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (row.payload is None) if revisit else bytes(row.payload) == data
    assert got[1].target_uri == "http://a/%20b%0A" and got[9].target_uri is None
    for row in members.collect():
        data = Path(row.archive.removeprefix("file://")).read_bytes()[row.offset : row.offset + row.length]
        inflate = zlib.decompressobj(31)
        assert inflate.decompress(data).startswith(b"WARC/1.1\r\n") and inflate.eof and not inflate.unused_data


def test_foreign_archive_of_several_members(spark, tmp_path):
    def record(n, body):
        return (
            f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{n}>\r\n"
            f"Content-Length: {len(body)}\r\n\r\n"
        ).encode() + body + b"\r\n\r\n"

    body = b"HTTP/1.1 200 OK\r\n\r\n" + b"q" * 2_500_000
    path = tmp_path / "one.warc.gz"
    path.write_bytes(gzip.compress(record(1, body) + record(2, body)) + gzip.compress(record(3, b"")))
    archives = spark.createDataFrame([(f"file://{path}",)], "archive string")
    members = warc.normalise(archives, f"file://{tmp_path}/out").collect()
    assert [m.record_id for m in sorted(members, key=lambda m: m.offset)] == [1, 2, 3]
    ends = sorted((m.offset, m.offset + m.length) for m in members)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write_archives(warc.records(pages), f"file://{tmp_path}/whole")
    assert warc.read_records(warc.index(archives, f"file://{tmp_path}/members")).count() == 0
