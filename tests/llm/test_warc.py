import hashlib
import io
import zlib

import pytest

from revlens.llm import warc
from revlens.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def expected(rows, least=warc.MIN_REVISIT_BYTES):
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        same = [q for q, _, g in rows if (g or "").encode() == data and q is not None]
        again = len(data) >= least and same and p != max(same)
        out.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
                    max(same) if again else None))
    return sorted(out, key=str)


def run(spark, rows, data=False, **args):
    folder = scratch_path(spark, "test-warc")
    manifest = warc.write_archives(warc.decide(spark.createDataFrame(rows, SCHEMA)), folder, **args)
    return warc.read_archives(manifest, folder, chunk_bytes=1024, data=data)


def test_records_and_chunks(spark):
    big = "é<p>" * 2000
    rows = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "http://a", big), (None, "u", big), (4, "u", None), (5, "u", ""),
            (6, "u", "small"), (7, "u", "small"), (8, "u", "WARC/1.1\r\n\r\n" * 300), (9, "u", "x" * 1024),
            (3, "http://a", big), (10, "u", "y" * 1000), (11, "u", "y" * 1000), (12, "u", "z" * 999), (13, "u", "z" * 999)]
    chunks = run(spark, rows, data=True, archive_bytes=2000)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in warc.page_records(chunks).collect()]
    assert sorted(got, key=str) == expected(rows)
    texts = {}
    for r in sorted(chunks.collect(), key=lambda r: (r.record_id, r.chunk_no)):
        assert r.chunk_bytes <= 1024 and len(r.data) == r.chunk_bytes
        if r.record_type == "response":
            held = texts.setdefault(r.record_id, [r.page_id, b""])
            held[1] += bytes(r.data)
            assert hashlib.sha1(held[1]).hexdigest() == r.sha1_so_far and len(held[1]) == r.payload_bytes
    html = {p: (h or "").encode() for p, _, h in rows}
    assert all(data == html[p] for p, data in texts.values())


def test_empty_table(spark):
    assert run(spark, []).count() == 0


def test_broken_archives_are_refused():
    good = b"".join(warc._record(1, "u", "abc", hashlib.sha1(b"abc").hexdigest(), 3, None))
    wrong = b"".join(warc._record(1, "u", "abc", hashlib.sha1(b"abd").hexdigest(), 3, None))
    rows = list(warc.read_file(io.BufferedReader(warc._Members(io.BytesIO(zlib.compress(good, wbits=31) * 2))), "f"))
    assert [r[0] for r in rows] == ["f#0", "f#1"]
    for bad in (wrong, good[:-6]):
        with pytest.raises((ValueError, KeyError)):
            list(warc.read_file(io.BytesIO(bad), "f"))


def test_long_urls_come_back_whole(spark):
    urls = ["http://ab/" + "é" * 200_000, "http://a/" + "x" * 70_000, "http://a/?" + "\r\n" * 40_000, "日" * 21_845, None, ""]
    rows = [(i, u, f"<p>{i}</p>" * 300) for i, u in enumerate(urls)]
    chunks = run(spark, rows).filter("is_last").collect()
    want = {i: u if u is None else u.replace("\r", "%0D").replace("\n", "%0A") for i, u in enumerate(urls)}
    assert {r.page_id: r.url for r in chunks} == want
    assert all(r.payload_bytes == 3000 - 600 for r in chunks if r.page_id < 10)


def test_long_payloads_and_clashing_columns(spark):
    html = "é<p>" * 2_000_000
    docs = spark.createDataFrame([(1, "u", html), (2, "u", html)], SCHEMA)
    for c in ("digest", "size", "keeper", "d", "s", "refers_to", "n"):
        docs = docs.withColumn(c, docs["url"])
    folder = scratch_path(spark, "test-warc")
    got = warc.page_records(warc.read_archives(warc.write_archives(warc.decide(docs), folder), folder)).collect()
    digest = hashlib.sha1(html.encode()).hexdigest()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in got) == [
        (1, 10_000_000, digest, 2), (2, 10_000_000, digest, None)]
