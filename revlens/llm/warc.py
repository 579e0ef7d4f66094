"""Operator 2, WARC: pages to archives and back through a chunked record table.

Writing: one WARC record per page, gzip member by member, in archive files of
bounded size in the shared folder.  Of records with equal payloads of at least
``MIN_REVISIT_BYTES`` bytes the one with the largest page_id is the response,
the others are revisits that carry the HTTP header only and refer to it.

Reading: archives are streamed; a payload becomes rows (record_id, chunk_no)
of at most ``CHUNK_BYTES`` bytes, each with the SHA-1 of the payload up to its
end, so neither side of the pipe holds a whole record.  The last chunk of a
record carries the digest of the full payload, which is checked against the
record's header.

Recovery: a task writes files under names of its own, and the manifest of
files, written by Spark's committer, lists those of the successful attempt
only.  A lost executor's files are never read.

Defined cases: null html is an empty payload; records below the minimum are
all responses; rows that share the largest page_id of their payload are all
responses; a row with null page_id is a revisit if the payload has another
id, else a response; a null url leaves its header out, line breaks in it are
percent-encoded; no pages, no archives.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import written
from revlens.session import scratch_path

CHUNK_BYTES = 1 << 20
ARCHIVE_BYTES = 128 << 20
MIN_REVISIT_BYTES = 1000
GZIP_LEVEL = 3
DATE = "2024-01-01T00:00:00Z"  # the pages carry no fetch time; a fixed date keeps archives repeatable

MANIFEST = "file string, records long, bytes long"
CHUNKS = ("record_id string, chunk_no long, record_type string, page_id long, refers_to long, url string, "
          "chunk_bytes long, payload_bytes long, sha1_so_far string, is_last boolean")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder: a URI any pyarrow file system knows, or a plain path."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def _int(value) -> int | None:
    return None if value is None else int(value)


# ---- decide -----------------------------------------------------------------


def decide(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, digest, size, refers_to (null for a response).

    Groups of equal payloads are found on (digest, size) alone, with map-side
    partial aggregation; only those of two or more records are kept, written
    and joined back, so a hot payload is split by AQE or the table is broadcast.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                        F.octet_length(html).cast("long").alias("size"))
    groups = (
        rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1).select(F.col("digest").alias("d"), F.col("size").alias("s"), "keeper")
    )
    groups = written(groups, "equal_payloads")
    joined = rows.join(groups, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select("page_id", "url", "html", "digest", "size",
                         F.when(revisit, F.col("keeper")).alias("refers_to"))


# ---- write ------------------------------------------------------------------


def _record(page_id, url, html: str, digest: str, size: int, refers_to) -> Iterator[bytes]:
    """The bytes of one record: header, HTTP header, payload in chunks, end."""
    response = refers_to is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if not response:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(http) + (size if response else 0)}")
    yield "\r\n".join(head).encode() + b"\r\n\r\n" + http
    if response:
        for i in range(0, len(html), CHUNK_BYTES // 4):
            yield html[i:i + CHUNK_BYTES // 4].encode()
    yield b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write decided records as .warc.gz files under ``folder``; the manifest of files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        done: list[tuple[str, int, int]] = []
        name, n = "", 0
        for b in batches:
            for row in b.itertuples(index=False):
                page_id, url, html, digest, size, refers_to = (None if pd.isna(x) else x for x in row)
                if out is None:
                    fs, base = _open(folder)
                    fs.create_dir(base, recursive=True)
                    name, n = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                for part in _record(_int(page_id), url, html, digest, int(size), _int(refers_to)):
                    out.write(z.compress(part))
                out.write(z.flush())
                n += 1
                if out.tell() >= archive_bytes:
                    done.append((name, n, out.tell()))
                    out.close()
                    out = None
        if out is not None:
            done.append((name, n, out.tell()))
            out.close()
        yield pd.DataFrame(done, columns=["file", "records", "bytes"])

    ordered = records.select("page_id", "url", "html", "digest", "size", "refers_to")
    return written(ordered.mapInPandas(run, MANIFEST), "warc_manifest")


# ---- read -------------------------------------------------------------------


class _Members(io.RawIOBase):
    """A stream over the concatenated gzip members of a file, a bounded buffer at a time."""

    def __init__(self, raw) -> None:
        self.raw, self.z, self.left = raw, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buf) -> int:
        while True:
            data = self.left or self.raw.read(1 << 16)
            if self.z.eof:
                if not data:
                    return 0
                self.z = zlib.decompressobj(31)
            if not data:
                return 0
            got = self.z.decompress(data, len(buf))
            self.left = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if got:
                buf[: len(got)] = got
                return len(got)


def _fields(f) -> dict[str, str]:
    out: dict[str, str] = {}
    while (line := f.readline()) not in (b"\r\n", b""):
        k, _, v = line.decode("utf-8").rstrip("\r\n").partition(": ")
        out[k] = v
    return out


def read_file(f, name: str, chunk_bytes: int = CHUNK_BYTES, data: bool = False) -> Iterator[tuple]:
    """The chunk rows of one open archive, in order."""
    n = 0
    while f.readline():  # the version line
        head = _fields(f)
        left = int(head["Content-Length"])
        start = f.readline()
        left -= len(start)
        http: dict[str, str] = {}
        while (line := f.readline()) != b"\r\n":
            k, _, v = line.decode("utf-8").rstrip("\r\n").partition(": ")
            http[k] = v
            left -= len(line)
        left -= 2
        kind, rid = head["WARC-Type"], f"{name}#{n}"
        page = int(head["X-Page-ID"]) if "X-Page-ID" in head else None
        ref = int(head["X-Refers-To-Page-ID"]) if kind == "revisit" else None
        url, want = head.get("WARC-Target-URI"), head["WARC-Payload-Digest"].removeprefix("sha1:")
        tail = (b"",) if data else ()
        if kind == "revisit":
            yield (rid, 0, kind, page, ref, url, 0, int(http["Content-Length"]), want, True, *tail)
        else:
            sha, chunk_no, total, more = hashlib.sha1(), 0, 0, True
            while more:
                part = f.read(min(chunk_bytes, left))
                if len(part) < min(chunk_bytes, left):
                    raise ValueError(f"{rid}: the archive ends within a record")
                left -= len(part)
                total += len(part)
                sha.update(part)
                more = left > 0
                if not more and sha.hexdigest() != want:
                    raise ValueError(f"{rid}: payload digest {sha.hexdigest()}, header {want}")
                yield (rid, chunk_no, kind, page, ref, url, len(part), total, sha.hexdigest(), not more,
                       *((part,) if data else ()))
                chunk_no += 1
        if f.read(4) != b"\r\n\r\n":
            raise ValueError(f"{rid}: no record end")
        n += 1


def read_archives(manifest: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, data: bool = False) -> DataFrame:
    """The chunk table of the manifest's archives; ``data`` adds the bytes of each chunk."""
    fields = CHUNKS + (", data binary" if data else "")
    names = [x.strip().split(" ")[0] for x in fields.split(",")]
    types = {k: "Int64" for k in ("chunk_no", "page_id", "refers_to", "chunk_bytes", "payload_bytes")}

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype(types)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for name in b["file"]:
                fs, base = _open(folder)
                with fs.open_input_stream(f"{base}/{name}", compression=None) as raw:
                    for row in read_file(io.BufferedReader(_Members(raw), 1 << 17), name, chunk_bytes, data):
                        held.append(row)
                        size += row[6] if data else 0
                        if len(held) >= 10_000 or size >= 8 * chunk_bytes:
                            yield frame(held)
                            held, size = [], 0
        if held:
            yield frame(held)

    files = manifest.select("file")
    # one row per archive of up to ARCHIVE_BYTES: spread one by one over the tasks
    n = max(1, files.count())
    return files.coalesce(1).repartition(n).mapInPandas(run, fields)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "llm", "warc")


def page_records(chunks: DataFrame) -> DataFrame:
    """One row per record: full payload size and digest, type and reference."""
    return chunks.filter("is_last").select(
        "page_id", "payload_bytes", F.col("sha1_so_far").alias("payload_digest"), "record_type", "refers_to",
        (F.col("chunk_no") + 1).alias("n_chunks"),
    )
