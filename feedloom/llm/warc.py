"""WARC archives: a writer with revisit records and a splittable reader.

Writer: every page becomes one gzip member.  Of pages with equal payloads of at
least ``min_revisit`` bytes, the one with the smallest page_id is a response;
the others are revisits that refer to it and carry headers only.  A task writes
files under names of its own and reports them; only reported files count, so a
repeated or lost task leaves nothing behind that a reader would see.

Reader: files are cut into byte ranges, and every range is read on its own.  The
task looks for the gzip magic, and a candidate counts if its first bytes decode
to the beginning of a WARC header, however long that is.  A record belongs to the range in which its
member starts, even if it ends beyond; so all ranges together give each record
once, whatever their size.  From a record's end the task goes on with the next
member.  Payload digests of response records are checked against the header.

Files are reached through Arrow's file systems by URI, so the archive folder may
be any store that the executors share.

Defined cases: null html is an empty payload; null url leaves out the target
header; a null page_id never names a response that others refer to, and its
record is a response; rows that repeat the smallest page_id are all responses;
smaller payloads are all responses; an empty table gives no files and no rows;
other columns are not written."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import binary, cut, lookup
from feedloom.session import scratch_path

MIN_REVISIT = 100
FILE_BYTES = 64 << 20         # a writer begins another file after so many
RANGE_BYTES = 4 << 20         # of a file that one task scans
READ_BYTES = 1 << 20          # of a file read at once
PIECE_BYTES = 1 << 14         # decoded or searched at once, doubling within a record
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def judged(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, digest, refers_to: refers_to is null for responses."""
    body = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    src = pages.select("page_id", "url", "html", F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("n"))
    groups = (src.filter(F.col("n") >= min_revisit).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("rows"), F.min("page_id").alias("first")).filter("rows > 1"))
    found = lookup(src.drop("n"), groups, "digest", "rows", "page_id")
    return found.withColumn("refers_to", F.when(F.col("page_id") > F.col("first"), F.col("first"))).drop("first")


def record(page_id: int | None, url: str | None, body: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + body
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def write_warc(spark: SparkSession, pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the archive; returns its files (path, size, records)."""
    def run(batches):
        out, path, size, count = None, None, 0, 0
        fs, root = pafs.FileSystem.from_uri(folder)

        def close():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "size": [size], "records": [count]})

        for batch in batches:
            html = binary(batch.column("html")).to_pylist()
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")), html)
            for page_id, url, digest, refers_to, body in rows:
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    path, size, count = f"{folder}/{name}", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = record(page_id, url, body, digest, refers_to)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= FILE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    rows = judged(pages, min_revisit).select("page_id", "url", "html", "digest", "refers_to")
    return cut(spark, rows.mapInArrow(run, "path string, size long, records long"), "warc-files")


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size) of the files in a folder, as Spark lists them; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("size"))


class Member:
    """A gzip member that is decoded from a byte source bit by bit."""

    def __init__(self, source, at: int):
        self.source, self.at, self.z, self.data, self.step = source, at, zlib.decompressobj(31), b"", PIECE_BYTES

    def more(self) -> bool:
        """Decode another piece; False at the member's end."""
        if self.z.eof:
            return False
        raw = self.source.read_at(self.step, self.at)
        if not raw:
            return False
        self.step = min(READ_BYTES, 2 * self.step)
        self.data += self.z.decompress(raw)
        self.at += len(raw) - len(self.z.unused_data)
        return not self.z.eof


class Window:
    """Reads through a small buffer, so that neighbouring members cost one read.

    A read gives all n bytes, or those up to the end of the file: the buffer's end never cuts
    one short, so no magic number is seen in part only."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.buffer = file, size, 0, b""

    def read_at(self, n: int, at: int) -> bytes:
        if not (self.start <= at and min(at + n, self.size) <= self.start + len(self.buffer)):
            self.start, self.buffer = at, self.file.read_at(min(max(n, READ_BYTES), self.size - at), at) if at < self.size else b""
        return self.buffer[at - self.start:at - self.start + n]


def begins_record(source: Window, at: int) -> Member | None:
    """The member at ``at`` if it decodes to a whole WARC header; otherwise None."""
    m, searched = Member(source, at), 0
    try:
        while True:
            going = m.more()
            if m.data and not m.data.startswith(b"WARC/1."[:len(m.data)]):
                return None
            if m.data.find(b"\r\n\r\n", max(0, searched - 3)) >= 0:
                return m
            if not going:
                return None
            searched = len(m.data)
    except zlib.error:
        return None


def scan(source: Window, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records whose member starts in [start, end)."""
    at = start
    while at < end:
        raw = source.read_at(PIECE_BYTES, at)
        if not raw:
            return
        hit = raw.find(MAGIC)
        if hit < 0:
            at += max(1, len(raw) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= end:
            return
        m = begins_record(source, at)
        if m is None:
            at += 1
            continue
        while m.more():
            pass
        if not m.z.eof:
            raise ValueError(f"record at byte {at} is cut off")
        head, _, rest = m.data.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield at, headers, rest[:int(headers["Content-Length"])]
        at = m.at


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = False) -> DataFrame:
    """path, start, record_type, record_id, refers_to, target_uri, payload_bytes, payload_digest
    (and payload) of every record in ``files`` (path, size)."""
    ranges = (files.select("path", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)),
                                                                F.lit(range_bytes).cast("long"))).alias("begin"))
              .repartition("path", "begin"))
    names = ["path", "start", "record_type", "record_id", "refers_to", "target_uri", "payload_bytes", "payload_digest"]
    names += ["payload"] * with_payload

    def run(batches):
        for batch in batches:
            for path, size, begin in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "begin"))):
                fs, where = pafs.FileSystem.from_uri(path)
                rows = []
                held = 0
                with fs.open_input_file(where) as f:
                    for at, h, block in scan(Window(f, size), begin, min(size, begin + range_bytes)):
                        http, _, body = block.partition(b"\r\n\r\n")
                        digest = h.get("WARC-Payload-Digest", "").removeprefix("sha256:")
                        if h["WARC-Type"] == "revisit":
                            n = int(re.search(rb"(?i)\ncontent-length: (\d+)", http)[1])
                        else:
                            n = len(body)
                            if hashlib.sha256(body).hexdigest() != digest:
                                raise ValueError(f"{path}: payload digest of the record at byte {at} does not match")
                        strip = lambda k: h[k].strip("<>") if k in h else None  # noqa: B023, E731
                        rows.append((path, at, h["WARC-Type"], strip("WARC-Record-ID"), strip("WARC-Refers-To"),
                                     h.get("WARC-Target-URI"), n, digest, *[body] * with_payload))
                        held += len(body) * with_payload
                        if len(rows) >= 5000 or held > 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), *[pa.binary()] * with_payload]
    return ranges.mapInArrow(run, "path string, start long, record_type string, record_id string, refers_to string, "
                             "target_uri string, payload_bytes long, payload_digest string"
                             + ", payload binary" * with_payload)


def page_number(urn: str):
    """The page_id in a column of record names, null for others."""
    return F.regexp_extract(urn, r"^urn:page:(-?\d+)$", 1).try_cast("long")


def archive_pages(spark: SparkSession, pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder and read it back: one row per record.

    Fails if a file gives more or fewer records than were written to it."""
    files = write_warc(spark, pages, scratch_path(spark, "warc"), min_revisit)
    records = cut(spark, read_warc(files), "warc-records")
    found = records.groupBy("path").agg(F.count(F.lit(1)).alias("found"))
    lost = files.join(found, "path", "left").filter(F.col("records") != F.coalesce("found", F.lit(0))).first()
    if lost is not None:
        raise ValueError(f"{lost['path']}: {lost['records']} records written, {lost['found'] or 0} read")
    return records.withColumn("page_id", page_number("record_id")).withColumn(
        "refers_page", page_number("refers_to"))
