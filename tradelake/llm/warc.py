"""Write pages as WARC archives and read them back in byte ranges.

*Writing.*  Each record is a gzip member of its own.  A task packs records
into archives of about ``ARCHIVE`` bytes, each of which is a row, and Spark's
text writer puts the rows' bytes into files through its output committer, so a
task that is lost or run twice leaves no half archive.  What the writer puts
between rows is an empty gzip member, which every gzip reader passes over.

*Reading.*  Files are listed by Spark and cut into byte ranges.  A task looks
for the gzip magic in its range, decodes the member there to see whether it
starts with a WARC header, and owns the records that start inside the range,
reading beyond its end for the last one, piece by piece: time is linear in a
record's length, and only its range and the record itself are held.  Paths are
opened by URI.

Records with equal payloads: the one with the largest page_id is the response,
the others revisit it.  Only digests are grouped, so a payload that a third of
all pages share is one row there.

Defined results: a null html is an empty payload; a null url leaves out the
header; rows without page_id revisit a group's response if there is one with a
page_id and are responses otherwise; rows that repeat the largest page_id of a
group are all responses; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm.scratch import pick
from tradelake.session import checkpoint_root

ARCHIVE = 8 << 20
RANGE = 4 << 20
PIECE = 1 << 18
LEAST_SHARED = 0       # payloads of fewer bytes are never revisited
DATE = "1970-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = zlib.compressobj(wbits=31).flush()

RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "target_uri string, payload binary, path string, offset long")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"none" if page is None else b"%d" % page)


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A gzip member that holds one WARC record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + _name(page),
            b"WARC-Date: " + DATE.encode()]
    if url is not None:   # a blank or control character would end the header
        head.append(b"WARC-Target-URI: " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url.encode()))
    head.append(b"WARC-Payload-Digest: sha1:" + digest_of(payload).encode())
    if revisit:
        head += [b"WARC-Profile: " + REVISIT.encode(), b"WARC-Refers-To: " + _name(refers_to)]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(body)]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n") + squeeze.flush()


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for batch in batches:
        for page, url, payload, keeper, revisit in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(record(page, url, payload, keeper, revisit))
            weight += len(held[-1])
            if weight >= ARCHIVE:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])
                held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record for every row below the folder ``path``."""
    rows = pick(pages, page_id=page_id, url=url, html=html).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")).withColumn("sha1", F.sha1("payload"))
    shared = rows.filter(F.octet_length("payload") >= LEAST_SHARED).groupBy("sha1").agg(
        F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha1", "keeper")
    typed = rows.join(shared, "sha1", "left").select(
        "page_id", "url", "payload", "keeper",
        (F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))).alias("revisit"))
    archives = typed.mapInArrow(_archives, "archive binary").select(F.col("archive").cast("string").alias("value"))
    # the separator is bytes: Latin-1 maps the characters 0 to 255 to themselves
    archives.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


class _Bytes:
    """A file's bytes: those of a range are held, what a record has behind it is
    read piece by piece and not kept."""

    def __init__(self, file: pa.NativeFile, start: int, size: int) -> None:
        self.file, self.start, self.data = file, start, file.read_at(size, start)

    def piece(self, at: int) -> bytes:
        """Some bytes from file offset ``at`` on; none at the end of the file."""
        held = self.data[at - self.start:at - self.start + PIECE]
        return held or self.file.read_at(PIECE, at)

    def member(self, at: int, first: bytes) -> tuple[bytes, int] | None:
        """The gzip member at file offset ``at`` and the offset behind it, if it
        is whole and its content starts with ``first`` or is empty."""
        loose, out, pos = zlib.decompressobj(31), bytearray(), at
        while not loose.eof:
            piece = self.piece(pos)
            if not piece:
                return None
            try:
                out += loose.decompress(piece)
            except zlib.error:
                return None
            pos += len(piece)
            if not out.startswith(first[:len(out)]):
                return None
        return bytes(out), pos - len(loose.unused_data)


def _page(name: bytes | None) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?\d+)>", name or b"")
    return int(m[1]) if m else None


def parse(content: bytes) -> tuple | None:
    """The fields of one record, or None if it isn't a whole one."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:] if b": " in x)
    size = fields.get(b"Content-Length", b"")
    if not gap or not size.isdigit() or rest[int(size):] != b"\r\n\r\n":
        return None
    http, _, payload = rest[:int(size)].partition(b"\r\n\r\n")
    kind = fields.get(b"WARC-Type", b"").decode()
    told = fields.get(b"WARC-Payload-Digest", b"").removeprefix(b"sha1:").decode()
    n = re.search(rb"\r\nContent-Length: (\d+)", http)
    uri = fields.get(b"WARC-Target-URI")
    if kind == "response" and told != digest_of(payload):
        raise ValueError(f"payload of {fields.get(b'WARC-Record-ID')!r} does not have its digest {told}")
    return (_page(fields.get(b"WARC-Record-ID")), len(payload) if kind == "response" else int(n[1]) if n else None, told,
            kind, _page(fields.get(b"WARC-Refers-To")), uri.decode() if uri is not None else None,
            payload if kind == "response" else None)


def records_in(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, tuple]]:
    """(offset, fields) of the records that start in [start, end)."""
    data = _Bytes(file, start, end - start + len(MAGIC) - 1)
    at = start
    while True:
        found = data.data.find(MAGIC, at - start, max(0, end - start + len(MAGIC) - 1))
        if found < 0 or start + found >= end:
            return
        at = start + found
        member = data.member(at, b"WARC/1.")
        fields = parse(member[0]) if member and member[0] else None
        if member and (fields or not member[0]):
            if fields:
                yield at, fields
            at = member[1]
        else:
            at += 1     # the magic by chance, inside compressed data


def _open(path: str) -> pa.NativeFile:
    uri = re.sub(r"^file:/+", "file:///", path)
    fs, inner = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(inner)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True, size: int = RANGE) -> DataFrame:
    """All records of the archives below ``path``, in ranges of ``size`` bytes."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long")))
                          .alias("start")).select("path", "start", F.least(F.col("start") + size, F.col("length")).alias("end"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in RECORD.split(", ")]
        for batch in batches:
            for where, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(where) as file:
                    rows = [(*(f if with_payload else (*f[:-1], None)), where, at) for at, f in records_in(file, start, end)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    # ranges are a few bytes each: dealt out by number, so that each is a task's own
    tasks = max(1, spark.sparkContext.defaultParallelism)
    return ranges.repartition(4 * tasks).mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write ``pages`` to a new folder of the shared checkpoint folder and read
    the records back."""
    spark = pages.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
    write_warc(pages, path, **columns)
    return read_warc(spark, path, with_payload=False)
