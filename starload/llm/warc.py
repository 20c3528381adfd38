"""WARC archives: writing, and the normaliser of monolithic gzip files (operator 10).

* ``write_monolithic``: records as text files, each compressed as one gzip stream,
  by Spark's own writer. Records end with CRLF CRLF, which is the writer's line
  separator. A record whose payload another one carries is a revisit without it.
* ``normalise``: each whole-file stream is opened by its path and inflated once, piece
  by piece, so a task holds one record at a time, whatever the archive's size; every
  record becomes a gzip member of its own in a new archive, and its offset and
  length go to a sidecar index (one line of JSON for each record beside the
  archive, and the rows of the result).
* ``read_records``: reads records by index, one member at a time.

New archives are written through pyarrow's file systems to a folder of the shared
store, under a name of their own for each attempt, and moved into place when
complete, so a lost or repeated task leaves one whole archive.

Cases: a null html is an empty payload; records with equal payloads of at least
``LEAST_BYTES`` bytes revisit the one with the largest page_id, several rows with
that page_id are all responses; null page_ids are smallest of all, and where all
are null each row is a response; a null url is an empty target; a payload may hold
any text, CRLF CRLF and WARC headers too, as its length is given; an empty table
makes no archive and gives an empty result. A record's id comes from its page_id and
payload, so rows that share both share it, and a repeated task writes the same ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import workers_import, written

LEAST_BYTES = 0
#: Records of one archive at most.
ARCHIVE_RECORDS = 1000
LEVEL = 6
PIECE = 1 << 16
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
INDEX = "archive string, at long, length long, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hexadecimal: five digits make four letters."""
    four = lambda i: F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*[four(i) for i in range(8)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _one_line(c: Column) -> Column:
    """Header values hold no line breaks: they are percent-encoded."""
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One row for each page with its header fields and payload."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"), base32(F.sha1(F.encode(html, "UTF-8"))).alias("payload_digest"),
    )
    # Only payloads that occur more than once: few rows, whose true size the planner sees.
    groups = keyed.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    groups = written(groups.where("n > 1").select("payload_digest", "payload_bytes", "largest"), "payload-groups")
    return keyed.join(groups, ["payload_digest", "payload_bytes"], "left").withColumn("refers_to", F.when(F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")))


def record_id(page_id: Column, digest: Column) -> Column:
    """The record of a page and payload as a URN."""
    h = F.md5(F.concat(F.coalesce(page_id.cast("string"), F.lit("-")), F.lit("/"), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _header(revisit: Column) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    opt = lambda name, value: F.coalesce(line(name, value.cast("string")), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        F.when(revisit, line("WARC-Refers-To", record_id(F.col("refers_to"), F.col("payload_digest")))).otherwise(""),
        line("WARC-Target-URI", _one_line(F.col("url"))),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        opt("X-Page-Id", F.col("page_id")),
        F.when(F.col("url").isNull(), F.lit("X-Url-Null: 1\r\n")).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Bytes", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"), line("X-Refers-To-Page-Id", F.col("refers_to").cast("string")))).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    )


def write_monolithic(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, most: int = ARCHIVE_RECORDS) -> None:
    """Archives of at most ``most`` records, each a single gzip stream."""
    revisit = F.col("refers_to").isNotNull()
    text = F.concat(_header(revisit), F.lit("\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    out = records(pages, least_bytes).select(text.alias("value")).write
    out.option("compression", "gzip").option("lineSep", END.decode()).option("maxRecordsPerFile", most).text(path)


class _Reader:
    """Bytes of a gzip file (one member or many) on demand; each byte is inflated once."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.inflate, self.have, self.over = iter(pieces), zlib.decompressobj(31), bytearray(), False

    def _more(self) -> bool:
        while not self.over:
            left = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            if not left:
                left = next(self.pieces, b"")
            if not left:
                self.over = True
                break
            got = self.inflate.decompress(left, 1 << 20)
            if got:
                self.have += got
                return True
        return False

    def until(self, end: bytes) -> bytes | None:
        at = 0
        while (i := self.have.find(end, at)) < 0:
            at = max(0, len(self.have) - len(end))
            if not self._more():
                if self.have.strip():
                    raise ValueError("the archive ends within a record's header")
                return None
        return self.take(i + len(end))

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        with memoryview(self.have) as have:
            out = bytes(have[:n])
        del self.have[:n]
        return out


def parse_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], memoryview, bytes]]:
    """(header fields, payload, the record's bytes) of each record of a gzip file; the
    payload is a view of the record."""
    r = _Reader(pieces)
    while (head := r.until(END)) is not None:
        head = head.lstrip(b"\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record here")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:] if x)
        size = int(fields["Content-Length"])
        record = head + r.take(size + len(END))
        yield fields, memoryview(record)[len(head) : len(head) + size], record
        del record


def pieces_of(uri: str) -> Iterator[bytes]:
    """A file's bytes, a piece at a time."""
    fs, path = _file_system(uri)
    with fs.open_input_stream(path, compression=None) as stream:
        while piece := stream.read(PIECE):
            yield piece


def member(record: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def _int(x: str | None) -> int | None:
    return None if x is None else int(x)


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in the shared store."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if uri.startswith("file:") else uri)


def _normaliser(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _file_system(target)
        for b in batches:
            for path in b["path"].to_pylist():
                name = path.rpartition("/")[2].partition(".")[0] + ".warc.gz"
                task = TaskContext.get()
                attempt = f"{folder}/_attempt-{task.taskAttemptId() if task else 0}-{uuid.uuid4().hex[:8]}-{name}"
                at, rows = 0, []
                with fs.open_output_stream(attempt, compression=None) as out:
                    for fields, view, record in parse_records(pieces_of(path)):
                        del view
                        packed = member(record)
                        out.write(packed)
                        url = None if "X-Url-Null" in fields else fields["WARC-Target-URI"]
                        rows.append((name, at, len(packed), _int(fields.get("X-Page-Id")), url, fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Bytes"]), _int(fields.get("X-Refers-To-Page-Id"))))
                        at += len(packed)
                        del record  # before the next one is read
                names = [c.split()[0] for c in INDEX.split(", ")]
                with fs.open_output_stream(attempt + ".idx", compression=None) as out:
                    out.write("".join(json.dumps(dict(zip(names, r, strict=True))) + "\n" for r in rows).encode())
                fs.move(attempt, f"{folder}/{name}")
                fs.move(attempt + ".idx", f"{folder}/{name}.idx")
                if rows:
                    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every gzip file below ``source`` into ``target``, a folder of the shared
    store, and return the sidecar index. Spark deals out paths; a task reads each file as
    a stream, so both folders must be such that pyarrow can open them."""
    workers_import(spark)
    fs, folder = _file_system(target)
    fs.create_dir(folder, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    return written(files.mapInArrow(_normaliser(target), INDEX), "warc-index")


def read_records(index: DataFrame, target: str) -> DataFrame:
    """The records that an index names, read from their members: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to, url, payload``. A
    response's length and digest are those of the payload read; they must equal the
    index's, or the read fails."""
    workers_import(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _file_system(target)
        opened: tuple[str, pa.NativeFile] | None = None
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if opened is None or opened[0] != r["archive"]:
                    opened = (r["archive"], fs.open_input_file(f"{folder}/{r['archive']}"))
                [(fields, payload, _)] = parse_records([opened[1].read_at(r["length"], r["at"])])
                kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Bytes"])
                if kind == "response":
                    digest, size = b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
                if (digest, size, _int(fields.get("X-Page-Id"))) != (r["payload_digest"], r["payload_bytes"], r["page_id"]):
                    raise ValueError(f"{r['archive']} at {r['at']} does not hold the record of its index")
                rows.append((r["page_id"], size, digest, kind, _int(fields.get("X-Refers-To-Page-Id")), r["url"], bytes(payload) if kind == "response" else None))
            if rows:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])

    return index.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def archived(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back: one row for each page."""
    spark = pages.sparkSession
    whole, single = scratch_path(spark, "llm-warc-whole"), scratch_path(spark, "llm-warc")
    write_monolithic(pages, whole)
    index = normalise(spark, whole, single)
    return read_records(index, single).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB. Five hexadecimal digits of the SHA-1 make four letters of base32.
ORACLE = """
with p as (
  select page_id, coalesce(html, '') as html from pages
), d as (
  select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as h from p
), k as (
  select page_id, payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int, 1)), '') as payload_digest
  from d
), m as (
  select *, max(page_id) over (partition by payload_digest, payload_bytes) as largest from k
)
select page_id, payload_bytes, payload_digest,
  case when largest is null or page_id = largest then 'response' else 'revisit' end as record_type,
  case when largest is null or page_id = largest then null else largest end as refers_to
from m
"""
