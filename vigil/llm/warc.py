"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC
records, closed by a *seek table*: a skippable frame that lists every frame's
compressed and uncompressed size (the Zstandard seekable format).  Any plain
Zstandard reader can read a bundle through; a reader that knows the table can
fetch one frame.

Tasks write bundles under a folder that the cluster shares, each attempt under a
name of its own, and return the index: record id -> bundle, frame, offset within
the frame.  Only bundles named in the index count, so what a failed attempt left
behind is never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import materialize, work_path

#: Uncompressed bytes after which a frame ends, and compressed bytes after which a bundle does.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 32 << 20

# Fixed values of the seekable format: the skippable frame's and the footer's magic number.
SEEK_FRAME = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1

_INDEX = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("bundle", T.StringType()),
    T.StructField("frame", T.IntegerType()), T.StructField("frame_start", T.LongType()),
    T.StructField("frame_length", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()),
])


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


def _header_value(text: str) -> str:
    """A header's value on one line: control characters percent-encoded."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in text)


def record(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record: a response with the payload, or a revisit of ``refers_to`` without."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    body = http + payload
    if refers_to is not None:
        body = http
        head += [
            f"WARC-Refers-To: <{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0):
    """(headers, HTTP headers, payload, next position) of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    begin, length = end + 4, int(headers["Content-Length"])
    cut = data.index(b"\r\n\r\n", begin) + 4
    http = dict(line.split(": ", 1) for line in data[begin:cut - 4].decode("utf-8").split("\r\n")[1:])
    return headers, http, data[cut:begin + length], begin + length + 4


class BundleWriter:
    """Writes records to one bundle after another under ``folder``."""

    def __init__(self, folder: str, prefix: str):
        self.fs, self.root = _open(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.folder, self.prefix, self.count, self.out = folder, prefix, 0, None
        self.index: list[tuple] = []

    def add(self, record_id: str, data: bytes):
        if self.out is None:
            name = f"{self.prefix}-{self.count:05d}.warc.zst"
            self.count += 1
            self.bundle, self.out = f"{self.folder}/{name}", self.fs.open_output_stream(
                f"{self.root}/{name}", compression=None
            )
            self.frames, self.written, self.waiting, self.frame = [], 0, [], bytearray()
        self.waiting.append((record_id, len(self.frame), len(data)))
        self.frame += data
        if len(self.frame) >= FRAME_BYTES:
            self._flush()
            if self.written >= BUNDLE_BYTES:
                self.close()

    def _flush(self):
        if self.frame:
            packed = zstandard.ZstdCompressor(level=3).compress(bytes(self.frame))
            for record_id, offset, length in self.waiting:
                self.index.append(
                    (record_id, self.bundle, len(self.frames), self.written, len(packed), offset, length)
                )
            self.out.write(packed)
            self.frames.append((len(packed), len(self.frame)))
            self.written += len(packed)
            self.waiting, self.frame = [], bytearray()

    def close(self):
        if self.out is not None:
            self._flush()
            table = b"".join(struct.pack("<II", *f) for f in self.frames)
            table += struct.pack("<IBI", len(self.frames), 0, SEEK_FOOTER)
            self.out.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)
            self.out.close()
            self.out = None

    def taken(self) -> list[tuple]:
        """The index rows of finished frames since the last call."""
        rows, self.index = self.index, []
        return rows


def seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed, uncompressed) of every frame, from the end of an open bundle."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEK_FOOTER:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    entries = struct.iter_unpack("<II", file.read(8 * count))
    out, start = [], 0
    for packed, plain in entries:
        out.append((start, packed, plain))
        start += packed
    return out


def read_frame(file, start: int, packed: int) -> bytes:
    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(packed))


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, schema)], schema.names
    )


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one WARC record per row and return the index.

    Of rows with equal payloads of ``least_bytes`` or more, that with the largest id
    is a response, the others revisit it (rows that share the largest id are all
    responses; a null id is smaller than any other, and among null ids alone all are
    responses).  Smaller payloads, null and empty pages are all responses.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"),
                        payload.alias("_html"))
    long = F.octet_length("_html") >= least_bytes
    keyed = rows.where(long).withColumn("_key", F.sha2(F.col("_html").cast("binary"), 256))
    last = keyed.groupBy("_key").agg(F.max("_id").alias("_last"))
    chosen = keyed.join(last, "_key").select("_id", "_url", "_html", F.nullif("_last", "_id").alias("_refers"))
    chosen = chosen.union(rows.where(~long).select("_id", "_url", "_html", F.lit(None).cast("long").alias("_refers")))
    name = lambda i: "urn:page:" + ("null" if i is None else str(i))

    def run(batches):
        writer = BundleWriter(folder, uuid.uuid4().hex)
        for batch in batches:
            for i, url, html, refers in zip(*(batch.column(k) for k in range(4))):
                page, refers = name(i.as_py()), refers.as_py()
                data = record(page, url.as_py(), html.as_py().encode("utf-8"),
                              None if refers is None else name(refers), date)
                writer.add(page, data)
            yield _batch(writer.taken(), _INDEX)
        writer.close()
        yield _batch(writer.taken(), _INDEX)

    return materialize(chosen.mapInArrow(run, _INDEX), "warc-index")


_RECORDS = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])


def _row(data: bytes, at: int, with_payload: bool):
    headers, http, payload, after = parse(data, at)
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(http["Content-Length"])
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    strip = lambda x: x[1:-1] if x else None
    return (strip(headers["WARC-Record-ID"]), kind, strip(headers.get("WARC-Refers-To")),
            headers.get("WARC-Target-URI"), length, digest, payload if with_payload else None), after


def read_bundles(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the bundles that ``index`` names, frame by frame by the seek tables.

    A response's digest and length are those of the payload read, and must equal its
    headers'; a revisit's are those of the payload it refers to, by its headers.
    """

    def run(batches):
        for batch in batches:
            for path in batch.column(0):
                fs, name = _open(path.as_py())
                with fs.open_input_file(name) as file:
                    for start, packed, _ in seek_table(file, file.size()):
                        data, at, rows = read_frame(file, start, packed), 0, []
                        while at < len(data):
                            row, at = _row(data, at, with_payload)
                            rows.append(row)
                        yield _batch(rows, _RECORDS)

    bundles = index.select("bundle").distinct()
    # a few bundles a task: their names alone are too small for Spark to spread
    return bundles.repartition(bundles.count() // 4 + 1).mapInArrow(run, _RECORDS)


def read_records(index: DataFrame) -> DataFrame:
    """The records of the index rows given (a selection of the index), payloads
    included: only the frames that hold them are fetched."""

    def run(batches):
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                fs, name = _open(x["bundle"])
                with fs.open_input_file(name) as file:
                    data = read_frame(file, x["frame_start"], x["frame_length"])
                rows.append(_row(data, x["offset"], True)[0])
            yield _batch(rows, _RECORDS)

    return index.mapInArrow(run, _RECORDS)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least_bytes: int = 1000, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to bundles, read them back, and return per row: the id,
    ``payload_bytes``, ``payload_digest`` (SHA-1), ``record_type`` and ``refers_to``.

    Null pages are empty payloads; see :func:`write_bundles` for null and repeated
    ids; rows are never dropped; other columns are ignored.  An empty table gives an
    empty table.
    """
    index = write_bundles(pages, folder or work_path(pages.sparkSession, "warc"), id_col, url_col, html_col, least_bytes)
    number = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    return read_bundles(index).select(
        number("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )
