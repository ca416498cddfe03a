"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about a mebibyte, and
a bundle ends with a seek table in a skippable frame (the public seekable
format), so any frame is read by one ranged read.  ``write`` returns an index
that maps each record's identifier to its bundle, its frame and its place in
the unpacked frame.  Records whose payload of at least ``min_payload`` bytes
equals that of a record with a smaller page_id are written as ``revisit``
records without the payload.

Bundles go to a folder given as a URI that the executors reach (``file:``,
``hdfs:``, ``s3:`` ...).  A task writes under a name of its own attempt; the
index, written by Spark's commit protocol, names only the bundles of
attempts that succeeded, so a lost executor leaves at most an unread file.

Defined results: a null html is an empty payload.  Rows that repeat the
smallest page_id of their payload are all responses.  A row without page_id
never is referred to; it revisits the smallest page_id of its payload, and is
a response if there is none.  Extra columns are ignored.  An empty table gives
an empty index.
"""

from __future__ import annotations

import hashlib
import io
import itertools
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.llm.common import group_min_by_salt, table
from gridwise.session import work_dir

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28
LEVEL = 3
SALTS = 64

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX_SCHEMA = ("record_id string, page_id long, record_type string, bundle string, "
                "frame long, frame_at long, frame_bytes long, record_at long, record_bytes long")
RECORD_SCHEMA = ("record_id string, page_id long, url string, record_type string, "
                 "refers_to long, payload_bytes long, payload_digest string")


def deduplicated(pages: DataFrame, min_payload: int = 100) -> DataFrame:
    """pages (page_id, url, html) -> the same with payload_bytes, digest and
    refers_to (null for responses).

    Payloads are compared by their SHA-256.  The smallest page_id of a payload
    is joined back on the digest and a salt, so a payload that a third of all
    pages share is dealt over ``SALTS`` tasks; the pages' text moves once.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"),
                         F.octet_length(payload).cast("long").alias("payload_bytes"),
                         F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("salt"))
    first = group_min_by_salt(
        keyed.where(F.col("payload_bytes") >= min_payload).select("digest", "salt", "page_id"),
        ["digest"], "salt", "page_id", "first_id").drop("first_id_rows")
    refers = F.when((F.col("first_id") < F.col("page_id")) | F.col("page_id").isNull(),
                    F.col("first_id"))
    # the salted side has one row per payload and salt, without text
    return (keyed.join(first.hint("shuffle_hash"), ["digest", "salt"], "left")
            .select("page_id", "url", "html", "payload_bytes", "digest",
                    refers.alias("refers_to")))


def record_bytes(record_id: str, page_id: int | None, url: str | None, payload: bytes,
                 digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; its block is an HTTP response header and, in a
    response, the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{record_id}>"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        # a header field holds no line breaks; the escape is undone when read
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D")
                    .replace("\n", "%0A"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record; the payload's size and digest are taken from the
    payload itself where there is one."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    refers = fields.get("WARC-Refers-To")
    if refers is None:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    else:
        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return {"record_id": fields["WARC-Record-ID"][1:-1],
            "page_id": int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None, "url": url,
            "record_type": fields["WARC-Type"],
            "refers_to": None if refers is None else int(refers[1:-1].rpartition(":")[2]),
            "payload_bytes": size, "payload_digest": digest, "payload": payload}


class BundleWriter:
    """Writes records into frames of one bundle and its seek table at the end."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.out, self.frame_bytes = out, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.buffer, self.frames, self.at = bytearray(), [], 0
        self.open_rows: list[dict] = []

    def add(self, row: dict, data: bytes) -> list[dict]:
        """The index rows of the frame that this record closed, if it did."""
        self.open_rows.append(row | {"frame": len(self.frames), "record_at": len(self.buffer),
                                     "record_bytes": len(data)})
        self.buffer += data
        return self.flush() if len(self.buffer) >= self.frame_bytes else []

    def flush(self) -> list[dict]:
        if not self.open_rows:
            return []
        packed = self.packer.compress(bytes(self.buffer))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.buffer)))
        rows = [r | {"frame_at": self.at, "frame_bytes": len(packed)} for r in self.open_rows]
        self.at += len(packed)
        self.buffer, self.open_rows = bytearray(), []
        return rows

    def finish(self) -> list[dict]:
        rows = self.flush()
        self.out.write(seek_table(self.frames))
        return rows


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """A skippable frame with packed and unpacked size of each frame, and the footer."""
    body = b"".join(struct.pack("<II", *f) for f in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body) + len(footer)) + body + footer


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """(offset, packed size, unpacked size) of each frame of an open bundle."""
    end = source.seek(0, io.SEEK_END)
    source.seek(end - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    width = 12 if flags & 0x80 else 8
    source.seek(end - 9 - count * width)
    body, frames, at = source.read(count * width), [], 0
    for i in range(count):
        packed, unpacked = struct.unpack_from("<II", body, i * width)
        frames.append((at, packed, unpacked))
        at += packed
    return frames


def open_folder(uri: str):
    """(file system, path) of a folder's URI, as pyarrow knows it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def write(pages: DataFrame, folder: str, min_payload: int = 100,
          bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) into bundles below
    ``folder``; returns the index, which is kept as a Parquet table."""

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()),
                            ("record_type", pa.string()), ("bundle", pa.string()),
                            ("frame", pa.int64()), ("frame_at", pa.int64()),
                            ("frame_bytes", pa.int64()), ("record_at", pa.int64()),
                            ("record_bytes", pa.int64())])
        out = writer = name = None

        def rows_of(rows):
            return pa.RecordBatch.from_pylist([r | {"bundle": name} for r in rows], schema)

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "payload_bytes",
                                                 "digest", "refers_to")]
            for k in range(batch.num_rows):
                if writer is None:
                    task = TaskContext.get()
                    name = (f"bundle-{task.partitionId():06d}-{task.taskAttemptId()}-"
                            f"{uuid.uuid4().hex[:8]}.warc.zst")
                    # bytes as given: the name alone would make pyarrow compress them again
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    writer = BundleWriter(out)
                page_id, url, html, size, digest, refers = (c[k].as_py() for c in columns)
                rid = f"urn:uuid:{uuid.uuid4()}"
                kind = "response" if refers is None else "revisit"
                payload = b"" if refers is not None else (html or "").encode("utf-8", "surrogatepass")
                closed = writer.add({"record_id": rid, "page_id": page_id, "record_type": kind},
                                    record_bytes(rid, page_id, url, payload, digest, size, refers))
                if closed:
                    yield rows_of(closed)
                if writer.at >= bundle_bytes:
                    yield rows_of(writer.finish())
                    out.close()
                    writer = None
        if writer is not None:
            yield rows_of(writer.finish())
            out.close()

    spark = pages.sparkSession
    store, base = open_folder(folder)
    store.create_dir(base, recursive=True)
    index = deduplicated(pages, min_payload).mapInArrow(bundles, INDEX_SCHEMA)
    path = work_dir(spark, "llm-warc-index")
    index.write.parquet(path)
    return spark.read.schema(index.schema).parquet(path)


def _read_frames(folder: str, whole: bool):
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
                       + ([] if whole else [("payload", pa.binary())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        unpack = zstandard.ZstdDecompressor()
        wanted = itertools.chain.from_iterable(b.to_pylist() for b in batches)
        for name, frames in itertools.groupby(wanted, key=lambda r: r["bundle"]):
            with store.open_input_file(f"{base}/{name}") as source:
                offsets = read_seek_table(source)
                for frame in frames:
                    at, packed, unpacked = offsets[frame["frame"]]
                    source.seek(at)
                    data = unpack.decompress(source.read(packed), max_output_size=unpacked)
                    yield pa.RecordBatch.from_pylist(
                        [{k: v for k, v in parse_record(data[a:a + n]).items()
                          if k in schema.names}
                         for a, n in zip(frame["places"], frame["sizes"])], schema)

    return read


def _frames(index: DataFrame) -> DataFrame:
    """One row per frame with the places of its records, dealt out by frame.
    A frame holds about ``FRAME_BYTES`` of records, so a row stays small."""
    pairs = F.sort_array(F.collect_list(F.struct("record_at", "record_bytes")))
    return (index.groupBy("bundle", "frame").agg(pairs.alias("p"))
            .select("bundle", "frame", F.col("p.record_at").alias("places"),
                    F.col("p.record_bytes").alias("sizes"))
            .sortWithinPartitions("bundle", "frame"))


def read(index: DataFrame, folder: str) -> DataFrame:
    """All records of the index, read from their bundles frame by frame; the
    payload's size and digest are computed from what was read."""
    return _frames(index).mapInArrow(_read_frames(folder, True), RECORD_SCHEMA)


def lookup(index: DataFrame, folder: str, record_ids: DataFrame) -> DataFrame:
    """The records (with payload) of the given record_id rows: only their
    frames are read."""
    return _frames(index.join(record_ids, "record_id", "left_semi")).mapInArrow(
        _read_frames(folder, False), RECORD_SCHEMA + ", payload binary")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = work_dir(spark, "llm-warc")
    index = write(pages, folder)
    return read(index, folder).select("page_id", "payload_bytes", "payload_digest",
                                      "record_type", "refers_to")


OP1_SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
         CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
