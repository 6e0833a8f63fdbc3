"""WARC archives with a Zstandard dictionary of their own, and back.

Each archive starts with a skippable frame that holds the dictionary, trained on records of the same task; every record is
one frame compressed with it (the public .warc.zst layout). Digests are taken by Spark; rows with equal payloads are
found by one aggregate on the digest, so a payload that fills a third of the table is one row there. Archives go to a
folder that all executors share, under a temporary name until they are whole, so that a task can run again.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_dir, prepare, settle

#: A skippable frame of this number holds the dictionary (fixed value of the layout).
DICT_MAGIC = 0x184D2A5D
DICT_BYTES = 32 << 10
TRAIN_BYTES = 2 << 20
ARCHIVE_BYTES = 64 << 20
LEAST_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'page:{page_id}'.encode()).digest()[:16], version=5)}>"


def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit carries the HTTP head alone."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Target-URI: {url}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[3:3] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes], size: int = DICT_BYTES) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; where they are too few for that, their raw content."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:] or b"WARC/1.1\r\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Archives of one task: fs is a pyarrow filesystem, names are final once an archive is closed."""

    def __init__(self, fs, folder: str, part: int, attempt: str, samples: list[bytes]):
        self.fs, self.folder, self.part, self.attempt = fs, folder, part, attempt
        self.zdict = dictionary(samples)
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=self.zdict, write_content_size=True)
        self.done: list[tuple[str, int]] = []
        self.out = None

    def _open(self) -> None:
        self.name = f"{self.folder}/part-{self.part:05d}-{len(self.done):04d}.warc.zst"
        self.temp = f"{self.name}.{self.attempt}"
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        raw = self.zdict.as_bytes()
        self.out.write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
        self.n = self.size = 0

    def write(self, rec: bytes) -> None:
        if self.out is None:
            self._open()
        self.out.write(self.packer.compress(rec))
        self.n += 1
        self.size += len(rec)
        if self.size >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temp, self.name)
            self.done.append((self.name, self.n))
            self.out = None


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Heads and blocks of the records of one archive."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICT_MAGIC:
        raise ValueError("no dictionary frame at the start of the archive")
    raw = stream.read(size)
    kind = zstandard.DICT_TYPE_AUTO
    reader = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind)).stream_reader(stream, read_across_frames=True), 1 << 16)
    while line := reader.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        head = {}
        while (line := reader.readline()) != b"\r\n":
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            head[k] = v
        block = reader.read(int(head["Content-Length"]))
        if reader.read(4) != b"\r\n\r\n":
            raise ValueError("a record ends early")
        yield head, block


def _write(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        ctx = TaskContext.get()
        fs, folder = FileSystem.from_uri(uri)
        fs.create_dir(folder, recursive=True)
        held: list[bytes] = []
        size, out = 0, None

        def start() -> ArchiveWriter:
            some, n = [], 0
            for r in held:
                some.append(r[: 64 << 10])
                n += len(some[-1])
                if n > TRAIN_BYTES:
                    break
            w = ArchiveWriter(fs, folder, ctx.partitionId(), str(ctx.taskAttemptId()), some)
            for r in held:
                w.write(r)
            held.clear()
            return w

        for batch in batches:
            for row in batch.to_pylist():
                rec = record(row["page_id"], (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A"), (row["html"] or "").encode(), row["digest"], row["refers_to"])
                if out is not None:
                    out.write(rec)
                    continue
                held.append(rec)
                size += len(rec)
                if size >= TRAIN_BYTES:
                    out = start()
        if out is None and held:
            out = start()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out.done]), pa.array([k for _, k in out.done], pa.int64())], ["path", "records"])

    return run


def _read(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        fs, _ = FileSystem.from_uri(uri)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        num = lambda x: int(x) if x else None
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with fs.open_input_stream(path, compression=None) as f:
                    for head, block in read_archive(f):
                        stated = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        if head["WARC-Type"] == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            digest, n = hashlib.sha256(payload).hexdigest(), len(payload)
                            if (digest, n) != (stated, int(head["X-Payload-Length"])):
                                raise ValueError(f"{path}: a payload differs from its digest")
                        else:
                            digest, n = stated, int(head["X-Payload-Length"])
                        rows.append((num(head["X-Page-Id"]), n, digest, head["WARC-Type"], num(head.get("X-Refers-To-Page-Id")), head["WARC-Target-URI"]))
                        if len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def write_warc(pages: DataFrame, uri: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write a record per page (page_id, url, html) into archives below `uri`; gives (path, records) of each archive.

    Of pages whose payloads are equal and hold at least `least` bytes, those with the smallest page_id are response, the
    others revisit it. Null html is an empty payload; a null page_id is written as none and never referred to; rows
    that repeat the smallest page_id are each response; an empty table gives no archive; other columns are not kept.
    """
    spark = prepare(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html"), F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"))
    # payloads too short to be referred to have keys of their own, so that they do not meet in one task
    rows = rows.withColumn("same", F.when(F.octet_length(html) >= least, F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))))
    first = rows.groupBy("same").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & F.col("first_id").isNotNull() & ~F.col("same").startswith("-"))
    # written first: of two plain sides Spark splits the one where a payload is very common
    rows = rows.join(settle(first.select("same", "first_id"), "first"), "same", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")), F.col("first_id"))
    rows = rows.select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    return settle(rows.mapInArrow(_write(uri), "path string, records long"), "warc-manifest")


def read_warc(archives: DataFrame, uri: str) -> DataFrame:
    """The records of the archives (path): page_id, payload_bytes, payload_digest, record_type, refers_to, url. A payload that differs from its digest is an error."""
    spark = archives.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return archives.select("path").repartition(n, "path").mapInArrow(_read(uri), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def op3_warc(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    uri = fresh_dir(spark, "warc")
    archives = write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), uri)
    return read_warc(archives, uri).drop("url")


OP3_SQL = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS h, sha256(COALESCE(html, '')) AS d FROM pages),
m AS (SELECT d, min(page_id) AS f FROM p WHERE strlen(h) >= 100 GROUP BY d)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f IS NULL OR f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f <> page_id THEN f END AS refers_to
FROM p LEFT JOIN m ON p.d = m.d
"""
