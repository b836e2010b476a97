"""WARC archives as seekable Zstandard bundles.

A bundle is one file. Records are grouped into independent Zstandard frames, a skippable frame
with the seek table ends the file: compressed and decompressed size of every frame, then the
number of frames. A reader that knows a record's frame and its offset in it needs the seek table,
one frame and nothing else; any Zstandard tool still reads the whole file, since it skips the
table.

Bundles are written by tasks, under names of which only those of finished tasks get into the
index; a task that was lost leaves a file nobody reads, and its retry writes another.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fettle.llm import words
from fettle.shared import new_folder, write_table

# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
NO_DATE = "1970-01-01T00:00:00Z"

INDEX = ("page_id bigint, record_id string, file string, frame int, frame_begin bigint, "
         "frame_bytes bigint, record_begin bigint, record_bytes bigint")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0,
                   id_column: str = "page_id", url_column: str = "url",
                   payload_column: str = "html") -> DataFrame:
    """Write one record per row; the index (page_id, record_id, file, frame, ...) of the records.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the largest id hold
    the payload in a response record; the others are revisits that refer to that id. Shorter
    payloads are all responses. A null payload is empty. A null id counts as smaller than any
    other: such a row refers to a page with an id if there is one, and is a response else. Rows
    that repeat the largest id of their payload are all responses.

    ``folder`` is a path as Spark takes it, in a file system that pyarrow can write too (local,
    HDFS, S3); the shared folder of the session by default. The index is a table in the shared
    folder. Every record has an identifier of its own, also where rows repeat.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    folder = _reachable(spark, folder)
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"),
        F.col(url_column).cast("string").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("same"),
    )
    largest = (
        rows.where(F.octet_length("payload") >= min_bytes).groupBy("same")
        .agg(F.max(F.struct("page_id", "url")).alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("same", F.col("last.page_id").alias("largest"),
                               F.col("last.url").alias("largest_url"))
    )
    decided = rows.join(largest, "same", "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("refers_to"),
        "largest_url",
    )
    return write_table(decided.mapInArrow(_writer(folder), INDEX))[0]


def read_archives(index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every archived record.

    Only the names of the files come from the index. Frames are found by the seek table of each
    file and read one at a time; payloads and headers are taken from the records, and a response
    whose payload does not have the stated digest is an error.
    """
    files = index.select("file").distinct()
    return files.repartition("file").mapInArrow(
        _reader, "page_id bigint, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint")


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, record): the records named by rows of the index, each by one ranged read."""
    return index.mapInArrow(_fetcher, "page_id bigint, record binary")


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _reachable(spark: SparkSession, folder: str) -> str:
    """The folder as Hadoop resolves it, under the scheme pyarrow knows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    scheme, rest = files.resolvePath(path).toString().split(":", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return f"{scheme}://{rest.removeprefix('//')}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           place: str = "", refers_url: str | None = None) -> tuple[str, bytes]:
    """Record id and the bytes of a WARC record. ``place`` tells equal records apart."""
    line = lambda text: " ".join((text or "").split())
    stated = digest(payload)
    named = f"{place} page:{page_id} {stated} {line(url)}"
    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, named)}>"
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name,
        "WARC-Date": NO_DATE,
        "WARC-Target-URI": line(url),
        "WARC-Payload-Digest": f"sha1:{stated}",
        "X-Payload-Length": str(len(payload)),
        "X-Page-ID": "" if page_id is None else str(page_id),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To-Target-URI": line(refers_url),
                   "WARC-Refers-To-Date": NO_DATE, "X-Refers-To-Page": str(refers_to)}
    block = payload if refers_to is None else b""
    fields |= {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(block))}
    head = "".join(f"{key}: {value}\r\n" for key, value in fields.items())
    return name, b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record in ``data``."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:head_end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                      for line in lines)
        begin = head_end + 4
        end = begin + int(fields["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield fields, data[begin:end]
        at = end + 4


class Bundle:
    """A bundle being written: frames, then the seek table."""

    def __init__(self, folder: str) -> None:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        self.file = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        path = f"{root}/{self.file.rsplit('/', 1)[1]}"
        self.stream = files.open_output_stream(path, compression=None)
        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.sizes: list[tuple[int, int]] = []
        self.written = 0
        self.pending: list[bytes] = []
        self.rows: list[list] = []  # of the frame being filled
        self.fill = 0

    def add(self, page_id: int | None, name: str, data: bytes) -> list[list]:
        """Take a record; rows of the index once their frame is full."""
        self.rows.append([page_id, name, self.file, len(self.sizes), self.written, 0,
                          self.fill, len(data)])
        self.pending.append(data)
        self.fill += len(data)
        return self.flush() if self.fill >= FRAME_BYTES else []

    def flush(self) -> list[list]:
        if not self.pending:
            return []
        frame = self.compress(b"".join(self.pending))
        self.stream.write(frame)
        self.sizes.append((len(frame), self.fill))
        rows, self.rows = self.rows, []
        for row in rows:
            row[5] = len(frame)
        self.pending, self.fill, self.written = [], 0, self.written + len(frame)
        return rows

    def close(self) -> list[list]:
        rows = self.flush()
        table = b"".join(struct.pack("<II", *pair) for pair in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.stream.close()
        return rows


def _writer(folder: str):
    columns = [part.split() for part in INDEX.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in columns])

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)],
            schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, count = None, 0
        for batch in words.slices(batches, "payload"):
            done = []
            for row in range(batch.num_rows):
                page_id, url, payload, refers_to, refers_url = (
                    batch.column(c)[row].as_py()
                    for c in ("page_id", "url", "payload", "refers_to", "largest_url"))
                bundle = bundle or Bundle(folder)
                count += 1
                done += bundle.add(page_id, *record(
                    page_id, url, payload, refers_to, f"{bundle.file}#{count}", refers_url))
                if bundle.written >= BUNDLE_BYTES:
                    done += bundle.close()
                    bundle = None
            if done:
                yield batch_of(done)
        if bundle:
            rows = bundle.close()
            if rows:
                yield batch_of(rows)

    return run


def _open(file: str):
    files, path = pyarrow.fs.FileSystem.from_uri(file)
    return files.open_input_file(path)


def seek_table(stream) -> list[tuple[int, int]]:
    """Compressed and decompressed size of every frame, from the end of the file."""
    size = stream.size()
    stream.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE or flags:
        raise ValueError("the file has no seek table this reader knows")
    stream.seek(size - 9 - 8 * count)
    numbers = struct.unpack(f"<{2 * count}I", stream.read(8 * count))
    return list(zip(numbers[::2], numbers[1::2]))


def frame(stream, begin: int, size: int, full: int) -> bytes:
    """One decompressed frame."""
    stream.seek(begin)
    return zstandard.ZstdDecompressor().decompress(stream.read(size), max_output_size=full)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.column("file").to_pylist():
            with _open(file) as stream:
                begin = 0
                for size, full in seek_table(stream):
                    found = [_described(*parts) for parts in records(
                        frame(stream, begin, size, full))]
                    begin += size
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, kind) for column, kind in zip(
                            zip(*found),
                            (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def _described(fields: dict[str, str], block: bytes) -> tuple:
    number = lambda text: int(text) if text else None
    stated, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    length = int(fields["X-Payload-Length"])
    if kind == "response" and (digest(block) != stated or len(block) != length):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    return (number(fields["X-Page-ID"]), length, stated, kind,
            number(fields.get("X-Refers-To-Page")))


def _fetcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            with _open(row["file"]) as stream:
                full = seek_table(stream)[row["frame"]][1]
                data = frame(stream, row["frame_begin"], row["frame_bytes"], full)
            found.append(data[row["record_begin"]:row["record_begin"] + row["record_bytes"]])
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), pa.array(found, pa.binary())], ["page_id", "record"])
