"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent frames; a bundle ends with a skippable frame that lists the frames' sizes (the
seekable format), and an index table maps each record's identifier to its bundle, frame and offset in the frame. A
record is read by one seek and one frame. Bundles are files in a folder that all executors share, written by the
tasks: under a name of their own for each attempt, so that what a lost attempt leaves is in no index.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root
from .common import packed, text_bytes, write_through

#: Bytes of records in a frame, and of compressed frames in a bundle, before the next is begun.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 64 << 20
LEVEL = 3

# fixed values of the formats
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def file_system(uri: str):
    """The store of a path, and the path in it: local and shared folders, and what pyarrow opens besides."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- records --------------------------------------------------------------------------------------------------------


def record_name(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{row}')}>"


def _plain(value: str) -> str:
    """A header's value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def write_record(page_id, row, url, payload: bytes, holder: tuple | None) -> tuple[str, bytes]:
    """(identifier, record): a response, or a revisit of ``holder`` (page_id, row), which leaves the payload out."""
    name = record_name(page_id, row)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if holder else head + payload
    fields = [
        ("WARC-Type", "revisit" if holder else "response"),
        ("WARC-Record-ID", name),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else _plain(url)),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("WARC-Profile", PROFILE if holder else None),
        ("WARC-Refers-To", record_name(*holder) if holder else None),
        ("WARC-Page-ID", None if page_id is None else str(page_id)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return name, b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def read_record(data: memoryview | bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, end) of the record at a place."""
    data = memoryview(data)
    end = bytes(data[at : at + (64 << 10)]).find(b"\r\n\r\n")
    if end < 0:  # very long headers
        end = bytes(data[at:]).find(b"\r\n\r\n")
    lines = bytes(data[at : at + end]).decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    begin, size = at + end + 4, int(fields["Content-Length"])
    block = bytes(data[begin : begin + size])
    return fields, block[block.index(b"\r\n\r\n") + 4 :], begin + size + 4


# ---- bundles --------------------------------------------------------------------------------------------------------


class BundleWriter:
    """One bundle: frames, then the seek table. Holds no more than one frame."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.pack = stream, zstandard.ZstdCompressor(level=LEVEL).compress
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.written = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """(frame, place of the frame in the bundle, offset in the frame)."""
        if self.size and self.size + len(record) > FRAME_BYTES:
            self.flush()
        found = len(self.frames), self.written, self.size
        self.held.append(record)
        self.size += len(record)
        return found

    def flush(self) -> None:
        if self.held:
            packed = self.pack(b"".join(self.held))  # the frame says its size
            self.stream.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.stream.close()


class BundleReader:
    """Frames of a bundle by number, through its seek table."""

    def __init__(self, stream, size: int):
        import zstandard

        self.stream, self.unpack = stream, zstandard.ZstdDecompressor().decompress
        stream.seek(size - 9)
        frames, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        entry = 12 if flags & 128 else 8
        stream.seek(size - 9 - entry * frames)
        table = stream.read(entry * frames)
        self.sizes = [struct.unpack_from("<II", table, i * entry) for i in range(frames)]
        self.places, at = [], 0
        for packed, _ in self.sizes:
            self.places.append(at)
            at += packed

    def frame(self, number: int) -> bytes:
        self.stream.seek(self.places[number])
        packed, size = self.sizes[number]
        data = self.unpack(self.stream.read(packed))
        if len(data) != size:
            raise ValueError("a frame differs from the seek table")
        return data


INDEX = "page_id long, record_id string, bundle string, frame int, frame_at long, offset int, size long"


def _write(folder: str):
    """Rows page_id, row, url, payload, holder_id, holder_row -> an index row for each record written."""
    names = ["page_id", "record_id", "bundle", "frame", "frame_at", "offset", "size"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        store, path = file_system(folder)
        task = TaskContext.get()
        writer, name, rows = None, None, []

        def done():
            writer.close()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for at in range(batch.num_rows):
                page_id, row, url, payload, holder_id, holder_row = (batch.column(i)[at].as_py() for i in range(6))
                holder = None if holder_row == row else (holder_id, holder_row)
                record_id, record = write_record(page_id, row, url, unpack(payload), holder)
                if writer is None:
                    name = f"{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(store.open_output_stream(f"{path}/{name}", compression=None))
                rows.append((page_id, record_id, name, *writer.add(record), len(record)))
                if writer.written >= BUNDLE_BYTES:
                    yield done()
                    writer, rows = None, []
        if writer is not None:
            yield done()

    return run


def with_holders(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, row, url, payload (packed), holder_id, holder_row: of equal payloads the smallest page_id holds it.

    Payloads shorter than ``least`` bytes hold themselves. Null page_ids come last; of rows that repeat a page_id and
    payload one holds it. Rows are numbered and written first, so that a number means one row for good.
    """
    payload = text_bytes("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.length(payload).alias("size"),
        F.sha2(payload, 256).alias("key"),
    )
    rows = write_through(packed(rows, "payload"), "pages")
    smallest = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    holders = write_through(rows.groupBy("key").agg(smallest.alias("holder")), "holders")
    own = F.col("size") < least
    return rows.join(holders, "key").select(
        "page_id",
        "row",
        "url",
        "payload",
        F.when(own, F.col("page_id")).otherwise(F.col("holder.page_id")).alias("holder_id"),
        F.when(own, F.col("row")).otherwise(F.col("holder.row")).alias("holder_row"),
    )


def write_archive(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) as a record below ``folder``; returns the index table.

    The payload is the html in UTF-8, a null none. ``folder`` must be one that all executors reach. Null and repeated
    page_ids and repeated rows have records of their own; an empty table writes nothing. Other columns are ignored.
    """
    store, path = file_system(folder)
    store.create_dir(path)
    return write_through(with_holders(pages, least).mapInArrow(_write(folder), INDEX), "index")


RECORDS = "page_id long, record_id string, url string, record_type string, refers_to string, payload binary, payload_digest string"


def _row(fields: dict[str, str], payload: bytes) -> tuple:
    page_id = fields.get("WARC-Page-ID")
    return (
        None if page_id is None else int(page_id), fields["WARC-Record-ID"], fields.get("WARC-Target-URI"), fields["WARC-Type"],
        fields.get("WARC-Refers-To"), payload, fields["WARC-Payload-Digest"].removeprefix("sha1:"),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["page_id", "record_id", "url", "record_type", "refers_to", "payload", "payload_digest"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles in the index: page_id, record_id, url, record_type, refers_to, payload, payload_digest.

    refers_to is a record's identifier; a revisit has no payload. Bundles are read frame by frame.
    """

    def run(batches):
        store, path = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{path}/{name}") as stream:
                    reader = BundleReader(stream, stream.size())
                    for number in range(len(reader.sizes)):
                        data, at, rows = memoryview(reader.frame(number)), 0, []
                        while at < len(data):
                            fields, payload, at = read_record(data, at)
                            rows.append(_row(fields, payload))
                        yield _batch(rows)

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bundles = index.select("bundle").distinct().repartition(tasks, F.xxhash64("bundle"))  # few rows, but each a file to read
    return bundles.mapInArrow(run, RECORDS)


def fetch_records(index: DataFrame, wanted: DataFrame, folder: str) -> DataFrame:
    """The records of the page_ids in ``wanted``, each by a seek to its frame; columns as in ``read_archive``."""

    def run(batches):
        import zstandard

        store, path = file_system(folder)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, last, data = [], None, b""
            for row in batch.to_pylist():
                if last != (row["bundle"], row["frame_at"]):
                    last = (row["bundle"], row["frame_at"])
                    with store.open_input_file(f"{path}/{row['bundle']}") as stream:
                        stream.seek(row["frame_at"])
                        data = unpack.stream_reader(stream, read_across_frames=False).read()
                rows.append(_row(*read_record(data, row["offset"])[:2]))
                if len(rows) >= 256:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    chosen = index.join(wanted.select(F.col("page_id").cast("long").alias("page_id")).distinct(), "page_id", "left_semi")
    return chosen.sortWithinPartitions("bundle", "frame_at", "offset").mapInArrow(run, RECORDS)


def archive_report(spark: SparkSession, pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: what the archives say after a write and a read.

    Sizes and digests of revisits are those of the response that they refer to, read from its record.
    """
    folder = folder or f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
    index = write_archive(pages, folder, least)

    def measure(batches):
        for batch in batches:
            payloads = batch.column(4).to_pylist()
            sizes = pa.array([len(p) for p in payloads], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), sizes, pa.array([sha1_base32(p) for p in payloads])],
                ["page_id", "record_id", "record_type", "refers_to", "n", "digest"],
            )

    records = read_archive(index, folder).select("page_id", "record_id", "record_type", "refers_to", "payload")
    records = write_through(
        records.mapInArrow(measure, "page_id long, record_id string, record_type string, refers_to string, n long, digest string"),
        "records",
    )
    held = records.filter("record_type = 'response'")
    responses = held.select("page_id", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
                            F.lit(None).cast("long").alias("refers_to"))
    holders = held.select(F.col("record_id").alias("holder"), F.col("page_id").alias("holder_id"), F.col("n").alias("full"),
                          F.col("digest").alias("full_digest"))
    revisits = records.filter("record_type = 'revisit'")
    revisits = revisits.join(holders, revisits["refers_to"] == holders["holder"]).select(
        "page_id", F.col("full").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"), "record_type",
        F.col("holder_id").alias("refers_to"),
    )
    return responses.union(revisits)
