"""Media columns: payloads as images in archives, and a Spark data source that reads archive folders.

Writing: a payload of bytes is padded with zeros to a multiple of 64 and stored as an 8-bit greyscale PNG
of 64 samples a row, losslessly. Each task appends its members to one tar archive and writes a member
index beside it: fixed-size entries of id, offset, length and CRC-32 of the stored form.

Reading: `ArchiveSource` lists the archives of a folder and plans partitions as byte ranges of them, from
file sizes alone. A task looks its range up in the archive's index, streams members in Arrow batches,
and reads any member that fails again by its own offset, so that one bad read repeats no other.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from atrium.llm.common import materialize, open_fs, shared_dir

SAMPLES = 64
#: A private chunk with the payload's length before the padding.
LENGTH = b"paYl"
SIGNATURE = b"\x89PNG\r\n\x1a\n"
ENTRY = np.dtype([("id", "<i8"), ("null_id", "<i8"), ("offset", "<i8"), ("length", "<i8"), ("crc", "<i8")])
#: Bytes of archives that one partition reads, and of members that one Arrow batch holds.
RANGE_BYTES, BATCH_BYTES = 32 << 20, 4 << 20
#: Reads of one member before it is given up and reported.
ATTEMPTS = 3


def padded(payload: bytes) -> bytes:
    """The payload with zeros up to a positive multiple of 64 bytes."""
    return payload + bytes(max(1, -(-len(payload) // SAMPLES)) * SAMPLES - len(payload))


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_image(payload: bytes, level: int = 1) -> bytes:
    """An 8-bit greyscale PNG whose samples are the padded payload; the same bytes for the same payload."""
    whole = padded(payload)
    rows = np.zeros((len(whole) // SAMPLES, SAMPLES + 1), np.uint8)  # each row begins with filter 0
    rows[:, 1:] = np.frombuffer(whole, np.uint8).reshape(-1, SAMPLES)
    head = struct.pack(">IIBBBBB", SAMPLES, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(LENGTH, struct.pack(">Q", len(payload))) + chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + chunk(b"IEND", b"")


def decode_image(image: bytes) -> tuple[bytes, int]:
    """The samples of a PNG that encode_image made and the payload's length among them; ValueError for anything else or a wrong checksum."""
    if image[:8] != SIGNATURE:
        raise ValueError("no PNG")
    at, data, shape, length = 8, [], None, None
    while at < len(image):
        (n,), kind = struct.unpack_from(">I", image, at), image[at + 4 : at + 8]
        body = image[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", image, at + 8 + n)[0]:
            raise ValueError(f"wrong checksum in {kind!r}")
        if kind == b"IHDR":
            shape = struct.unpack(">IIBBBBB", body)
        elif kind == LENGTH:
            (length,) = struct.unpack(">Q", body)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    if shape is None or shape[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not 8-bit greyscale without filters and interlacing")
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(shape[1], shape[0] + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows")
    return rows[:, 1:].tobytes(), rows.shape[0] * SAMPLES if length is None else length


def features(samples: bytes) -> str:
    """Width, height, mean, and a 16-bin histogram in thousandths, of 8-bit samples."""
    x = np.frombuffer(samples, np.uint8)
    bins = np.bincount(x >> 4, minlength=16) * 1000 // len(x)
    return f"{SAMPLES}x{len(x) // SAMPLES};mean={int(x.sum(dtype=np.int64)) * 1000 // len(x)};hist={','.join(map(str, bins))}"


def write_archives(documents: DataFrame, folder: str | None = None) -> str:
    """Store every text of (doc_id, text) as an image in tar archives; returns the folder's URI.

    Null texts are empty; null ids and repeated rows are members of their own. Archives appear under
    their final names when they are complete, so a task that is run again leaves no half archive.
    """
    folder = folder or shared_dir(documents.sparkSession, "media")
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        system, path = open_fs(folder)
        out, offset, entries = None, 0, []
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = system.open_output_stream(f"{path}/.{part:06d}.tar.{attempt}")
                image = encode_image((text or "").encode("utf-8", "surrogatepass"))
                info = tarfile.TarInfo(f"{len(entries):09d}-{doc_id}.png")
                info.size = len(image)
                head = info.tobuf(tarfile.USTAR_FORMAT)
                out.write(head + image + bytes(-len(image) % 512))
                entries.append((doc_id or 0, doc_id is None, offset + len(head), len(image), zlib.crc32(image)))
                offset += len(head) + len(image) + -len(image) % 512
        if out is None:
            return
        out.write(bytes(1024))
        out.close()
        with system.open_output_stream(f"{path}/.{part:06d}.idx.{attempt}") as index:
            index.write(np.array(entries, ENTRY).tobytes())
        for kind in ("idx", "tar"):  # the archive last: where it is, its index is too
            system.move(f"{path}/.{part:06d}.{kind}.{attempt}", f"{path}/{part:06d}.{kind}")
        yield pa.RecordBatch.from_pydict({"members": pa.array([len(entries)], pa.int64()), "bytes": pa.array([offset], pa.int64())})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    materialize(rows.mapInArrow(write, "members long, bytes long"), "media-written")
    return folder


class ByteRange(InputPartition):
    """Members of one archive whose offset is in [low, high)."""

    def __init__(self, archive: str, low: int, high: int):
        super().__init__(None)
        self.archive, self.low, self.high = archive, low, high


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def partitions(self) -> list[ByteRange]:
        system, path = open_fs(self.folder)
        out = []
        for info in sorted(system.get_file_info(fs.FileSelector(path)), key=lambda i: i.path):
            if info.base_name.endswith(".tar") and not info.base_name.startswith("."):
                cuts = [*range(0, info.size, self.range_bytes), info.size]
                out += [ByteRange(info.path, a, b) for a, b in zip(cuts, cuts[1:])]
        return out or [ByteRange("", 0, 0)]

    def members(self, system: fs.FileSystem, part: ByteRange) -> np.ndarray:
        """The index entries of the range: two binary searches, then one read."""
        with system.open_input_file(part.archive.removesuffix(".tar") + ".idx") as index:
            count = index.size() // ENTRY.itemsize

            def first(offset: int) -> int:
                low, high = 0, count
                while low < high:
                    mid = (low + high) // 2
                    at = np.frombuffer(index.read_at(ENTRY.itemsize, mid * ENTRY.itemsize), ENTRY)["offset"][0]
                    low, high = (mid + 1, high) if at < offset else (low, mid)
                return low

            i, j = first(part.low), first(part.high)
            return np.frombuffer(index.read_at((j - i) * ENTRY.itemsize, i * ENTRY.itemsize), ENTRY)

    def fetch(self, system: fs.FileSystem, archive: str, entry, given: bytes | None) -> tuple[bytes | None, str | None]:
        """A member's bytes, or why they can't be had: what a batch read gave, else reads at its own offset."""
        error = "short read"
        for attempt in range(self.attempts + 1):
            try:
                if attempt or given is None:
                    with system.open_input_file(archive) as f:
                        given = f.read_at(int(entry["length"]), int(entry["offset"]))
                if len(given) == entry["length"] and zlib.crc32(given) == entry["crc"]:
                    return given, None
                error = "wrong length or checksum"
            except OSError as wrong:
                error = str(wrong)
        return None, f"offset {entry['offset']}: {error}"

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.archive:
            return
        system, _ = open_fs(self.folder)
        entries, at = self.members(system, part), 0
        with system.open_input_file(part.archive) as f:
            while at < len(entries):
                low = int(entries["offset"][at])
                end = max(at + 1, int(np.searchsorted(entries["offset"], low + BATCH_BYTES)))
                some, at = entries[at:end], end
                try:
                    data = f.read_at(int(some["offset"][-1] + some["length"][-1]) - low, low)
                except OSError:
                    data = None
                got = [self.fetch(system, part.archive, e, None if data is None else data[e["offset"] - low : e["offset"] - low + e["length"]]) for e in some]
                ids = pa.array([None if n else i for i, n in zip(some["id"].tolist(), some["null_id"].tolist())], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([part.archive.rsplit("/", 1)[-1]] * len(some)), pa.array(some["offset"]), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.string())],
                    names=["doc_id", "archive", "offset", "media", "error"],
                )


class ArchiveSource(DataSource):
    """Format "archives": a folder of tar archives with member indexes.

    Options: rangeBytes, bytes of an archive that a partition reads; attempts, further reads of a member
    that fails. A member that can't be read has null media and says why in error; the others are read.
    """

    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return "doc_id long, archive string, offset long, media binary, error string"

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archives").options(**options).load(folder)


DESCRIBED = "doc_id long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_bytes long, error string"


def describe(media: DataFrame) -> DataFrame:
    """Digests and features of the samples that stored images hold; n_bytes is without the padding.

    What could not be read has nulls and its error.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, image, error in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "media", "error"))):
                if image is None:
                    out.append((doc_id, *[None] * 7, error))
                    continue
                samples, n_bytes = decode_image(image)
                out.append((doc_id, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-SAMPLES:]), len(image), hashlib.sha256(image).hexdigest(), features(samples), n_bytes, None))
            columns = zip(*out) if out else [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, DESCRIBED_TYPES)], names=[x.split()[0] for x in DESCRIBED.split(", ")])

    return media.select("doc_id", "media", "error").mapInArrow(decode, DESCRIBED)


DESCRIBED_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
