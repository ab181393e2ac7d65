"""Token ids in binary files: one shared zstandard dictionary, one frame per document, an offset index.

A folder holds, per range of ascending doc_id:

* ``ids-NNNNN.bin``: 8 bytes magic, 32 bytes SHA-256 of the dictionary, then one zstandard frame per
  document over its ids as little-endian unsigned integers of `width` bytes, each frame by itself;
* ``ids-NNNNN.idx``: 8 bytes magic, 32 bytes SHA-256 of the dictionary, then for each document
  doc_id, start (ids before it in this file), number of ids, offset and length of its frame, as
  little-endian signed 64-bit integers; a null doc_id is the smallest such integer.

``dictionary.zstd`` holds the dictionary, ``manifest`` (Parquet) each file's first id number. A reader
takes any one document with one index entry and one short read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atrium.llm.common import materialize, open_fs, shared_dir, slices, word_ids

MAGIC_IDS, MAGIC_INDEX = b"ATRIDS1\0", b"ATRIDX1\0"
HEAD = 8 + 32
ENTRY = np.dtype([("doc_id", "<i8"), ("start", "<i8"), ("n", "<i8"), ("offset", "<i8"), ("length", "<i8")])
NULL_ID = -(1 << 63)
#: The dictionary is trained on the ids of so many documents, the first by a hash, and is so large.
SAMPLE_DOCS, DICTIONARY_BYTES = 2_000, 64 << 10
#: A sampled document's ids stand in training whole up to so many stretches of so many bytes, else as stretches spread evenly over all of them.
STRETCHES, STRETCH_BYTES = 8, 4 << 10
LEVEL = 3
#: Bytes of frames in a file, about.
FILE_BYTES = 16 << 20


def stretches(raw: bytes) -> list[bytes]:
    if len(raw) <= STRETCHES * STRETCH_BYTES:
        return [raw] if raw else []
    return [raw[at : at + STRETCH_BYTES] for at in np.linspace(0, len(raw) - STRETCH_BYTES, STRETCHES).astype(int) // 4 * 4]


def train_dictionary(documents: DataFrame, tokenizer_path: str, sample: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary over serialized id arrays of a bounded sample; empty for a table without ids.

    The sample is the first `sample` rows by a hash. A cut-off on the hash, from the count of rows, leaves
    four times as many for the sort, so that no more texts than these leave their tasks.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, samples = word_ids(tokenizer_path), []
        for batch in slices(batches, 100):
            for raw in encode(batch.column(0).to_pylist()):
                samples += stretches(raw)
        try:
            trained = zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
        except zstandard.ZstdError:  # too few samples: their content serves as it is
            trained = b"".join(samples)[-size:]
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([trained], pa.binary())})

    share = min(1.0, 4 * sample / max(1, documents.count()))
    rows = documents.select("text", F.xxhash64("doc_id", "text").alias("h")).where(F.pmod("h", F.lit(1 << 32)) < int(share * (1 << 32)))
    got = rows.orderBy("h", "text").limit(sample).select("text").coalesce(1).mapInArrow(train, "dictionary binary").collect()
    return bytes(got[0][0]) if got else b""


def dictionary_of(data: bytes, level: int | None = None) -> zstandard.ZstdCompressionDict | None:
    """The dictionary, prepared once for compression at a level if one is given."""
    if len(data) < 8:
        return None
    made = zstandard.ZstdCompressionDict(data)
    if level is not None:
        made.precompute_compress(level=level)
    return made


def compress_documents(documents: DataFrame, tokenizer_path: str, dictionary: bytes, end_id: int) -> DataFrame:
    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer_path)
        end = np.asarray([end_id], encode.dtype).tobytes()
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary_of(dictionary, LEVEL), write_content_size=True, write_dict_id=False)
        for batch in slices(batches):
            raws = [raw + end for raw in encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(r) // encode.dtype.itemsize for r in raws], pa.int64()), pa.array([compressor.compress(r) for r in raws], pa.binary())],
                names=["doc_id", "n_tokens", "frame"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(compress, "doc_id long, n_tokens long, frame binary")


def write_ids(documents: DataFrame, tokenizer_path: str, end_id: int = 1, folder: str | None = None, files: int | None = None) -> str:
    """Write the ids of whole texts in ascending doc_id order; returns the folder's URI.

    Null texts are empty, every document ends with end_id. Null ids come first, rows of one doc_id
    follow each other by their frames. An empty table gives a folder with an empty manifest. A file is
    written under a name of its own attempt and then renamed, so a lost executor leaves no half file.
    """
    spark = documents.sparkSession
    folder = folder or shared_dir(spark, "token-ids")
    dictionary = train_dictionary(documents, tokenizer_path)
    digest, width = hashlib.sha256(dictionary).digest(), word_ids(tokenizer_path).dtype.itemsize
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/dictionary.zstd") as out:
        out.write(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, path = open_fs(folder)
        attempt, name = uuid.uuid4().hex, f"ids-{part:05d}"
        entries: list[np.ndarray] = []
        start, offset = 0, HEAD
        out = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = system.open_output_stream(f"{path}/.{name}.bin.{attempt}")
                out.write(MAGIC_IDS + digest)
            frames = batch.column("frame").to_pylist()
            entry = np.zeros(len(frames), ENTRY)
            entry["doc_id"] = batch.column("doc_id").fill_null(NULL_ID).to_numpy()
            entry["n"], entry["length"] = batch.column("n_tokens").to_numpy(), [len(f) for f in frames]
            entry["start"], entry["offset"] = start + np.cumsum(entry["n"]) - entry["n"], offset + np.cumsum(entry["length"]) - entry["length"]
            start, offset = start + int(entry["n"].sum()), offset + int(entry["length"].sum())
            out.write(b"".join(frames))
            entries.append(entry)
        if out is None:
            return
        out.close()
        with system.open_output_stream(f"{path}/.{name}.idx.{attempt}") as index:
            index.write(MAGIC_INDEX + digest)
            for entry in entries:
                index.write(entry.tobytes())
        for kind in ("bin", "idx"):
            system.move(f"{path}/.{name}.{kind}.{attempt}", f"{path}/{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "name": [name], "n_docs": pa.array([sum(map(len, entries))], pa.int64()), "n_ids": pa.array([start], pa.int64())})

    frames = compress_documents(documents, tokenizer_path, dictionary, end_id)
    # Compressed once, in the shared folder: choosing the ranges would otherwise encode all texts again.
    frames = materialize(frames, "token-frames")
    if not files:
        files = max(1, -(-frames.agg(F.coalesce(F.sum(F.length("frame")), F.lit(0))).first()[0] // FILE_BYTES))
    ranged = frames.repartitionByRange(files, "doc_id")
    written = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "frame").mapInArrow(write, "part long, name string, n_docs long, n_ids long")
    written = materialize(written, "token-files")  # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    written.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).withColumn("width", F.lit(width)).coalesce(1).write.parquet(f"{folder}/manifest")
    return folder


READ = "doc_id long, start long, n_tokens long, ids binary"


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_fs(folder)
        with system.open_input_stream(f"{path}/dictionary.zstd") as f:
            dictionary = f.read()
        digest = hashlib.sha256(dictionary).digest()
        decompressor = zstandard.ZstdDecompressor(dict_data=dictionary_of(dictionary))
        for batch in batches:
            for name, first, width in zip(*(batch.column(c).to_pylist() for c in ("name", "first_id", "width"))):
                with system.open_input_stream(f"{path}/{name}.idx") as f:
                    head, index = f.read(HEAD), np.frombuffer(f.read(), ENTRY)
                with system.open_input_file(f"{path}/{name}.bin") as f:
                    for found, magic in ((head, MAGIC_INDEX), (f.read_at(HEAD, 0), MAGIC_IDS)):
                        if bytes(found) != magic + digest:
                            raise ValueError(f"{name} was not written with this dictionary")
                    for at in range(0, len(index), 512):
                        some = index[at : at + 512]
                        low = int(some["offset"][0])
                        data = memoryview(f.read_at(int(some["offset"][-1] + some["length"][-1]) - low, low))
                        ids = [np.frombuffer(decompressor.decompress(data[o - low : o - low + n]), f"<u{width}").astype("<u4").tobytes() for o, n in zip(some["offset"].tolist(), some["length"].tolist())]
                        doc_ids = pa.array([None if d == NULL_ID else d for d in some["doc_id"].tolist()], pa.int64())
                        yield pa.RecordBatch.from_arrays([doc_ids, pa.array(some["start"] + first), pa.array(some["n"].astype("i8")), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    manifest = spark.read.parquet(f"{folder}/manifest").select("name", "first_id", F.col("width").cast("int").alias("width"))
    return manifest.repartition(spark.sparkContext.defaultParallelism * 4, "name").mapInArrow(read, READ)

