"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. Texts are cut into pre-tokens. A task explodes block after block of texts into pre-tokens with their
   positions, and pre-aggregates: each distinct word of a block gets a number, and the positions hold
   numbers.
2. The blocks' distinct words are dealt by a hash of the word into shards, so that one task meets all
   blocks that hold a word. It encodes a distinct word once and remembers it, up to REMEMBERED words;
   a shard of more words begins a new memory, and then a word may be encoded again.
3. The ids join back to the blocks by number, and a block's documents are reassembled by position.
4. Decoding joins ids with the table of token bytes, which the vocabulary bounds.

What is shuffled is one packed row per block and shard: a word that makes up a third of all text is one
number per block. Positions are not shuffled at all: each block's are a file in the shared folder, which
the task that reassembles the block reads.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.common import materialize, open_fs, shards_for, shared_dir, slices, tidy

#: Characters of text in a block, about.
BLOCK_CHARS = 10 << 20
#: Distinct words whose ids a shard's task remembers.
REMEMBERED = 300_000
ASCII_CLASSES = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PreTokens:
    """The matches of a pre-token pattern; pure ASCII texts take a pattern of plain ranges."""

    def __init__(self, pattern: str):
        self.whole = regex.compile(pattern)
        plain = pattern
        for name, members in ASCII_CLASSES.items():
            plain = plain.replace(f" ?{name}", f" ?[{members}]").replace(name, members)
        self.plain = re.compile(plain, re.ASCII)

    def of(self, text: str) -> list[str]:
        return (self.plain if text.isascii() else self.whole).findall(text)


class Numbers(dict):
    """Numbers of words, in the order of their first occurrence."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned integer arrays as one compressed byte string: their bytes, least significant first, plane by plane."""
    parts = [np.uint32(len(arrays)).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(np.array([len(a), a.itemsize], "<u4").tobytes() + a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 4
    for _ in range(int(np.frombuffer(raw, "<u4", 1)[0])):
        n, size = np.frombuffer(raw, "<u4", 2, at).tolist()
        planes = np.frombuffer(raw, np.uint8, n * size, at + 8).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{size}").ravel())
        at += 8 + n * size
    return out


def repeats(numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Numbers plus one, and zero where a word occurs first, as it then has the next number."""
    out = (numbers + 1).astype(np.uint32)
    out[first] = 0
    return out


def numbers_of(stream: np.ndarray) -> np.ndarray:
    new = stream == 0
    return np.where(new, np.cumsum(new) - 1, stream.astype(np.int64) - 1)


#: shard -1 holds a block's doc_ids and the name of its positions' file; other shards hold words.
BLOCKS = "block long, shard int, doc_ids array<long>, payload binary"
BLOCK_TYPES = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
BLOCK_NAMES = ["block", "shard", "doc_ids", "payload"]


def explode_words(documents: DataFrame, pattern: str, shards: int, folder: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of texts (BLOCKS): distinct words, and the positions in files below folder.

    A file has a name of its own attempt, and the block's row says which: a task that is run again
    writes another file, and the row that counts names the file that goes with its numbers.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tidy()
        part, split = TaskContext.get().partitionId() << 24, PreTokens(pattern)
        system, path = open_fs(folder)
        attempt = uuid.uuid4().hex
        numbers, ids, streams, chars, block = Numbers(), [], [], 0, part

        def finished():
            flat = np.concatenate(streams) if streams else np.zeros(0, np.uint32)
            words = [w.encode("utf-8", "surrogatepass") for w in numbers]
            # A word's first place is where the running maximum of the numbers rises.
            highest = np.maximum.accumulate(np.concatenate([[-1], flat.astype(np.int64)]))
            stream = repeats(flat, np.flatnonzero(highest[1:] > highest[:-1]))
            name = f"{block}-{attempt}"
            with system.open_output_stream(f"{path}/{name}") as out:
                out.write(pack(stream, np.array([len(s) for s in streams], np.uint32)))
            rows = [(block, -1, ids, name.encode())]
            home = np.fromiter((xxhash.xxh3_64_intdigest(w) % shards for w in words), np.int64, len(words))
            order = np.argsort(home, kind="stable")
            edges = np.searchsorted(home[order], np.arange(shards + 1))
            for shard in np.flatnonzero(np.diff(edges)).tolist():
                mine = order[edges[shard] : edges[shard + 1]]
                some = [words[i] for i in mine.tolist()]
                text = np.frombuffer(b"".join(some), np.uint8)
                rows.append((block, shard, None, pack(np.diff(mine, prepend=0).astype(np.uint32), np.array([len(w) for w in some], np.uint32), text)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), BLOCK_TYPES)], names=BLOCK_NAMES)

        for batch in slices(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = split.of(text or "")
                streams.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                ids.append(doc_id)
                chars += len(text or "")
                if chars >= block_chars:
                    yield from finished()
                    numbers, ids, streams, chars, block = Numbers(), [], [], 0, block + 1
        if ids:
            yield from finished()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(explode, BLOCKS)


def encode_words(words: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The ids of each block's distinct words; a word is encoded once for all blocks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        bpe = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
        known: dict[bytes, bytes] = {}
        for batch in slices(batches, 16):
            rows = []
            for block, shard, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "shard", "payload"))):
                numbers, lengths, text = unpack(payload)
                ends, raw = np.cumsum(lengths).tolist(), text.tobytes()
                words = [raw[a:b] for a, b in zip([0, *ends], ends)]
                new = [w for w in words if w not in known]
                if len(known) > REMEMBERED:
                    known, new = {}, words
                for w in new:
                    known[w] = np.asarray(bpe.encode_ordinary(w.decode("utf-8", "surrogatepass")), "<u4").tobytes()
                ids = [known[w] for w in words]
                rows.append((block, shard, None, pack(numbers, np.array([len(i) // 4 for i in ids], np.uint32), np.frombuffer(b"".join(ids), "<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, BLOCK_TYPES)], names=BLOCK_NAMES)

    return words.mapInArrow(encode, BLOCKS)


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The concatenation of flat[starts[i] : starts[i] + sizes[i]] for i in at."""
    n = sizes[at]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


ENCODED = "doc_id long, ids array<int>"


def reassemble(blocks: DataFrame, folder: str) -> DataFrame:
    """doc_id and ids of every document, from positions and the words' ids of the same block."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        docs, name, parts, block = [], None, [], None
        system, path = open_fs(folder)

        def finished():
            with system.open_input_stream(f"{path}/{name}") as f:
                stream, sizes = unpack(f.read())
            of = [unpack(p) for p in parts]
            number = np.concatenate([np.cumsum(p[0], dtype=np.int64) for p in of] or [np.zeros(0, np.int64)])
            n_ids = np.concatenate([p[1] for p in of] or [np.zeros(0, np.uint32)]).astype(np.int64)
            flat = np.concatenate([p[2] for p in of] or [np.zeros(0, np.uint32)]).astype(np.int32)
            begin, count = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
            begin[number], count[number] = np.cumsum(n_ids) - n_ids, n_ids
            numbers, at, held, rows = numbers_of(stream), 0, 0, []
            for doc_id, size in zip(docs, sizes.tolist()):
                ids = gather(flat, begin, count, numbers[at : at + size])
                at, held = at + size, held + len(ids)
                rows.append((doc_id, ids))
                if held > 1 << 20:
                    yield encoded_batch(rows)
                    held, rows = 0, []
            if rows:
                yield encoded_batch(rows)

        for batch in slices(batches, 16):
            for row_block, shard, ids, payload in zip(*(batch.column(c).to_pylist() for c in BLOCK_NAMES)):
                if shard < 0:
                    if block is not None:
                        yield from finished()
                    name, docs, parts, block = payload.decode(), ids, [], row_block
                else:
                    parts.append(payload)
        if block is not None:
            yield from finished()

    return blocks.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(assemble, ENCODED)


def encoded_batch(rows: list[tuple]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(r[1]) for r in rows])]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([r[1] for r in rows]), pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), ids], names=["doc_id", "ids"])


def encode(documents: DataFrame, ranks_path: str, pattern: str, shards: int | None = None) -> DataFrame:
    """doc_id and ids of every whole text of (doc_id, text).

    Null and empty texts have no ids; null doc_ids and repeated rows are encoded each; other columns are
    ignored; an empty table gives an empty result. Special tokens are ordinary text. The number of shards
    grows with the input's partitions unless it is given.
    """
    shards = shards or shards_for(documents)
    folder = shared_dir(documents.sparkSession, "positions")
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    blocks = materialize(explode_words(documents, pattern, shards, folder), "word-blocks")
    words = blocks.where("shard >= 0").repartition("shard")
    return reassemble(blocks.where("shard < 0").union(encode_words(words, ranks_path, pattern)), folder)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """encoded (doc_id, ids) with `bytes`, the ids joined with the token-byte table in their order."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        for batch in slices(batches):
            lists = batch.column("ids")
            flat, offsets = lists.flatten().to_numpy(), (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            text = [b"".join(map(table.__getitem__, flat[a:b].tolist())) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(text, pa.binary())], names=["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(join, ENCODED + ", bytes binary")
