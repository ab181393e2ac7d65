"""Language-model scores by context-tree weighting over bytes.

A text is the byte stream of its words (A-Z lower-cased), each followed by a space, and a final newline.
Every byte is eight binary decisions; each decision has a tree over the preceding `depth` bytes, and each
node of a tree holds a Krichevsky-Trofimov estimate of what training texts did there. Weighting mixes
the estimates of all depths on the path by their posterior, bottom up:
P(node) = 1/2 KT(node) + 1/2 product of P(children).

1. Blocks of texts become sorted distinct byte strings of depth + 1 bytes, and distinct words, each with
   its count in training texts: what is gathered is pre-aggregated per block and grows with the corpus.
2. Counts meet in shards; a shard holds whole subtrees below the last two bytes and merges blocks one by
   one. The two top levels, at most 256 x 255 nodes, are summed over all shards.
3. Each shard answers its blocks with code lengths, and blocks sum them up per document. A block's texts
   are not shuffled: they are a file in the shared folder, which the task that sums up reads.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.bpe import BLOCK_NAMES, BLOCK_TYPES, BLOCKS, pack, unpack
from atrium.llm.common import materialize, open_fs, shards_for, shared_dir, slices, tidy
from atrium.llm.shingles import words_lower

#: Bytes of context.
DEPTH = 5
#: Bytes of text in a block, about.
BLOCK_BYTES = 8 << 20
#: Entries that wait to be merged in a shard.
PENDING = 4_000_000
HALF = math.log(0.5)


def stream_of(words: list[bytes]) -> bytes:
    return b" ".join([*words, b"\n"])


def strings_of(stream: bytes, depth: int) -> np.ndarray:
    """For each byte its context and itself as one number: the last byte before it highest, itself lowest."""
    b = np.frombuffer(b"\n" * depth + stream, np.uint8).astype(np.uint64)
    n = len(stream)
    out = b[depth:].copy()
    for d in range(1, depth + 1):
        out |= b[depth - d : depth - d + n] << np.uint64(8 * (depth - d + 1))
    return out


def word_keys(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, and of the empty word for the end."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, [*words, b""]), np.uint64, len(words) + 1)


def counted(parts: list[np.ndarray], train: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their counts in training parts."""
    keys = np.unique(np.concatenate(parts))
    counts = np.zeros(len(keys), np.uint64)
    if learnt := [p for p, t in zip(parts, train) if t]:
        some, n = np.unique(np.concatenate(learnt), return_counts=True)
        counts[np.searchsorted(keys, some)] = n
    return keys, counts


def delta(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0)).astype(np.uint64)


def explode_strings(documents: DataFrame, depth: int, shards: int, folder: str, block_bytes: int) -> DataFrame:
    """Blocks of (doc_id, train, text): shard -1 names the file of the texts, [0, shards) are strings, [shards, 2 shards) words.

    A file has a name of its own attempt, and the block's row says which.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tidy()
        block, attempt = TaskContext.get().partitionId() << 24, uuid.uuid4().hex
        system, path = open_fs(folder)
        held: list[tuple] = []
        size = 0

        def finished():
            train = [h[1] for h in held]
            ids, texts = [h[0] for h in held], [h[2] for h in held]
            sizes = np.array([len(t) for t in texts], np.uint32)
            name = f"{block}-{attempt}"
            with system.open_output_stream(f"{path}/{name}") as out:
                out.write(pack(sizes, np.array(train, np.uint8), np.frombuffer(b"".join(texts), np.uint8)))
            rows = [(block, -1, ids, name.encode())]
            for first, keys, counts in (
                (0, *counted([strings_of(t, depth) for t in texts], train)),
                (shards, *counted([h[3] for h in held], train)),
            ):
                home = (keys >> np.uint64(8 * (depth - 1))) if not first else keys
                home = ((home * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(shards)
                order = np.argsort(home, kind="stable")
                edges = np.searchsorted(home[order], np.arange(shards + 1, dtype=np.uint64))
                for shard in np.flatnonzero(np.diff(edges)).tolist():
                    mine = order[edges[shard] : edges[shard + 1]]
                    rows.append((block, first + shard, None, pack(delta(keys[mine]), counts[mine])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), BLOCK_TYPES)], names=BLOCK_NAMES)

        for batch in slices(batches):
            for doc_id, train, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_lower(text)
                held.append((doc_id, train, stream_of(words), word_keys(words)))
                size += len(held[-1][2])
                if size >= block_bytes:
                    yield from finished()
                    held, size, block = [], 0, block + 1
        if held:
            yield from finished()

    return documents.select("doc_id", "train", "text").mapInArrow(explode, BLOCKS)


def merge_shards(blocks: DataFrame) -> DataFrame:
    """Each shard's distinct keys and training counts over all blocks; block is -1."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting, held, shard = None, None, [], 0, None

        def settle():
            nonlocal keys, counts, waiting, held
            every = np.concatenate([w[0] for w in waiting] + ([keys] if keys is not None else []))
            n = np.concatenate([w[1] for w in waiting] + ([counts] if counts is not None else []))
            order = np.argsort(every, kind="stable")
            every, n = every[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            keys, counts, waiting, held = every[first], np.add.reduceat(n, first), [], 0

        def finished():
            settle()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((-1, shard, None, pack(delta(keys), counts)), BLOCK_TYPES)], names=BLOCK_NAMES)

        for batch in batches:
            for row_shard, payload in zip(*(batch.column(c).to_pylist() for c in ("shard", "payload"))):
                if row_shard != shard:
                    if shard is not None:
                        yield from finished()
                    keys, counts, waiting, held, shard = None, None, [], 0, row_shard
                steps, n = unpack(payload)
                waiting.append((np.cumsum(steps, dtype=np.uint64), n))
                held += len(n)
                if held > PENDING:
                    settle()
        if shard is not None:
            yield from finished()

    return blocks.repartition("shard").sortWithinPartitions("shard").mapInArrow(merge, BLOCKS)


TABLE = np.array([math.lgamma(n + 0.5) for n in range(64)])
TABLE_WHOLE = np.array([0.0, *(math.lgamma(n) for n in range(1, 64))])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, for arguments from 30 on exact to double precision."""
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""

    def of(n, table, shift):
        small = n < 60
        return np.where(small, table[np.minimum(n, 60).astype(np.int64)], log_gamma(np.maximum(n, 60) + shift))

    total = a + b
    whole = np.where(total < 60, TABLE_WHOLE[np.minimum(total, 60).astype(np.int64) + 1], log_gamma(np.maximum(total, 60) + 1.0))
    return of(a, TABLE, 0.5) + of(b, TABLE, 0.5) - whole - math.log(math.pi)


def decisions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key and each of its last byte's eight bits: the decision's number (1 to 255) and the bit."""
    x, j = (keys & np.uint64(255)).astype(np.int64)[:, None], np.arange(8)
    return (1 << j) | (x >> (8 - j)), (x >> (7 - j)) & 1


def subtrees(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[tuple]:
    """Per depth from `depth` down to `top`: nodes, zeros, ones, log KT, log P, and each decision's node."""
    prefix, bit = decisions(keys)
    weight = np.repeat(counts.astype(np.float64), 8)
    out: list[tuple] = []
    for d in range(depth, top - 1, -1):
        context = (keys >> np.uint64(8 * (depth - d + 1))) << np.uint64(8)
        nodes, at = np.unique((context[:, None] | prefix.astype(np.uint64)).ravel(), return_inverse=True)
        ones = np.bincount(at, weight * bit.ravel(), len(nodes))
        zeros = np.bincount(at, weight, len(nodes)) - ones
        kt = log_kt(zeros, ones)
        if out:
            below, lower = out[-1][0], out[-1][4]
            parent = np.searchsorted(nodes, ((below >> np.uint64(16)) << np.uint64(8)) | (below & np.uint64(255)))
            log_p = np.logaddexp(HALF + kt, HALF + np.bincount(parent, lower, len(nodes)))
        else:
            log_p = kt
        out.append((nodes, zeros, ones, kt, log_p, at))
    return out


def mixed(p: np.ndarray | None, zeros, ones, kt, log_p, bit: np.ndarray) -> np.ndarray:
    """The probability of `bit` at nodes: the node's own estimate, or its mixture with p from below."""
    own = (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1)
    if p is None:
        return own
    stop = np.exp(HALF + kt - log_p)
    return stop * own + (1 - stop) * p


def top_summary(merged: DataFrame, depth: int) -> DataFrame:
    """(node, zeros, ones, log_p) of the shards' subtrees, summed by last byte and decision: at most 256 x 255 rows."""

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                steps, counts = unpack(payload)
                nodes, zeros, ones, _, log_p, _ = subtrees(np.cumsum(steps, dtype=np.uint64), counts, depth, 2)[-1]
                parents, at = np.unique(((nodes >> np.uint64(16)) << np.uint64(8)) | (nodes & np.uint64(255)), return_inverse=True)
                sums = [np.bincount(at, v, len(parents)) for v in (zeros, ones, log_p)]
                yield pa.RecordBatch.from_arrays([pa.array(parents.astype(np.int64)), *map(pa.array, sums)], names=["node", "zeros", "ones", "log_p"])

    parts = merged.mapInArrow(summarize, "node long, zeros double, ones double, log_p double")
    return parts.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_p").alias("log_p"))


def top_levels(rows: list) -> list[tuple[np.ndarray, ...]]:
    """Depths 1 and 0 as dense arrays of zeros, ones, log KT and log P over last byte (or none) and decision."""
    zeros, ones, lower = np.zeros(65536), np.zeros(65536), np.zeros(65536)
    for node, a, b, log_p in rows:
        zeros[node], ones[node], lower[node] = a, b, log_p
    out = []
    for _ in range(2):
        kt = log_kt(zeros, ones)
        log_p = np.logaddexp(HALF + kt, HALF + lower)
        out.append((zeros, ones, kt, log_p))
        zeros, ones, lower = (v.reshape(-1, 256).sum(axis=0) for v in (zeros, ones, log_p))
    return out


def code_lengths(keys: np.ndarray, counts: np.ndarray, depth: int, top: list) -> np.ndarray:
    """Natural log of the model's probability of each key's last byte after its context."""
    prefix, bit = decisions(keys)
    p, flat = None, bit.ravel()
    for nodes, zeros, ones, kt, log_p, at in subtrees(keys, counts, depth, 2):
        p = mixed(p, zeros[at], ones[at], kt[at], log_p[at], flat)
    last = (keys >> np.uint64(8 * depth)).astype(np.int64)[:, None]
    for level, at in zip(top, (((last << 8) | prefix).ravel(), prefix.ravel())):
        p = mixed(p, *(v[at] for v in level), flat)
    return np.log(p).reshape(-1, 8).sum(axis=1)


def model_rows(merged: DataFrame, depth: int, shards: int, top: list) -> DataFrame:
    """Each shard's keys with values: log probabilities (as 64-bit patterns) of strings, counts of words."""

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, payload in zip(*(batch.column(c).to_pylist() for c in ("shard", "payload"))):
                steps, counts = unpack(payload)
                values = code_lengths(np.cumsum(steps, dtype=np.uint64), counts, depth, top).view(np.uint64) if shard < shards else counts
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((-1, shard, None, pack(steps, values)), BLOCK_TYPES)], names=BLOCK_NAMES)

    return merged.mapInArrow(value, BLOCKS)


def answer(model: DataFrame, blocks: DataFrame) -> DataFrame:
    """The model's values for each block's keys, in the blocks' own order of keys."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = values = None
        for batch in slices(batches, 16):
            for block, shard, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "shard", "payload"))):
                steps, more = unpack(payload)
                asked = np.cumsum(steps, dtype=np.uint64)
                if block < 0:
                    keys, values = asked, more
                    continue
                row = (block, shard, None, pack(steps, values[np.searchsorted(keys, asked)]))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, BLOCK_TYPES)], names=BLOCK_NAMES)

    return model.union(blocks).repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(look, BLOCKS)


SCORED = "doc_id long, train boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double"
SCORED_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]


def sum_up(rows: DataFrame, folder: str, depth: int, shards: int, tokens: int, distinct: int) -> DataFrame:
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        docs, name, parts, block = [], None, ([], []), None
        system, path = open_fs(folder)
        denominator = tokens + distinct + 1

        def table(some):
            keys = np.concatenate([np.cumsum(s, dtype=np.uint64) for s, _ in some])
            values = np.concatenate([v for _, v in some])
            order = np.argsort(keys)
            return keys[order], values[order]

        def finished():
            with system.open_input_stream(f"{path}/{name}") as f:
                sizes, train, raw = unpack(f.read())
            (strings, logs), (words, counts) = table(parts[0]), table(parts[1])
            logs = logs.view(np.float64)
            base = np.log10((counts + 1.0) / denominator)
            raw, at, out = raw.tobytes(), 0, []
            for doc_id, learnt, size in zip(docs, train.tolist(), sizes.tolist()):
                stream = raw[at : at + size]
                at += size
                keys, n = np.unique(strings_of(stream, depth), return_counts=True)
                score = float(logs[np.searchsorted(strings, keys)] @ n) / math.log(10)
                mine = np.searchsorted(words, word_keys(stream.split()))
                out.append((doc_id, bool(learnt), size, len(mine), int((counts[mine] > 0).sum()), float(base[mine].sum()), score))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SCORED_TYPES)], names=[x.split()[0] for x in SCORED.split(", ")])

        for batch in slices(batches, 16):
            for row_block, shard, ids, payload in zip(*(batch.column(c).to_pylist() for c in BLOCK_NAMES)):
                if shard < 0:
                    if block is not None:
                        yield from finished()
                    docs, name, parts, block = ids, payload.decode(), ([], []), row_block
                else:
                    parts[shard >= shards].append(unpack(payload))
        if block is not None:
            yield from finished()

    return rows.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(total, SCORED)


def score(documents: DataFrame, depth: int = DEPTH, shards: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score the whole texts of (doc_id, train, text), learning from rows whose train is true.

    Returns doc_id, train, n_bytes of the stream, n_tokens and n_known (words and one end), base_score and
    score, log10 probabilities by smoothed word counts and by the context trees, train_tokens, and
    bits_per_byte, the code length per byte. Null and empty texts hold the end alone; repeated rows count
    each; without training rows every bit costs one bit; other columns are ignored; an empty table gives
    an empty result. The number of shards grows with the input's partitions unless it is given.
    """
    shards = shards or shards_for(documents)
    folder = shared_dir(documents.sparkSession, "streams")
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    blocks = materialize(explode_strings(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("train", F.lit(False)).alias("train"), "text"), depth, shards, folder, block_bytes), "string-blocks")
    merged = materialize(merge_shards(blocks.where("shard >= 0").select(*BLOCK_NAMES)), "string-counts")
    top = top_levels([tuple(r) for r in top_summary(merged.where(F.col("shard") < shards), depth).collect()])
    tokens, distinct = merged.where(F.col("shard") >= shards).mapInArrow(totals, "tokens long, distinct long").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    answers = answer(model_rows(merged, depth, shards, top), blocks.where("shard >= 0"))
    scored = sum_up(blocks.where("shard < 0").union(answers), folder, depth, shards, tokens, distinct)
    return scored.withColumns({"train_tokens": F.lit(tokens).cast("long"), "bits_per_byte": -F.col("score") * math.log2(10) / F.col("n_bytes")})


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [unpack(p)[1] for p in batch.column("payload").to_pylist()]
        yield pa.RecordBatch.from_pydict({"tokens": pa.array([int(c.sum()) for c in counts], pa.int64()), "distinct": pa.array([int((c > 0).sum()) for c in counts], pa.int64())})
