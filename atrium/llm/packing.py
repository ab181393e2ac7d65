"""Packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups.

Documents are cut into pieces of the sequence length and a remainder. Pieces are dealt by a hash into
groups, and every group is packed on its own: longest piece first, into the first bin that still has
room. A tournament tree over the bins keeps the largest free capacity of every subtree, so that the
first bin with room is found in one walk from the root.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.common import slices, word_ids

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"
#: Pieces that one first-fit run takes; more in a group begin a further run.
RUN = 32_768
#: Documents of a group on average.
GROUP = 16_384


class Bins:
    """Bins of one capacity, all open from the first; the tree holds the largest free capacity of each subtree."""

    def __init__(self, capacity: int, most: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put size into the first bin with room for it."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        bin_ = at - self.leaves
        free[at] -= size
        while at > 1:
            at //= 2
            most = free[2 * at] if free[2 * at] >= free[2 * at + 1] else free[2 * at + 1]
            if free[at] == most:
                break
            free[at] = most
        return bin_


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (1 to capacity); equal lengths keep their order."""
    order = np.argsort(-lengths, kind="stable")
    bins, used = Bins(capacity, len(lengths)), np.zeros(len(lengths), np.int64)
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    full = int(np.searchsorted(-lengths[order], -capacity, side="right"))
    where[order[:full]], offset[order[:full]] = np.arange(full), 0
    sizes = lengths[order].tolist()
    for i in range(full, len(sizes)):
        size = sizes[i]
        bin_ = bins.place(size) + full
        where[order[i]], offset[order[i]] = bin_, used[bin_]
        used[bin_] += size
    return where, offset


def cut_documents(documents: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Token pieces of whole texts: each document's ids and the end id, cut at multiples of capacity."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer_path)
        for batch in slices(batches):
            out: list[tuple] = []
            doc_ids = batch.column(0).to_pylist()
            for doc_id, raw in zip(doc_ids, encode(batch.column(1).to_pylist())):
                ids = np.append(np.frombuffer(raw, encode.dtype), encode.dtype.type(end_id)).astype("<u4")
                data, n = memoryview(ids.tobytes()), len(ids)
                for start in range(0, n, capacity):
                    end = min(n, start + capacity)
                    out.append((doc_id, start, end - start, zlib.crc32(data[4 * start : 4 * end]), n))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 5)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return documents.select("doc_id", "text").mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, groups: int, capacity: int = 2048, run: int = RUN) -> DataFrame:
    """Pack pieces (doc_id, start, length, ids_crc32, doc_tokens) into sequences of at most capacity tokens.

    Every piece comes back once, with sequence_id and its offset there, gapless from 0. Groups are dealt
    by a hash of all columns, a group's pieces are taken in a fixed order, and more than `run` pieces
    begin a further first-fit run, so that no group, however large, is held whole. An empty table gives
    an empty result; repeated rows are packed each; a null doc_id is kept as it is.
    """
    names = [x.split()[0] for x in PIECES.split(", ")]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, runs, group = 0, 0, None

        def packed():
            whole = pa.Table.from_batches(held).combine_chunks()
            where, offset = first_fit_decreasing(whole.column("length").to_numpy(), capacity)
            base = (group << 40) + (runs << 20)
            columns = [whole.column(n).combine_chunks() for n in names]
            yield from pa.table([*columns, pa.array(where + base), pa.array(offset)], names=[*names, "sequence_id", "offset"]).to_batches()

        for batch in batches:
            keys = batch.column("grp").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if group is not None and keys[a] != group:
                    yield from packed()
                    held, rows, runs = [], 0, 0
                group = int(keys[a])
                while a < b:
                    if rows >= run:
                        yield from packed()
                        held, rows, runs = [], 0, runs + 1
                    take = min(b - a, run - rows)
                    held.append(batch.slice(a, take))
                    rows, a = rows + take, a + take
        if held:
            yield from packed()

    dealt = pieces.select(*names, F.pmod(F.xxhash64(*names), F.lit(groups)).alias("grp"))
    return dealt.repartition("grp").sortWithinPartitions("grp", *names).mapInArrow(fit, PACKED)


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, group: int = GROUP) -> DataFrame:
    """Tokenize and pack whole documents; null texts are empty and hold the end id alone."""
    groups = max(1, round(documents.count() / group))
    return pack(cut_documents(documents, tokenizer_path, capacity, end_id), groups, capacity)
