"""Near-duplicate documents by circulant MinHash, bands, and exact Jaccard verification.

1. Every text becomes its set of word shingles; equal sets form a class, named by its least doc_id.
2. A class's circulant MinHash signature is cut into bands. Classes that share a band are candidates:
   each is tied to the least class of every band bucket, and the connected candidates form a group. No
   pairs are made.
3. A group within one block is verified whole in one task: one matrix product gives all exact
   intersection sizes. A larger group is first verified against one pivot in blocks; what is linked to
   the pivot needs no comparison with the rest of what is linked, so only the unlinked rest is compared
   with the whole group, block by block.
4. Links form components; a document's component is the least doc_id in it.

Nothing is capped: every candidate pair is verified on full sets or known to be connected already. With
b bands of r rows a link of similarity s is missed with probability (1 - s^r)^b, 3e-7 at 0.85 and
6e-5 at 0.8 for 32 bands of 6; texts of similarity 0.4 are candidates in one case of eight, of 0.3 in one
of forty, so that weak likeness rarely chains groups.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.common import broadcast_if_small, fresh, materialize, slices, tidy
from atrium.llm.components import components
from atrium.llm.shingles import WordHashes, band_keys, circulant_signatures, set_key, shingle_set, words_lower

#: A block of a group: documents and shingles on average.
BLOCK_DOCS, BLOCK_SHINGLES = 1_024, 1 << 20
#: Columns of the matrices whose product gives intersection sizes.
COLUMNS = 2_048


@dataclass(frozen=True)
class Settings:
    """width: words in a shingle; percent: least 100 * intersection / union of a link; bands and rows of the signature."""

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 6


SKETCHED = "doc_id long, n_shingles long, set_key binary, bands array<long>"


def sketches(documents: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, set_key and band keys of every row; null key and no bands for texts without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        hashes = WordHashes()
        for batch in slices(batches):
            sets = [shingle_set(hashes.of(words_lower(t)), settings.width) for t in batch.column(1).to_pylist()]
            filled = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [[]] * len(sets)
            keys: list = [None] * len(sets)
            if filled:
                made = band_keys(circulant_signatures([sets[i] for i in filled], settings.bands * settings.rows), settings.rows)
                for i, row in zip(filled, made):
                    bands[i], keys[i] = row, set_key(sets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sketch, SKETCHED)


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(rep, grp) of the classes (rep, bands) that share a band with another, with the group's least rep."""
    keys = classes.select("rep", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most").select("key", "least")
    # Written first: the join then shuffles for itself, where a key of very many classes can be split.
    ties = keys.join(broadcast_if_small(materialize(shared, "shared-bands")), "key").where("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()
    return components(ties).select(F.col("node").alias("rep"), F.col("component").alias("grp"))


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted sets, by products of 0-1 matrices over the shared elements."""
    sizes_l, sizes_r = [len(s) for s in left], [len(s) for s in right]
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(np.unique(a), np.unique(b), assume_unique=True)
    if not len(shared):
        return np.zeros((len(left), len(right)), np.int64)

    def places(flat, sizes):
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        found = shared[at] == flat
        column, row = at[found], np.repeat(np.arange(len(sizes)), sizes)[found]
        order = np.argsort(column, kind="stable")
        return column[order], row[order]

    (col_l, row_l), (col_r, row_r) = places(a, sizes_l), places(b, sizes_r)
    total = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - low)
        parts = []
        for column, row, n in ((col_l, row_l, len(left)), (col_r, row_r, len(right))):
            i, j = np.searchsorted(column, [low, low + width])
            m = np.zeros((n, width), np.float32)
            m[row[i:j], column[i:j] - low] = 1
            parts.append(m)
        total += parts[0] @ parts[1].T
    return total.astype(np.int64)


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    common = intersections(left, right)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - common
    return 100 * common >= percent * union


def least_labels(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids spread over the links until each side holds the least id that it is connected with."""
    most = np.iinfo(np.int64).max
    while True:
        new_right = np.minimum(right, np.where(links, left[:, None], most).min(axis=0, initial=most))
        new_left = np.minimum(left, np.where(links, new_right[None, :], most).min(axis=1, initial=most))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def verify(tasks: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) of the tasks (grp, i, j, role, rep, text): what is in L or both against what is in R or both."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        hashes = WordHashes()

        def rows():
            for batch in slices(batches):
                yield from zip(*(batch.column(c).to_pylist() for c in ("grp", "i", "j", "role", "rep", "text")))

        for _, members in itertools.groupby(rows(), key=lambda r: r[:3]):
            left, right = [], []
            for _, _, _, role, rep, text in members:
                member = (rep, shingle_set(hashes.of(words_lower(text)), settings.width))
                if role != "R":
                    left.append(member)
                if role != "L":
                    right.append(member)
            if not left or not right:
                continue
            ids_l, ids_r = (np.array([m[0] for m in side], np.int64) for side in (left, right))
            links = linked([m[1] for m in left], [m[1] for m in right], settings.percent)
            new_l, new_r = least_labels(links, ids_l, ids_r)
            a, b = np.concatenate([ids_l, ids_r]), np.concatenate([new_l, new_r])
            keep = a != b
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    dealt = tasks.select("grp", "i", "j", "role", "rep", "text").repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    return dealt.mapInArrow(compare, "a long, b long")


def links_of(documents: DataFrame, classes: DataFrame, settings: Settings, block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links (a, b) between class names that connect exactly what exact links between candidates connect."""
    members = materialize(candidate_groups(classes).join(classes.select("rep", "n_shingles"), "rep"), "candidates")
    blocks = lambda rows, shingles: F.greatest(F.ceil(rows / block_docs), F.ceil(shingles / block_shingles))
    groups = members.groupBy("grp").agg(blocks(F.count("*"), F.sum("n_shingles")).cast("int").alias("k"))
    members = members.join(groups, "grp").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    texts = documents.select(F.col("doc_id").alias("rep"), "text").join(broadcast_if_small(members), "rep")
    texts = materialize(texts, "candidate-texts")

    whole = texts.where("k = 1").select("grp", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit("both").alias("role"), "rep", "text")
    found = verify(whole, settings)
    large = texts.where("k > 1")
    if large.isEmpty():
        return found
    # The pivot goes to every block of its group; its links make the group's core.
    pivots = large.where("rep = grp").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    star = large.select("grp", F.col("block").alias("i"), F.lit(0).alias("j"), F.lit("R").alias("role"), "rep", "text")
    star = star.union(pivots.select("grp", "i", F.lit(0).alias("j"), F.lit("L").alias("role"), "rep", "text"))
    core = materialize(verify(star, settings), "pivot-links")
    rest = large.join(core.select(F.col("a").alias("rep")).distinct(), "rep", "left_anti").where("rep <> grp")
    rest_blocks = rest.groupBy("grp").agg(blocks(F.count("*"), F.sum("n_shingles")).cast("int").alias("kl"))
    right = large.join(rest_blocks, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("kl") - 1)).alias("i"), F.col("block").alias("j"), F.lit("R").alias("role"), "rep", "text")
    left = rest.join(rest_blocks, "grp").select(
        "grp", F.pmod(F.xxhash64("rep"), F.col("kl")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("j"), F.lit("L").alias("role"), "rep", "text"
    )
    return found.union(core).union(verify(left.union(right), settings))


def near_duplicates(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of (doc_id, text).

    A text's set is its distinct shingles of `width` words (A-Z lower-cased); a shorter text is one shingle,
    a null text or one without words is an empty set, linked with nothing. component_id is the least
    doc_id reachable over links, kept is true for that document. Rows of one doc_id are one node: equal
    rows get equal results. A row with a null doc_id is linked with nothing, its component_id is null and
    it is kept. Texts are taken whole, other columns are ignored, an empty table gives an empty result.
    """
    sketched = materialize(sketches(documents, settings), "sketches")
    named = sketched.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    names = named.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = materialize(named.join(names, "set_key").where("doc_id = rep").select("rep", "n_shingles", "set_key", "bands").dropDuplicates(["rep", "set_key"]), "classes")
    linked_reps = components(links_of(documents, classes, settings))
    homes = classes.select("set_key", "rep").join(linked_reps, F.col("rep") == F.col("node"), "left")
    homes = homes.select("set_key", F.coalesce("component", "rep").alias("home"))
    joined = sketched.join(homes, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("home", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents without near duplicates: of each component the row of its least doc_id, all columns kept.

    Rows of one doc_id whose texts differ are documents of their own: the one with the least text hash has
    the doc_id's place, the others come after all documents. Rows equal in doc_id and text are one, the
    least by all columns as JSON. Rows without a doc_id stay. Columns of any other name are carried.
    """
    columns = documents.columns
    node, key, first = (fresh(documents, n) for n in ("node", "text_key", "first_key"))
    keyed = documents.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    per_id = keyed.where("doc_id IS NOT NULL").groupBy("doc_id")
    several = materialize(per_id.agg(F.min(key).alias(first), F.max(key).alias("last_key"), F.count("*").alias("n")).where("n > 1"), "repeated-ids")
    differing = several.where(f"{first} <> last_key").select(F.col("doc_id").alias(f"{node}_id"), first)
    if differing.isEmpty():
        keyed = keyed.withColumn(node, F.col("doc_id").cast("long"))
    else:
        late = F.lit(1 << 62) + F.pmod(F.xxhash64("doc_id", key), F.lit(1 << 61))
        keyed = keyed.join(broadcast_if_small(differing), F.col("doc_id") == F.col(f"{node}_id"), "left")
        keyed = keyed.withColumn(node, F.when(F.col(first).isNull() | (F.col(first) == F.col(key)), F.col("doc_id").cast("long")).otherwise(late))
    found = near_duplicates(keyed.select(F.col(node).alias("doc_id"), "text"), settings)
    kept = materialize(found.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(node)).distinct(), "kept")
    out = keyed.join(broadcast_if_small(kept), node, "left_semi")
    if not several.isEmpty():
        row = F.struct(*columns)
        out = out.groupBy(node).agg(F.min_by(row, F.to_json(row)).alias(first)).select(f"{first}.*")
    return out.select(*columns).unionByName(documents.where("doc_id IS NULL"))
